"""Row filters and name cleaning of legs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railmart import constants as C
from railmart.functions.carbon import co2_kg, is_plane
from railmart.functions.geo import haversine
from railmart.functions.once import with_once
from railmart.functions.text import clean_station, is_numeric_name


def has_two_ends(origin: Column, destination: Column) -> Column:
    """Both names present, not blank and different."""
    return (F.trim(origin) != "") & (F.trim(destination) != "") & (origin != destination)


def valid_ends(df: DataFrame) -> DataFrame:
    return df.where(has_two_ends(F.col("origin"), F.col("destination")))


def known_origin(df: DataFrame, strict: bool = False) -> DataFrame:
    """Origin axes may be NULL but not 0. `strict` rejects only (0, 0), at both ends."""
    if strict:
        for lat, lon in (("station_lat", "station_long"), ("station_lat_dest", "station_long_dest")):
            at_zero = (F.col(lat) == 0.0) & (F.col(lon) == 0.0)
            df = df.where(~F.coalesce(at_zero, F.lit(False)))
        return df
    for axis in ("station_lat", "station_long"):
        df = df.where(F.col(axis).isNull() | (F.col(axis) != 0.0))
    return df


def named_ends(df: DataFrame) -> DataFrame:
    """Drop ends that are bare stop numbers."""
    return df.where(~is_numeric_name(F.col("origin")) & ~is_numeric_name(F.col("destination")))


def clean_legs(df: DataFrame, strict: bool = False) -> DataFrame:
    """All leg filters, then cleaned names; ends that became equal or blank are dropped as well."""
    kept = named_ends(known_origin(valid_ends(df), strict))
    cleaned = with_once(
        kept,
        {"origin": clean_station(F.col("origin")), "destination": clean_station(F.col("destination"))},
    )
    return valid_ends(cleaned)


def usable_stop(lat: Column, lon: Column) -> Column:
    """Stop with both axes, neither 0 (segment lengths)."""
    return (lat != 0.0) & (lon != 0.0)


def named_stop(name: Column, lat: Column) -> Column:
    """Stop with a name and a latitude other than 0 (pairs); the longitude is not looked at."""
    return name.isNotNull() & (lat != 0.0)


def with_distance(df: DataFrame) -> DataFrame:
    """Straight-line km between both ends."""
    km = haversine(
        F.col("station_lat"), F.col("station_long"),
        F.col("station_lat_dest"), F.col("station_long_dest"),
    )
    return with_once(df, {"distance_km": km})


def far_enough(df: DataFrame, min_km: float = C.MIN_TRAIN_KM) -> DataFrame:
    """Keep long rides, rides of unknown length and flights."""
    return df.where(
        (F.col("distance_km") >= min_km)
        | F.col("distance_km").isNull()
        | is_plane(F.col("vehicule_type"))
    )


def with_co2(df: DataFrame) -> DataFrame:
    """CO2 per ride. The walk through the country rectangles reads both axes over a hundred times;
    as columns that cannot be NULL they need no NULL checks, which keeps the compiled method small
    enough for the JIT. NaN lies in no rectangle. A plain projection: who does not read the value does not
    compute it."""
    nowhere = F.lit(float("nan"))
    axes = {"_lat": F.coalesce("station_lat", nowhere), "_lon": F.coalesce("station_long", nowhere)}
    kg = co2_kg(F.col("distance_km"), F.col("vehicule_type"), F.col("_lat"), F.col("_lon"))
    return df.withColumns(axes).withColumn("co2_kg", kg).drop(*axes)


def rail_routes(legs: DataFrame, strict: bool = False) -> DataFrame:
    """Cleaned legs with city, distance and CO2: the train half of the final relation."""
    cleaned = clean_legs(legs, strict)
    cities = cleaned.withColumns(
        {"origin_city": F.col("origin"), "destination_city": F.col("destination")}
    )
    return with_co2(far_enough(with_distance(cities)))
