"""The star schema: dimensions, fact and the checks between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railmart import constants as C
from railmart.functions.carbon import (
    co2_saved, is_long_distance, is_plane, is_substitutable, vehicle_factor,
)
from railmart.operators.keep import keep_first
from railmart.operators.numbering import hash_key
from railmart.schemas import WAREHOUSE_DECIMALS

FACT_KEYS = ["origin", "destination", "vehicule_type"]
PLACES = ["station_lat", "station_long", "station_lat_dest", "station_long_dest"]


def unique_routes(routes: DataFrame) -> DataFrame:
    """One row per ends, type and source."""
    return keep_first(
        routes,
        ["origin", "destination", "vehicule_type", "source"],
        ["provider", "departure_time", "arrival_time"],
    )


def trains(routes: DataFrame) -> DataFrame:
    return routes.where(~is_plane(F.col("vehicule_type")))


def planes(routes: DataFrame) -> DataFrame:
    return routes.where(is_plane(F.col("vehicule_type")))


def dim_vehicle_type(routes: DataFrame) -> DataFrame:
    types = trains(routes).select(F.col("vehicule_type").alias("service_type")).distinct()
    return types.select(
        hash_key("service_type").alias("vehicle_type_id"),
        F.col("service_type").alias("label"),
        "service_type",
        vehicle_factor(F.col("service_type")).alias("co2_vt"),
    )


def dim_route(routes: DataFrame, long_km: float = C.LONG_DISTANCE_KM) -> DataFrame:
    pairs = (
        trains(routes)
        .groupBy(F.col("origin").alias("dep_name"), F.col("destination").alias("arr_name"))
        .agg(
            F.min("origin_city").alias("dep_city"),
            F.min("destination_city").alias("arr_city"),
            F.avg("distance_km").alias("distance_km"),
        )
    )
    return pairs.select(
        hash_key("dep_name", "arr_name").alias("route_id"),
        *pairs.columns,
        is_long_distance(F.col("distance_km"), long_km).alias("is_long_distance"),
    )


def train_corridors(routes: DataFrame) -> DataFrame:
    """Per ends and type the least CO2 and the mean distance; coordinates stay from one row."""
    place = F.struct(*PLACES)
    placed = F.col("station_lat").isNotNull() & F.col("station_lat_dest").isNotNull()
    return (
        trains(routes)
        .groupBy(*FACT_KEYS)
        .agg(
            F.min("co2_kg").alias("co2_train_kg"),
            F.avg("distance_km").alias("distance_km"),
            F.coalesce(F.min(F.when(placed, place)), F.min(place)).alias("place"),
            F.min("origin_city").alias("origin_city"),
            F.min("destination_city").alias("destination_city"),
        )
        .select("*", "place.*")
        .drop("place")
    )


def plane_minimum(routes: DataFrame) -> DataFrame:
    return planes(routes).groupBy("origin", "destination").agg(F.min("co2_kg").alias("co2_avion_kg"))


def fact_corridors(routes: DataFrame) -> DataFrame:
    """One row per corridor and train type, with the flight that would replace it."""
    joined = train_corridors(routes).join(plane_minimum(routes), ["origin", "destination"], "left")
    return joined.withColumns(
        {
            "co2_saved_kg": co2_saved(F.col("co2_train_kg"), F.col("co2_avion_kg")),
            "is_substitutable": is_substitutable(F.col("distance_km"), F.col("co2_avion_kg")),
            "traffic_share_pct": F.lit(None).cast("double"),
        }
    )


def dim_station(fact: DataFrame) -> DataFrame:
    """One row per station name over both ends; a placed row wins over an unplaced one."""
    ends = F.array(
        F.struct(
            F.col("origin").alias("station_name"),
            F.col("origin_city").alias("city"),
            F.col("station_lat").alias("lat"),
            F.col("station_long").alias("lon"),
        ),
        F.struct(
            F.col("destination").alias("station_name"),
            F.col("destination_city").alias("city"),
            F.col("station_lat_dest").alias("lat"),
            F.col("station_long_dest").alias("lon"),
        ),
    )
    rows = fact.select(F.inline(ends)).withColumn("unplaced", F.col("lat").isNull() | F.col("lon").isNull())
    kept = keep_first(rows, ["station_name"], ["unplaced", "city", "lat", "lon"])
    return kept.select(
        hash_key("station_name").alias("station_id"),
        "station_name", "city", "lat", "lon",
        F.lit(None).cast("string").alias("country_code"),
        F.lit(None).cast("long").alias("annual_station_traffic"),
        F.lit(None).cast("long").alias("city_population"),
    )


def fact_wide(fact: DataFrame, stations: DataFrame) -> DataFrame:
    """Fact with footfall and population of both ends."""

    def attributes(end: str, tag: str) -> DataFrame:
        return stations.select(
            F.col("station_name").alias(end),
            F.col("annual_station_traffic").alias(f"{tag}_station_traffic"),
            F.col("city_population").alias(f"{tag}_city_population"),
        )

    return (
        fact.join(attributes("origin", "origin"), "origin", "left")
        .join(attributes("destination", "dest"), "destination", "left")
        .select(
            *FACT_KEYS, "co2_train_kg", "co2_avion_kg", "co2_saved_kg", "is_substitutable",
            "distance_km", *PLACES, "origin_city", "destination_city",
            "origin_station_traffic", "origin_city_population",
            "dest_station_traffic", "dest_city_population",
        )
    )


def resolve_keys(
    fact: DataFrame, routes: DataFrame, vehicles: DataFrame, stations: DataFrame
) -> DataFrame:
    """Fact rows with the keys of all four dimensions; a row without a route is dropped."""
    route_keys = routes.select(
        F.col("dep_name").alias("origin"), F.col("arr_name").alias("destination"), "route_id"
    )
    vehicle_keys = vehicles.select(F.col("service_type").alias("vehicule_type"), "vehicle_type_id")
    start = stations.select(F.col("station_name").alias("origin"), F.col("station_id").alias("origin_station_id"))
    end = stations.select(F.col("station_name").alias("destination"), F.col("station_id").alias("dest_station_id"))
    return (
        fact.join(route_keys, ["origin", "destination"], "left")
        .where(F.col("route_id").isNotNull())
        .join(vehicle_keys, "vehicule_type", "left")
        .join(start, "origin", "left")
        .join(end, "destination", "left")
        .select(
            hash_key("origin", "destination", "vehicule_type").alias("fact_id"),
            "route_id", "vehicle_type_id", "origin_station_id", "dest_station_id",
            "co2_train_kg", "co2_avion_kg", "co2_saved_kg", "traffic_share_pct",
            F.coalesce(F.col("is_substitutable").try_cast("int"), F.lit(0)).alias("is_substitutable"),
        )
    )


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key is set but not in the parent."""
    keys = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return child.where(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Natural keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows replace existing rows of the same key; all others stay. New columns are allowed."""
    kept = existing.join(new.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def out_of_range(df: DataFrame) -> DataFrame:
    """Rows with a number that its warehouse column cannot hold."""
    unfit = F.lit(False)
    for c, kind in WAREHOUSE_DECIMALS.items():
        if c in df.columns:
            unfit = unfit | (F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) & F.col(c).try_cast(kind).isNull())
    return df.where(unfit)


def warehouse_types(df: DataFrame) -> DataFrame:
    """Decimal columns as the warehouse stores them. Computation stays in double until here.

    A number too large for its column becomes NULL; a load refuses such rows (`out_of_range`) before."""
    fitting = {c: F.col(c).try_cast(t) for c, t in WAREHOUSE_DECIMALS.items() if c in df.columns}
    return df.withColumns(fitting)
