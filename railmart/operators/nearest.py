"""Stations and the airports around them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railmart import constants as C
from railmart.functions.geo import cell, degrees_of_latitude, haversine, within_band
from railmart.functions.once import with_once
from railmart.operators.keep import keep_first

FULL_CIRCLE = 360
SPREAD = 4


def stations_of(routes: DataFrame, *also: str) -> DataFrame:
    """Distinct (station_name, station_lat, station_long) of both ends, from one scan; `also`: with these columns."""
    ends = F.array(
        F.struct(
            F.col("origin").alias("station_name"),
            F.col("station_lat"),
            F.col("station_long"),
        ),
        F.struct(
            F.col("destination").alias("station_name"),
            F.col("station_lat_dest").alias("station_lat"),
            F.col("station_long_dest").alias("station_long"),
        ),
    )
    return (
        routes.select(*also, F.inline(ends))
        .where(
            F.col("station_name").isNotNull()
            & F.col("station_lat").isNotNull()
            & F.col("station_long").isNotNull()
        )
        .distinct()
    )


def distinct_airports(airports: DataFrame) -> DataFrame:
    """One row per (iata_code, place)."""
    columns = ["iata_code", "aero_lat", "aero_long", "airport_name", "country_code"]
    placed = airports.select(*columns).where(
        F.col("aero_lat").isNotNull() & F.col("aero_long").isNotNull()
    )
    return keep_first(placed, columns[:3], columns[3:])


def nearby_pairs(
    points: DataFrame,
    airports: DataFrame,
    radius_km: float = C.AIRPORT_RADIUS_KM,
    band: float | None = C.AIRPORT_BAND_DEG,
    spread: int = SPREAD,
) -> DataFrame:
    """Pairs within `radius_km` and, unless `band` is None, within `band` degrees on both axes.

    An equi-join on grid cells. A cell is as wide as the reach of an airport, so an airport goes to
    the cells its reach touches (nine at most with a band) and a point to exactly one; the
    conditions on the pair then are exact. Without a band the reach in longitude is that of the
    circle at the airport's latitude, and cells go round the globe.

    Pairs may be many more than rows, which no file or shuffle size shows: with a `spread` the points of a cell are dealt over so many
    parts, to each of which its airports go, and all parts over all shuffle partitions, however small the tables are.
    """
    reach_lat = degrees_of_latitude(radius_km)
    far_lat = reach_lat
    if band is not None:
        reach_lat = min(reach_lat, band)
    size_lon = band or 1.0
    reach_lon, wrap = _reach(F.col("aero_lat"), radius_km, band)

    def cells(centre: Column, reach: Column, size: float) -> Column:
        return F.sequence(cell(centre - reach, size), cell(centre + reach, size))

    lon_cells = cells(F.col("aero_long"), reach_lon, size_lon)
    point_lon_cell = cell(F.col("station_long"), size_lon)
    if wrap:
        lon_cells = F.array_distinct(F.transform(lon_cells, lambda c: F.pmod(c, F.lit(FULL_CIRCLE))))
        point_lon_cell = F.pmod(point_lon_cell, F.lit(FULL_CIRCLE))
    reached = airports.withColumn(
        "cell_y", F.explode(cells(F.col("aero_lat"), F.lit(reach_lat), reach_lat))
    ).withColumn("cell_x", F.explode(lon_cells))
    located = points.withColumns(
        {"cell_y": cell(F.col("station_lat"), reach_lat), "cell_x": point_lon_cell}
    )
    here = (F.col("station_lat"), F.col("station_long"), F.col("aero_lat"), F.col("aero_long"))
    keys = ["cell_y", "cell_x"]
    if spread > 1:
        keys.append("part")
        n = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        located = located.withColumn("part", F.pmod(F.xxhash64(*points.columns), F.lit(spread))).repartition(n, *keys)
        reached = reached.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spread - 1).cast("long"))))
    pairs = located.join(reached, keys).drop(*keys)
    if band is not None:
        pairs = pairs.where(within_band(*here, band))
    pairs = pairs.where(F.abs(F.col("station_lat") - F.col("aero_lat")) <= far_lat)  # farther ones need no distance
    return with_once(pairs, {"station_airport_km": haversine(*here)}).where(
        F.col("station_airport_km") <= radius_km
    )


def _reach(lat: Column, radius_km: float, band: float | None) -> tuple[Column, bool]:
    if band is not None:
        return F.lit(band), False
    angle = radius_km / C.EARTH_RADIUS_KM
    ratio = F.lit(math.sin(angle)) / F.cos(F.radians(lat))
    holds_pole = F.abs(lat) + math.degrees(angle) >= 90
    circle = F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) * (1 + 1e-9)
    return F.when(holds_pole, F.lit(FULL_CIRCLE / 2.0)).otherwise(circle), True


def nearest_airports(
    stations: DataFrame,
    airports: DataFrame,
    radius_km: float = C.AIRPORT_RADIUS_KM,
    band: float | None = C.AIRPORT_BAND_DEG,
) -> DataFrame:
    """The closest airport of each station name, if there is one in reach.

    The search runs over distinct places, so any number of stations at one spot costs one search.
    Distances are compared to the millimetre; ties go by code and name.
    """
    places = stations.select("station_lat", "station_long").distinct()
    pairs = nearby_pairs(places, distinct_airports(airports), radius_km, band, spread=1)
    candidate = F.struct(
        F.round("station_airport_km", 6).alias("mm"),
        "iata_code", "airport_name", "aero_lat", "aero_long", "country_code", "station_airport_km",
    )
    per_place = pairs.groupBy("station_lat", "station_long").agg(F.min(candidate).alias("best"))
    # homonyms at several places share the closest of their airports
    best = F.min(F.struct("best", "station_lat", "station_long")).alias("pick")
    per_name = (
        stations.join(per_place, ["station_lat", "station_long"]).groupBy("station_name").agg(best)
    )
    return per_name.select(
        "station_name", "pick.station_lat", "pick.station_long",
        "pick.best.airport_name", "pick.best.aero_lat", "pick.best.aero_long",
        "pick.best.iata_code", "pick.best.country_code", "pick.best.station_airport_km",
    )
