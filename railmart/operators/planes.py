"""Flights that would replace a rail corridor."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railmart import constants as C
from railmart.functions.carbon import plane_co2
from railmart.functions.geo import haversine
from railmart.functions.once import with_once
from railmart.schemas import ROUTE_TYPES, typed


def corridors_of(routes: DataFrame) -> DataFrame:
    return routes.select("origin", "destination").distinct()


def plane_corridors(
    routes: DataFrame, links: DataFrame, min_km: float = C.MIN_FLIGHT_KM
) -> DataFrame:
    """Corridors whose two ends both have an airport, at least `min_km` apart by air."""

    def end(name: str, tag: str) -> DataFrame:
        return links.select(
            F.col("station_name").alias(name),
            F.col("airport_name").alias(f"airport_{tag}_name"),
            F.col("iata_code").alias(f"iata_{tag}"),
            F.col("aero_lat").alias(f"lat_{tag}"),
            F.col("aero_long").alias(f"lon_{tag}"),
        )

    linked = (
        corridors_of(routes)
        .join(end("origin", "origin"), "origin")
        .join(end("destination", "dest"), "destination")
    )
    km = haversine(F.col("lat_origin"), F.col("lon_origin"), F.col("lat_dest"), F.col("lon_dest"))
    return (
        with_once(linked, {"distance_km": km})
        .where(F.col("distance_km") >= min_km)
        .withColumn("co2_kg", plane_co2(F.col("distance_km")))
    )


def plane_routes(
    routes: DataFrame, links: DataFrame, min_km: float = C.MIN_FLIGHT_KM
) -> DataFrame:
    """Plane corridors in the shape of the final relation; the ends stay the rail stations."""
    flights = plane_corridors(routes, links, min_km).select(
        "origin",
        "destination",
        F.lit(C.PLANE).alias("vehicule_type"),
        F.col("origin").alias("origin_city"),
        F.col("destination").alias("destination_city"),
        F.col("lat_origin").alias("station_lat"),
        F.col("lon_origin").alias("station_long"),
        F.col("lat_dest").alias("station_lat_dest"),
        F.col("lon_dest").alias("station_long_dest"),
        "distance_km",
        "co2_kg",
        F.lit("airports").alias("source"),
        F.lit("OurAirports").alias("provider"),
    )
    return typed(flights, ROUTE_TYPES)
