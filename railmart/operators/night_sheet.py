"""From the night-train sheet to legs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railmart import constants as C
from railmart.functions.trains import classify_sheet, service_code
from railmart.operators.keep import keep_first
from railmart.schemas import LEG_TYPES, typed


def place_names(stops: DataFrame) -> DataFrame:
    """(station_name, lat, lon), one row per name, so that a lookup cannot multiply rows."""
    points = stops.select(
        "station_name",
        F.col("station_lat").try_cast("double").alias("lat"),
        F.col("station_long").try_cast("double").alias("lon"),
    ).where(F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("station_name").isNotNull())
    return keep_first(points, ["station_name"], ["lat", "lon"])


def locate_ends(df: DataFrame, places: DataFrame, origin: str, destination: str) -> DataFrame:
    """Coordinates of both ends by name, NULL where the name is not known."""
    start = places.toDF(origin, "station_lat", "station_long")
    end = places.toDF(destination, "station_lat_dest", "station_long_dest")
    return df.join(start, origin, "left").join(end, destination, "left")


def given_ends(df: DataFrame) -> DataFrame:
    """Drop ends that are missing, blank or the sheet's not-available mark."""
    for end in ("origin", "destination"):
        df = df.where((F.trim(end) != "") & (F.col(end) != C.SHEET_SENTINEL))
    return df


def sheet_legs(tabs: dict[str, DataFrame], strict: bool = False) -> DataFrame:
    """Legs of the sheet; its own night marks stand, the time rule does not apply."""
    trips = tabs["trips"].join(tabs["routes"], "route_id", "left")
    located = locate_ends(trips, place_names(tabs["stops"]), "trip_origin", "trip_headsign")
    code = service_code(F.col("trip_short_name"), F.col("vehicule_type"))
    legs = located.select(
        F.col("trip_origin").alias("origin"),
        F.col("trip_headsign").alias("destination"),
        classify_sheet(code, F.col("vehicule_type"), strict).alias("vehicule_type"),
        "station_lat", "station_long", "station_lat_dest", "station_long_dest",
        F.col("origin_departure_time").alias("departure_time"),
        F.col("destination_arrival_time").alias("arrival_time"),
        F.lit("back_on_track").alias("source"),
        F.lit("BackOnTrack").alias("provider"),
    )
    return typed(given_ends(legs), LEG_TYPES)
