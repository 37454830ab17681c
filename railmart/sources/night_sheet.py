"""Night-train sheet: routes, trips and stops tabs landed as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from railmart.sources.files import read_csv

ROUTES = ["route_id", "vehicule_type"]
TRIPS = [
    "route_id", "trip_origin", "trip_headsign", "trip_short_name",
    "origin_departure_time", "destination_arrival_time",
]
STOPS = ["station_name", "station_lat", "station_long"]


def read_night_sheet(spark: SparkSession, folder: str) -> dict[str, DataFrame] | None:
    """The three tabs; None when the trips tab does not name both ends of a trip."""
    trips = f"{folder}/back_on_track_trips.csv"
    header = read_csv(spark, trips).columns
    if not {"trip_origin", "trip_headsign"} <= set(header):
        return None
    return {
        "routes": read_csv(spark, f"{folder}/back_on_track_routes.csv", ROUTES),
        "trips": read_csv(spark, trips, TRIPS),
        "stops": read_csv(spark, f"{folder}/back_on_track_stops.csv", STOPS),
    }
