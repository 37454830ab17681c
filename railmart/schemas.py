"""Column lists of the relations that move between stages."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEG_TYPES = {
    "origin": "string",
    "destination": "string",
    "vehicule_type": "string",
    "station_lat": "double",
    "station_long": "double",
    "station_lat_dest": "double",
    "station_long_dest": "double",
    "departure_time": "string",
    "arrival_time": "string",
    "shape_distance_km": "double",
    "source": "string",
    "provider": "string",
}
ROUTE_TYPES = {
    "origin": "string",
    "destination": "string",
    "vehicule_type": "string",
    "origin_city": "string",
    "destination_city": "string",
    "station_lat": "double",
    "station_long": "double",
    "station_lat_dest": "double",
    "station_long_dest": "double",
    "distance_km": "double",
    "co2_kg": "double",
    "departure_time": "string",
    "arrival_time": "string",
    "source": "string",
    "provider": "string",
}
AIRPORT_TYPES = {
    "airport_name": "string",
    "aero_lat": "double",
    "aero_long": "double",
    "category": "string",
    "iata_code": "string",
    "country_code": "string",
    "ident": "string",
}

# GTFS tables, all text as in the files
GTFS_TABLES = {
    "stops": ["stop_id", "stop_name", "stop_lat", "stop_lon"],
    "stop_times": ["trip_id", "stop_id", "stop_sequence", "departure_time", "arrival_time"],
    "trips": ["trip_id", "route_id", "shape_id"],
    "routes": ["route_id", "route_type", "route_short_name", "route_long_name"],
}

# warehouse precision, applied only when a table is written
WAREHOUSE_DECIMALS = {
    "distance_km": "decimal(10,3)",
    "co2_vt": "decimal(10,4)",
    "lat": "decimal(10,6)",
    "lon": "decimal(10,6)",
    "co2_train_kg": "decimal(10,4)",
    "co2_avion_kg": "decimal(10,4)",
    "co2_saved_kg": "decimal(10,4)",
    "traffic_share_pct": "decimal(5,2)",
}

GAZETTEER_FIELDS = {
    0: "geonameid", 1: "name", 2: "asciiname", 4: "latitude", 5: "longitude",
    8: "country_code", 14: "population",
}
GAZETTEER_WIDTH = 15  # fields a line must have


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Project to `types`: safe casts, and a typed NULL for every column `df` does not have."""
    return df.select(
        *[
            (F.col(name).try_cast(kind) if name in df.columns else F.lit(None).cast(kind)).alias(name)
            for name, kind in types.items()
        ]
    )


def keep_existing(df: DataFrame, names: list[str]) -> DataFrame:
    """Projection that passes over columns `df` does not have."""
    return df.select(*[name for name in names if name in df.columns])


def rename_existing(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename columns that exist, unless the new name is taken already."""
    fitting = {old: new for old, new in names.items() if old in df.columns and new not in df.columns}
    return df.withColumnsRenamed(fitting)
