"""Airport list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railmart import constants as C
from railmart.schemas import AIRPORT_TYPES, rename_existing, typed
from railmart.sources.files import latest, list_files, read_csv


def usable_airports(df: DataFrame) -> DataFrame:
    """Airports with a place and one of the three airport sizes, in our column names."""
    named = rename_existing(df, C.COLUMN_NAMES["airports"])
    return typed(named, AIRPORT_TYPES).where(
        F.col("aero_lat").isNotNull()
        & F.col("aero_long").isNotNull()
        & F.col("category").isin(C.AIRPORT_CATEGORIES)
    )


def read_airports(spark: SparkSession, folder: str) -> DataFrame:
    """Airports of the newest snapshot."""
    newest = latest(list_files(spark, folder, "airports_*.csv"))
    return usable_airports(read_csv(spark, newest))
