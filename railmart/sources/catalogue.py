"""Feed catalogue: which feeds to load and where they come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railmart import constants as C
from railmart.functions.text import file_safe

CATALOGUE_SCHEMA = (
    "id string, provider string, feed_name string, country string, "
    "latest_dataset struct<hosted_url: string>"
)


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CATALOGUE_SCHEMA).option("multiLine", True).json(path)


def is_relevant(provider: Column, feed_name: Column) -> Column:
    """False when either name speaks of road or city transport."""
    both = F.lower(F.concat_ws(" ", provider, feed_name))
    return ~both.rlike("|".join(C.FEED_EXCLUDE_WORDS))


def feeds_to_load(catalogue: DataFrame, countries: list[str] | None = None) -> DataFrame:
    """(country, feed, folder, url) of every relevant feed that has a dataset."""
    url = F.col("latest_dataset.hosted_url")
    rows = catalogue.where(
        is_relevant(F.col("provider"), F.col("feed_name")) & (F.length(url) > 0)
    )
    if countries:
        rows = rows.where(F.col("country").isin(countries))
    provider = file_safe(F.coalesce("provider", F.lit("Unknown")))
    return rows.select(
        "country",
        F.col("id").alias("feed"),
        F.concat_ws("_", "country", provider, "id").alias("folder"),
        url.alias("url"),
    )
