"""Timetable feeds: one folder per feed, all feeds in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railmart.schemas import GTFS_TABLES
from railmart.sources.files import folder_of, list_files, read_csv


def parse_countries(setting: str | None) -> list[str]:
    """Country list from 'FR,DE' as well as from "['FR', 'DE']"."""
    cleaned = (setting or "").translate(str.maketrans("", "", "[]'\" "))
    return [code.upper() for code in cleaned.split(",") if code]


def find_feeds(
    spark: SparkSession,
    root: str,
    countries: list[str] | None = None,
) -> dict[str, dict[str, str]]:
    """feed -> table -> path. Feeds are filtered by country; one that misses a table is left out."""
    feeds: dict[str, dict[str, str]] = {}
    for path in list_files(spark, f"{root}/*", "*.txt"):
        feed, name = path.rsplit("/", 2)[-2:]
        feeds.setdefault(feed, {})[name.removesuffix(".txt")] = path
    names = sorted(feeds)
    if countries:
        names = [name for name in names if name[:2].upper() in countries]
    return {
        name: feeds[name] for name in names if feeds[name].keys() >= GTFS_TABLES.keys()
    }


def read_feeds(
    spark: SparkSession,
    root: str,
    countries: list[str] | None = None,
) -> dict[str, DataFrame] | None:
    """The four tables over all feeds, each with its `feed`; None when no feed is complete."""
    feeds = find_feeds(spark, root, countries)
    if not feeds:
        return None
    return {
        table: read_csv(
            spark, [files[table] for files in feeds.values()], columns, with_path=True
        )
        .withColumn("feed", folder_of(F.col("path")))
        .drop("path")
        for table, columns in GTFS_TABLES.items()
    }
