"""Zipped feeds: CSV tables inside archives, read where the archives lie."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railmart.functions.text import blank_to_null
from railmart.schemas import GTFS_TABLES

ROWS_PER_BATCH = 10_000
_COLUMNS = ["feed", "table", "names", "fields"]


def _member_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """CSV rows of every text member, streamed so that a task holds one batch of rows at a time."""
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            feed = path.rsplit("/", 1)[-1].removesuffix(".zip")
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                for member in archive.namelist():
                    if not member.endswith(".txt"):
                        continue
                    table = member.rsplit("/", 1)[-1].removesuffix(".txt")
                    with archive.open(member) as raw:
                        rows = csv.reader(io.TextIOWrapper(raw, "utf-8-sig", newline=""))
                        names = [name.strip() for name in next(rows, [])]
                        while block := list(islice(rows, ROWS_PER_BATCH)):
                            yield pd.DataFrame(
                                [(feed, table, names, (r + [None] * len(names))[: len(names)]) for r in block if r],
                                columns=_COLUMNS,
                            )


def read_archives(spark: SparkSession, pattern: str) -> DataFrame:
    """(feed, table, row) for all tables of all archives; `row` maps column name to text."""
    archives = spark.read.format("binaryFile").load(pattern).select("path", "content")
    rows = archives.mapInPandas(
        _member_rows, "feed string, table string, names array<string>, fields array<string>"
    )
    return rows.select("feed", "table", F.map_from_arrays("names", "fields").alias("row"))


def unpack(spark: SparkSession, pattern: str, root: str) -> None:
    """Write archives as table directories root/table=<table>/feed=<feed>."""
    read_archives(spark, pattern).write.mode("overwrite").partitionBy("table", "feed").parquet(root)


def read_unpacked(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The four timetable tables from unpacked archives, as the folder reader gives them."""
    rows = spark.read.parquet(root)
    tables = {
        table: rows.where(F.col("table") == table).select(
            *[blank_to_null(F.try_element_at("row", F.lit(c))).alias(c) for c in columns],
            F.col("feed").cast("string").alias("feed"),
        )
        for table, columns in GTFS_TABLES.items()
    }
    complete = (
        rows.where(F.col("table").isin(list(GTFS_TABLES)))
        .select("feed", "table")
        .distinct()
        .groupBy("feed")
        .count()
        .where(F.col("count") == len(GTFS_TABLES))
        .select(F.col("feed").cast("string").alias("feed"))
    )
    return {name: df.join(complete, "feed", "left_semi") for name, df in tables.items()}
