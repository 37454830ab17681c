"""Delimited and JSON files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railmart.functions.text import blank_to_null

BOM = "﻿"


def list_files(spark: SparkSession, pattern: str | list[str], name_glob: str = "*") -> list[str]:
    """Paths behind a glob or folders; a listing only, no content is read."""
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", name_glob)
        .load(pattern)
        .select("path")
    )
    return sorted(row.path for row in listing.collect())


def source_path() -> Column:
    """Path of the file a row was read from, as plain text."""
    encoded = F.col("_metadata.file_path")
    return F.url_decode(F.regexp_replace(encoded, r"\+", "%2B"))


def folder_of(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -2)


def first_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, header): the first line of every file, found by one job for all of them."""
    lines = (
        spark.read.text(paths).where("_metadata.file_block_start = 0")
        .select(source_path().alias("path"), "value", F.monotonically_increasing_id().alias("at"))
    )
    return lines.groupBy("path").agg(F.min_by("value", "at").alias("header"))


def read_csv(
    spark: SparkSession,
    paths: str | list[str],
    columns: list[str] | None = None,
    sep: str = ",",
    with_path: bool = False,
) -> DataFrame:
    """Headed CSV files as text columns, blank text as NULL.

    A CSV scan takes the places of its columns from one header, while files of one kind may order
    or omit columns differently. So all files are one scan of numbered fields, and where their headers
    differ each row finds its fields through its file's header, joined on the path. A column of `columns`
    that a file does not have is NULL. Jobs and scans do not grow with the number of files.
    """
    paths = [paths] if isinstance(paths, str) else paths
    names = F.transform(
        F.split("header", f"\\{sep}"), lambda n: F.btrim(F.btrim(F.replace(n, F.lit(BOM), F.lit(""))), F.lit('"'))
    )
    headers = first_lines(spark, paths).select("path", names.alias("names")).cache()
    seen = headers.agg(
        F.count_distinct("names").alias("kinds"), F.max(F.size("names")).alias("width"), F.max("names").alias("names")
    ).first()
    wanted = columns or [
        r["name"] for r in headers.select(F.posexplode("names").alias("at", "name"))
        .groupBy("name").agg(F.min("at").alias("at")).orderBy("at", "name").collect()
    ]
    fields = [f"c{i}" for i in range(seen["width"] or 1)]
    scan = (
        spark.read.schema(", ".join(f"`{f}` string" for f in fields))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("sep", sep)
        .csv(paths)
    )
    path = [source_path().alias("path")] if with_path or seen["kinds"] > 1 else []
    if seen["kinds"] <= 1:
        place = {name: f"c{i}" for i, name in reversed(list(enumerate(seen["names"] or [])))}
        headers.unpersist()
        return scan.select(*[
            (blank_to_null(F.col(place[c])) if c in place else F.lit(None).cast("string")).alias(c) for c in wanted
        ], *path)
    places = headers.select("path", *[F.array_position("names", c).cast("int").alias(f"p{i}") for i, c in enumerate(wanted)])
    placed = scan.select(F.array(*fields).alias("row"), *path).join(places, "path")
    return placed.select(*[
        blank_to_null(F.get("row", F.col(f"p{i}") - 1)).alias(c) for i, c in enumerate(wanted)
    ], *(["path"] if with_path else []))


def latest(paths: list[str]) -> str:
    """Newest dated snapshot; the date is part of the file name."""
    return max(paths, key=lambda path: path.rsplit("/", 1)[-1])


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """File holding one JSON array of objects."""
    return spark.read.schema(schema).option("multiLine", True).json(path)
