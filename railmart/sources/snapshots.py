"""Daily snapshots: one partition per day, loaded at most once."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def has_snapshot(spark: SparkSession, root: str, day: str) -> bool:
    try:
        table = spark.read.parquet(root)
    except AnalysisException:
        return False
    return not table.where(F.col("snapshot_date").cast("string") == day).isEmpty()


def write_snapshot(df: DataFrame, root: str, day: str, replace: bool = False) -> bool:
    """Write the day's partition unless it is there already; other days stay untouched."""
    if not replace and has_snapshot(df.sparkSession, root, day):
        return False
    (
        df.withColumn("snapshot_date", F.lit(day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(root)
    )
    return True
