"""Session settings and tables that cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# HotSpot does not compile methods of more than 8000 bytes. A fused stage above that would run
# interpreted; with this limit Spark splits it into methods that are compiled.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")
# Removes the shuffle files of a query when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for; `conf` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        METHOD_LIMIT[0]: METHOD_LIMIT[1],
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.appName("railmart")
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Give a session built elsewhere the one setting that the long CASE expressions need."""
    spark.conf.set(*METHOD_LIMIT)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the one named in `spark.checkpoint.dir`. Only a local session
    without that setting (a test) gets a temporary one, kept for the session's life."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # one process; local-cluster has several
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="railmart-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` as a table in the shared folder and go on from its files.

    For a relation that several later steps read, or that must not be computed twice because its row
    numbers belong to one sort. A lost executor then costs a read, not the whole history; the files
    are columnar, so readers still take only the columns they need.
    """
    path = f"{staging_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    write_staged(df, path)
    out = df.sparkSession.read.parquet(path)
    out._staged_path = path
    return out


def write_staged(df: DataFrame, path: str) -> None:
    """Write `df` as a table that later steps read, and free the disk its shuffles took.

    Otherwise shuffle files stay until the driver happens to collect its garbage, those of all steps at once.
    """
    conf, before = df.sparkSession.conf, df.sparkSession.conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            conf.unset(SHUFFLE_CLEANUP)
        else:
            conf.set(SHUFFLE_CLEANUP, before)


def drop_staged(*tables: DataFrame) -> None:
    """Delete staged tables that no later step reads."""
    for df in tables:
        delete(df.sparkSession, df._staged_path)


def delete(spark: SparkSession, path: str) -> None:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(found, True)


def staging_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/railmart-{spark.sparkContext.applicationId}"


def clear_staged(spark: SparkSession) -> None:
    """Delete all tables this application has staged; for when the results that read them are written."""
    delete(spark, staging_folder(spark))
