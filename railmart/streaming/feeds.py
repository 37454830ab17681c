"""New feed folders to the warehouse, each exactly once.

The stream watches the stop_times file of every feed folder, the last one a landing writes. A batch
is the set of feeds that arrived since the last run; its legs go through the batch job and are
upserted into the star schema.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railmart.operators.timetable import timetable_legs
from railmart.schemas import GTFS_TABLES
from railmart.sources.files import folder_of, list_files, read_csv


def load_new_feeds(
    spark: SparkSession,
    root: str,
    progress: str,
    load: Callable[[DataFrame], None],
    feeds_per_batch: int = 500,
) -> None:
    """Run `load` on the legs of the feeds that landed since the last call with this `progress`
    folder. A batch that fails is delivered again, so `load` has to be an upsert. A folder that misses one of
    the four tables is left out, as in the batch job. New feeds come in batches of `feeds_per_batch`, all of them."""
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", "stop_times.txt")
        .option("maxFilesPerTrigger", feeds_per_batch)
        .load(f"{root}/*")
        .select("path")
    )

    def on_batch(batch: DataFrame, _: int) -> None:
        folders = [row.path.rsplit("/", 1)[0] for row in batch.collect()]  # at most feeds_per_batch short rows
        there: dict[str, set[str]] = {}
        for path in list_files(spark, folders, "*.txt") if folders else ():
            feed, name = path.rsplit("/", 2)[-2:]
            there.setdefault(feed, set()).add(name.removesuffix(".txt"))
        folders = [f for f in folders if there.get(f.rsplit("/", 1)[-1], set()) >= GTFS_TABLES.keys()]
        if not folders:
            return
        tables = {
            table: read_csv(
                spark, [f"{folder}/{table}.txt" for folder in folders], columns, with_path=True
            )
            .withColumn("feed", folder_of(F.col("path")))
            .drop("path")
            for table, columns in GTFS_TABLES.items()
        }
        load(timetable_legs(tables))

    query = (
        arrivals.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", progress)
        .foreachBatch(on_batch)
        .start()
    )
    query.awaitTermination()
