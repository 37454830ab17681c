"""Numbers for rows: surrogate keys, category codes, exact ranks in hash order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railmart.session import cut_lineage

ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in these low bits
RANK_BUCKET_BITS = 12


def hash_key(*columns: str) -> Column:
    """Surrogate key that stays the same over loads."""
    return F.xxhash64(*columns)


def key_collisions(df: DataFrame, key: str, natural: list[str]) -> DataFrame:
    """Surrogate keys that stand for more than one natural key; empty when all is well."""
    return (
        df.select(key, *natural).distinct().groupBy(key).agg(F.count("*").alias("natural_keys"))
        .where(F.col("natural_keys") > 1)
    )


def dense_ids(df: DataFrame, order: list[str], name: str, start: int = 1) -> DataFrame:
    """Ids without gaps in the order of `order`, which must identify a row.

    Sorted by range partition; an id is the place in the partition plus the rows of all partitions
    before. The sorted rows are written once, since places and sizes must come from one sort. The
    sizes are one row per partition.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut_lineage(
        ranged.withColumns(
            {"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}
        )
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return placed.join(F.broadcast(offsets), "_part").select(
        (place + F.col("_before") + start).alias(name), *df.columns
    )


def category_codes(df: DataFrame, column: str, code: str = "code") -> DataFrame:
    """(category, code): categories in code-point order from 0."""
    categories = df.select(column).where(F.col(column).isNotNull()).distinct()
    return dense_ids(categories, [column], code, start=0).select(column, code)


def rank_by_hash(
    df: DataFrame, keys: list[str], hashed: Column, bits: int = 64, within: list[str] | None = None
) -> DataFrame:
    """`rank` (from 1) and `total` of each row in the order of `hashed`, per group of `within`.

    `hashed` is an integer hash of the unique `keys` with `bits` significant bits. A group is cut
    into buckets of the hash range, which are even because the hash is; a row's rank is its place in
    the bucket plus the sizes of the buckets before. So the largest group is spread over all tasks.
    """
    within = within or []
    hashed_df = df.withColumn("_h", hashed).withColumn(
        "_bucket", F.shiftright("_h", bits - RANK_BUCKET_BITS)
    )
    groups = [*within, "_bucket"]
    sizes = hashed_df.groupBy(*groups).agg(F.count("*").alias("_n"))
    group = Window.partitionBy(*within)
    before = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(c).alias(f"o_{c}") for c in groups],
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(group).alias("total"),
    )
    in_bucket = Window.partitionBy(*groups).orderBy("_h", *keys)
    placed = hashed_df.withColumn("_at", F.row_number().over(in_bucket))
    same_bucket = [F.col(c).eqNullSafe(F.col(f"o_{c}")) for c in groups]  # a NULL class is a class
    return (
        placed.join(offsets, same_bucket)
        .withColumn("rank", F.col("_at") + F.col("_before"))
        .select(*df.columns, "rank", "total")
    )
