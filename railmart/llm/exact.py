"""Exact dedup by skew-safe combining, in DataFrame operations only.

Rows are equal when their normalised texts (A-Z lower-cased, null counted as empty) are identical. Three stages, each
grouping by digest and full text, so a digest never decides alone:

1. local: the map-side half of the first aggregate leaves one row per text and task;
2. salted: those rows meet per (digest, text, salt), so a group of copies is spread over all salts;
3. global: at most one winner per salt and text meets per (digest, text).

Rows are led back to their group by digest alone where the whole table has a single text for it; for digests that stand
for several texts (none with SHA-256, many with a weak digest) the text takes part in the way back.

Empty and null texts form one group. Ties and repeated ids: the largest id stays; repeated rows of one id count
in the group's size, and each of them is returned (all marked kept when the id stays). An empty table gives no rows.
Extra columns are left alone; the columns added replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railmart.llm.common import staged

SALTS = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: str = "text") -> Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def dedup(
    df: DataFrame, key: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """`df` with keep_id, group_size, kept and text_digest for each row."""
    plain = df.select(F.col(key).alias("_id"), normalised(text).alias("_text")).withColumn("_digest", digest(F.col("_text")))
    salted = (
        plain.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(SALTS)))
        .groupBy("_digest", "_text", "_salt")
        .agg(F.max("_id").alias("_best"), F.count(F.lit(1)).alias("_n"))
    )
    winners = salted.groupBy("_digest", "_text").agg(F.max("_best").alias("keep_id"), F.sum("_n").alias("group_size"))
    # one row per digest, with its group if it has just one text; a small table, written since it is read again
    by_digest = staged(winners.groupBy("_digest").agg(
        F.count(F.lit(1)).alias("_texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")
    ), "digests")
    rest = df.drop("keep_id", "group_size", "kept", "text_digest").withColumn("_digest", digest(normalised(text)))
    found = rest.join(by_digest.where("_texts = 1").drop("_texts"), "_digest")
    several = by_digest.where("_texts > 1").select("_digest")
    if not several.isEmpty():
        found = found.unionByName(
            rest.withColumn("_text", normalised(text))
            .join(winners.join(several, "_digest", "left_semi"), ["_digest", "_text"]).drop("_text")
        )
    return (
        found.withColumn("kept", F.col(key).eqNullSafe(F.col("keep_id")))
        .withColumn("text_digest", F.col("_digest")).drop("_digest")
    )
