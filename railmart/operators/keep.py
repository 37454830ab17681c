"""One row per key, the same row on every layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that comes first by `order`, then by all other columns.

    An aggregate of the smallest struct, so a hot key is combined before the shuffle and never sits
    in one task as a sorted group. NULL sorts first.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("kept")
    return df.groupBy(*keys).agg(first).select(
        *[F.col(c) if c in keys else F.col(f"kept.{c}").alias(c) for c in df.columns]
    )


def undirected(df: DataFrame, start: str = "origin", end: str = "destination") -> DataFrame:
    """Corridor ends in name order, so that both directions share a key."""
    return df.withColumns({start: F.least(start, end), end: F.greatest(start, end)})
