"""Columns that are computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """`withColumns` for long expressions that later filters refer to.

    A filter on a projected column is pushed below the projection with the whole expression copied
    into it, once per mention; for a distance, a CO2 value or a cleaned name that means computing it
    several times and, for the long CASE ones, code beyond what a method may hold. The projection
    computes the columns, and a one-element array that is inlined right behind it is a place no
    filter passes.
    """
    computed = df.withColumns(columns)
    kept = [c for c in df.columns if c not in columns]
    return computed.select(*kept, F.inline(F.array(F.struct(*columns))))
