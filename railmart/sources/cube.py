"""Statistical cubes in JSON: a flat value index over the product of all dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CUBE_SCHEMA = (
    "id array<string>, size array<long>, value map<string, double>, "
    "dimension map<string, struct<category: struct<index: map<string, long>>>>"
)


def read_cubes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CUBE_SCHEMA).option("multiLine", True).json(path)


def decode_cube(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per present cell: `value` and `codes`, a map dimension -> code.

    The last dimension varies fastest. A position without a code keeps its number as text.
    """
    strides = F.transform(
        "id",
        lambda _, i: F.aggregate(
            F.slice("size", i + 2, F.greatest(F.size("size") - i - 1, F.lit(0))),
            F.lit(1).cast("long"),
            lambda product, n: product * n,
        ),
    )

    def by_position(dim: Column) -> Column:
        """Codes of a dimension in order of their positions, once per cube."""
        index = F.try_element_at(F.col("dimension"), dim)["category"]["index"]
        return F.array_sort(F.transform(F.map_entries(index), lambda e: F.struct(e["value"].alias("at"), e["key"].alias("code"))))

    cells = df.withColumns({"strides": strides, "codes_at": F.transform("id", by_position)}).select(
        *(keep or []), "id", "size", "strides", "codes_at", F.explode("value").alias("flat", "value")
    )

    def code(_: Column, i: Column) -> Column:
        position = F.call_function("div", F.col("flat").cast("long"), F.get("strides", i)) % F.get("size", i)
        codes = F.get("codes_at", i)
        there = F.get(codes, position.cast("int"))  # where positions run without gaps; else they are searched
        found = F.when(there["at"] == position, there["code"]).otherwise(
            F.get(F.filter(codes, lambda e: e["at"] == position), F.lit(0))["code"]
        )
        return F.coalesce(found, position.cast("string"))

    codes = F.map_from_arrays("id", F.transform("id", code))
    return cells.where(F.col("value").isNotNull()).select(
        *(keep or []), F.col("flat").cast("long").alias("flat"), codes.alias("codes"), "value"
    )


def cube_columns(decoded: DataFrame, dimensions: list[str]) -> DataFrame:
    """Codes as one column per dimension."""
    return decoded.select(
        *[F.try_element_at("codes", F.lit(d)).alias(d) for d in dimensions], "value"
    )
