"""Model-ready tables: encoding, exact splits, scaling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railmart.operators.numbering import rank_by_hash

FEATURES = [
    "distance_km", "co2_train_kg", "co2_avion_kg", "vehicule_type",
    "origin_station_traffic", "origin_city_population",
    "dest_station_traffic", "dest_city_population",
]
ZERO_WHEN_UNKNOWN = [
    "origin_station_traffic", "origin_city_population",
    "dest_station_traffic", "dest_city_population", "co2_avion_kg",
]
CLASS_TARGET = "is_substitutable"
SAVING_TARGET = "co2_saved_kg"
HOLDOUT = 0.30
SEED = 42


def model_columns(fact: DataFrame, keys: list[str], drop_null_train: bool = False) -> DataFrame:
    """Features and targets; unknown footfall, population and flight CO2 are 0."""
    rows = fact.where(F.col("co2_train_kg").isNotNull()) if drop_null_train else fact
    wanted = list(dict.fromkeys([*keys, *FEATURES, CLASS_TARGET, SAVING_TARGET]))
    return rows.select(*wanted).withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in ZERO_WHEN_UNKNOWN}
    )


def encode(df: DataFrame, codes: DataFrame, column: str, as_column: str) -> DataFrame:
    """Replace a category by its code from (category, code)."""
    renamed = codes.toDF(column, as_column)
    return df.join(renamed, column, "left")


def exact_split(
    df: DataFrame,
    keys: list[str],
    stratify: list[str] | None = None,
    hashed: Column | None = None,
    bits: int = 64,
    holdout: float = HOLDOUT,
) -> DataFrame:
    """`split` = train, val or test: 30 % held out (rounded up), half of that test (rounded up).

    Membership follows the hash of the unique `keys`, so it is the same on every layout. With
    `stratify` the shares hold in every class.
    """
    by_hash = F.xxhash64(*keys, F.lit(SEED)) if hashed is None else hashed
    ranked = rank_by_hash(df, keys, by_hash, bits, stratify)
    held_out = F.ceil(F.col("total") * holdout)
    test = F.ceil(held_out / 2)
    return ranked.withColumn(
        "split",
        F.when(F.col("rank") <= F.col("total") - held_out, F.lit("train"))
        .when(F.col("rank") <= F.col("total") - test, F.lit("val"))
        .otherwise(F.lit("test")),
    ).drop("rank", "total")


def class_balance(splits: DataFrame, target: str) -> DataFrame:
    return splits.groupBy("split").agg(
        F.count("*").alias("n"), F.avg(target).alias("target_share")
    )


def fit_scaler(train: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, mean, scale): population deviation, 1 for a constant column."""
    stats = train.agg(
        *[
            F.struct(
                F.lit(c).alias("feature"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("scale")
            ).alias(c)
            for c in columns
        ]
    )
    rows = stats.select(F.inline(F.array(*columns)))
    return rows.withColumn("scale", F.when(F.col("scale") == 0, F.lit(1.0)).otherwise(F.col("scale")))


def apply_scaler(df: DataFrame, scaler: DataFrame, columns: list[str]) -> DataFrame:
    """(x - mean) / scale; the parameters, one row per feature, are a subquery of the same plan."""
    parameters = scaler.agg(
        F.map_from_entries(F.collect_list(F.struct("feature", F.struct("mean", "scale"))))
    ).scalar()
    return df.withColumns(
        {c: (F.col(c) - parameters[c]["mean"]) / parameters[c]["scale"] for c in columns}
    )


def sample_rows(df: DataFrame, keys: list[str], n: int = 200, hashed: Column | None = None) -> DataFrame:
    """`n` rows picked by a seeded hash of their key: the same rows on every layout."""
    by_hash = F.xxhash64(*keys, F.lit(SEED)) if hashed is None else hashed
    return df.orderBy(by_hash, *keys).limit(n)
