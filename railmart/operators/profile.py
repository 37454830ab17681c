"""Descriptive tables: counts, shares, statistics, quality."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railmart import constants as C
from railmart.functions.carbon import intensity
from railmart.functions.text import matches
from railmart.functions.trains import arrow, day_or_night, distance_category, mode_of
from railmart.operators.quantiles import exact_quantiles

TRAIN_PATTERN = "Train|Night|Euro|City"
NIGHT_PATTERN = "Nuit|Night"


# --- counts and shares -------------------------------------------------------
def overview(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("total"),
        F.count("distance_km").alias("with_distance"),
        F.count_if(F.col("distance_km").isNull()).alias("without_distance"),
    )


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """Known values by how often they occur, with the share of all rows in percent."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return (
        counts.where(F.col(column).isNotNull())
        .withColumn("pct", F.col("n") * 100.0 / total)
        .orderBy(F.desc("n"), column)
    )


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, filled, pct) for the columns that exist."""
    there = [c for c in columns if c in df.columns]
    filled = df.agg(F.count("*").alias("rows"), *[F.count(c).alias(c) for c in there])
    return (
        filled.unpivot("rows", there, "column", "filled")
        .select("column", "filled", (F.try_divide(F.col("filled") * 100.0, F.col("rows"))).alias("pct"))
    )


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, nulls), most first."""
    wanted = columns or df.columns
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in wanted])
    return counted.unpivot([], wanted, "column", "nulls").orderBy(F.desc("nulls"), "column")


def null_total(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: number of rows, and of nulls over all columns."""
    wanted = columns or df.columns
    nulls = sum((F.col(c).isNull().cast("long") for c in wanted), F.lit(0).cast("long"))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(nulls), F.lit(0)).alias("nulls"))


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, type, filled, nulls, null_pct)."""
    wanted = columns or df.columns
    filled = df.agg(F.count("*").alias("rows"), *[F.count(c).alias(c) for c in wanted])
    long = filled.unpivot("rows", wanted, "column", "filled")
    kinds = F.create_map(*[F.lit(v) for c in wanted for v in (c, dict(df.dtypes)[c])])
    nulls = F.col("rows") - F.col("filled")
    return long.select(
        "column",
        F.element_at(kinds, F.col("column")).alias("type"),
        "filled",
        nulls.alias("nulls"),
        F.round(F.try_divide(nulls * 100.0, F.col("rows")), 1).alias("null_pct"),
    )


def distinct_ends(df: DataFrame) -> DataFrame:
    """Distinct origins, destinations and names at either end, in one shuffle."""
    ends = F.array(
        F.struct(F.col("origin").alias("name"), F.lit(1).alias("o"), F.lit(0).alias("d")),
        F.struct(F.col("destination").alias("name"), F.lit(0).alias("o"), F.lit(1).alias("d")),
    )
    names = (
        df.select(F.inline(ends)).where(F.col("name").isNotNull())
        .groupBy("name").agg(F.max("o").alias("o"), F.max("d").alias("d"))
    )
    return names.agg(
        F.coalesce(F.sum("o"), F.lit(0)).alias("origins"),
        F.coalesce(F.sum("d"), F.lit(0)).alias("destinations"),
        F.count("*").alias("stations"),
    )


SKETCH_BITS = 12  # 4096 registers: a standard error of 1.6%


def end_sketches(df: DataFrame, by: list[str]) -> DataFrame:
    """Per group (a feed, a snapshot) the sketches of its distinct origins and destinations: a few kilobytes each, to be
    stored beside the rows and united later, so a count over many feeds reads no names again."""
    return df.groupBy(*by).agg(
        F.hll_sketch_agg("origin", SKETCH_BITS).alias("origins"),
        F.hll_sketch_agg("destination", SKETCH_BITS).alias("destinations"),
    )


def united_ends(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Estimates of `distinct_ends` from any rows of `end_sketches`, over all or per `by`."""
    united = sketches.groupBy(*(by or [])).agg(
        F.hll_union_agg("origins").alias("o"), F.hll_union_agg("destinations").alias("d")
    )
    return united.select(
        *(by or []),
        F.hll_sketch_estimate("o").alias("origins"),
        F.hll_sketch_estimate("d").alias("destinations"),
        F.hll_sketch_estimate(F.hll_union("o", "d")).alias("stations"),
    )


def most_connected(df: DataFrame, n: int = 10) -> DataFrame:
    """Names at either end by number of rows."""
    return (
        df.select(F.explode(F.array("origin", "destination")).alias("station"))
        .where(F.col("station").isNotNull())
        .groupBy("station")
        .agg(F.count("*").alias("connections"))
        .orderBy(F.desc("connections"), "station")
        .limit(n)
    )


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first of each logical key."""
    copies = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def match_rate(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.count(column).alias("matched"),
        F.count("*").alias("total"),
        F.try_divide(F.count(column), F.count("*")).alias("rate"),
    )


def counted(df: DataFrame, name: str) -> DataFrame:
    """The same rows, counted under `name` while some job reads them (no job of its own)."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))


# --- statistics by type ------------------------------------------------------
def stats_by_type(df: DataFrame, digits: int = 2) -> DataFrame:
    return df.where(F.col("vehicule_type").isNotNull()).groupBy("vehicule_type").agg(
        F.count("distance_km").alias("n"),
        *[
            F.round(fn("distance_km"), digits).alias(f"distance_{tag}")
            for tag, fn in (("mean", F.avg), ("min", F.min), ("max", F.max))
        ],
        *[
            F.round(fn("co2_kg"), digits).alias(f"co2_{tag}")
            for tag, fn in (("mean", F.avg), ("min", F.min), ("max", F.max))
        ],
    )


def train_rows(df: DataFrame) -> DataFrame:
    """Rows whose type name says train by the report's word list."""
    return df.where(matches(F.col("vehicule_type"), TRAIN_PATTERN))


def night_rows(df: DataFrame) -> DataFrame:
    return df.where(matches(F.col("vehicule_type"), NIGHT_PATTERN))


def _subset_columns(tag: str, member: Column) -> list[Column]:
    km, kg = F.when(member, F.col("distance_km")), F.when(member, F.col("co2_kg"))
    return [
        F.count_if(member).alias(f"{tag}_n"),
        F.avg(km).alias(f"{tag}_km"),
        F.avg(kg).alias(f"{tag}_kg"),
        F.try_divide(F.avg(kg), F.avg(km)).alias(f"{tag}_kg_per_km"),
        F.min(km).alias(f"{tag}_km_min"),
        F.max(km).alias(f"{tag}_km_max"),
    ]


def train_against_plane(df: DataFrame) -> DataFrame:
    """Statistics of both subsets in one pass, the intensity factor and the mean saving."""
    one = df.agg(
        *_subset_columns("train", matches(F.col("vehicule_type"), TRAIN_PATTERN)),
        *_subset_columns("plane", F.coalesce(F.col("vehicule_type") == C.PLANE, F.lit(False))),
    )
    return one.withColumns(
        {
            "factor": F.try_divide(F.col("plane_kg_per_km"), F.col("train_kg_per_km")),
            "saving_kg": F.col("plane_kg") - F.col("train_kg"),
        }
    )


def night_stats(df: DataFrame) -> DataFrame:
    return night_rows(df).agg(
        F.count("*").alias("n"), F.avg("distance_km").alias("km"), F.avg("co2_kg").alias("kg")
    )


def vehicle_stats(df: DataFrame, digits: int = 2) -> DataFrame:
    """Per type CO2 mean, sum and count and mean distance."""
    return df.groupBy("vehicule_type").agg(
        F.round(F.avg("co2_kg"), digits).alias("co2_mean"),
        F.round(F.sum("co2_kg"), digits).alias("co2_sum"),
        F.count("co2_kg").alias("n"),
        F.round(F.avg("distance_km"), digits).alias("distance_mean"),
    )


def mean_by(df: DataFrame, key: str, value: str, descending: bool) -> DataFrame:
    means = df.groupBy(key).agg(F.avg(value).alias(f"{value}_mean"))
    order = F.desc if descending else F.asc
    return means.orderBy(order(f"{value}_mean"), key)


def longest(df: DataFrame, n: int = 10, columns: list[str] | None = None) -> DataFrame:
    """The `n` longest rides; equal lengths by name and type."""
    wanted = columns or ["origin", "destination", "vehicule_type", "distance_km", "co2_kg"]
    ties = [c for c in wanted if c != "distance_km"]
    return (
        df.where(F.col("distance_km").isNotNull()).select(*wanted)
        .orderBy(F.desc("distance_km"), *ties).limit(n)
    )


# --- distributions -----------------------------------------------------------
def summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """(metric, n, sum, mean, std, min, max, q1, median, q3) per column."""
    long = df.select(*[F.col(c).cast("double") for c in columns]).unpivot([], columns, "metric", "value")
    basic = long.groupBy("metric").agg(
        F.count("value").alias("n"),
        F.sum("value").alias("sum"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(long, "value", [0.25, 0.5, 0.75], ["metric"])
    return basic.join(quartiles, "metric", "left").select(
        *basic.columns,
        *[F.get("quantiles", F.lit(i)).alias(q) for i, q in enumerate(("q1", "median", "q3"))],
    )


def describe(df: DataFrame, columns: list[str], digits: int = 2) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles, rounded."""
    rows = summary(df, columns).drop("sum")
    return rows.withColumns({c: F.round(c, digits) for c in rows.columns if c not in ("metric", "n")})


def _fences(quartiles: Column) -> tuple[Column, Column]:
    q1, q3 = F.get(quartiles, F.lit(0)), F.get(quartiles, F.lit(2))
    spread = (q3 - q1) * 1.5
    return q1 - spread, q3 + spread


def iqr_outliers(df: DataFrame, column: str) -> DataFrame:
    """Fences at 1.5 quartile distances and the number of values outside."""
    quartiles = exact_quantiles(df, column, [0.25, 0.5, 0.75])
    low, high = _fences(F.col("quartiles"))
    fences = quartiles.withColumnRenamed("quantiles", "quartiles").select(low.alias("low"), high.alias("high"))
    both = fences.select(F.struct("low", "high")).scalar()
    low, high = both["low"], both["high"]
    x = F.col(column)
    return df.agg(F.count_if((x < low) | (x > high)).alias("outliers")).select(
        low.alias("low"), high.alias("high"), "outliers"
    )


def box_stats(df: DataFrame, column: str, by: str) -> DataFrame:
    """Box plot numbers per group: quartiles and the last values inside the fences; the group with
    the largest median first."""
    quartiles = exact_quantiles(df, column, [0.25, 0.5, 0.75], [by])
    low, high = _fences(F.col("quantiles"))
    boxes = quartiles.select(F.col(by).alias("box"), "quantiles", low.alias("low"), high.alias("high"))
    x = F.col(column)
    inside = x.between(F.col("low"), F.col("high"))
    whiskers = (
        df.join(boxes, F.col(by).eqNullSafe(F.col("box")))
        .groupBy(by, "quantiles")
        .agg(
            F.count(column).alias("n"),
            F.min(F.when(inside, x)).alias("whisker_low"),
            F.max(F.when(inside, x)).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )
    return whiskers.select(
        by, "n",
        *[F.get("quantiles", F.lit(i)).alias(q) for i, q in enumerate(("q1", "median", "q3"))],
        "whisker_low", "whisker_high", "outliers",
    ).orderBy(F.desc("median"), by)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """(bin, low, high, n) of equal width over the value range; the last bin holds the maximum.

    Bins are numbered from 1 and all of them are there, empty or not.
    """
    values = df.select(F.col(column).cast("double").alias("x")).where(F.col("x").isNotNull())
    bounds = values.agg(F.struct(F.min("x").alias("low"), F.max("x").alias("high"))).scalar()
    low, high = bounds["low"], bounds["high"]
    width = (high - low) / bins
    place = F.coalesce(F.try_divide((F.col("x") - low) * bins, high - low), F.lit(0.0))
    slotted = values.select(F.least(F.floor(place) + 1, F.lit(bins)).cast("int").alias("bin"))
    counts = slotted.groupBy("bin").agg(F.count("*").alias("n"))
    all_bins = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return all_bins.join(counts, "bin", "left").select(
        "bin",
        (low + width * (F.col("bin") - 1)).alias("low"),
        (low + width * F.col("bin")).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(a, b, corr) for all ordered pairs from one aggregate; pairs of known values only.

    Covariance and deviation are the built-in ones, which merge means and products of deviations, so far-off
    values cost no digits. A column without spread has no correlation (NULL), also with itself.
    """
    pairs = [(c, c) for c in columns] + list(combinations(columns, 2))
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])

    def correlation(a: str, b: str) -> Column:
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        x, y = F.when(both, F.col(a)), F.when(both, F.col(b))
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

    row = values.agg(*[correlation(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"r{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
        for x, y in dict.fromkeys([(a, b), (b, a)])
    ]
    return row.select(F.inline(F.array(*cells)))


def correlation_with(df: DataFrame, columns: list[str], target: str, digits: int = 3) -> DataFrame:
    cells = correlations(df, columns).where((F.col("b") == target) & (F.col("a") != target))
    return cells.select(F.col("a").alias("column"), F.round("corr", digits).alias("corr")).orderBy(
        F.asc_nulls_last("corr"), "column"
    )


def saving_summary(df: DataFrame) -> DataFrame:
    """Mean saving and median plane/train ratio over corridors with a flight."""
    flown = df.where(F.col("co2_avion_kg").isNotNull())
    ratio = flown.select(F.try_divide("co2_avion_kg", "co2_train_kg").alias("ratio"))
    middle = exact_quantiles(ratio, "ratio", [0.5]).select(F.get("quantiles", F.lit(0))).scalar()
    return flown.agg(F.avg("co2_saved_kg").alias("mean_saving_kg")).withColumn("median_ratio", middle)


# --- dashboard ---------------------------------------------------------------
DASHBOARD_KEYS = ["distance_km", "co2_kg", "vehicule_type", "origine", "destination"]


def dashboard_rows(view: DataFrame, low: float | None = None, high: float | None = None) -> DataFrame:
    """Usable rows of the view with mode, train type, route texts and intensity."""
    numeric = view.withColumns(
        {c: F.col(c).try_cast("double") for c in ("distance_km", "co2_kg", "facteur_co2") if c in view.columns}
    )
    usable = numeric.dropna(subset=DASHBOARD_KEYS).where(
        (F.col("distance_km") > 0) & (F.col("co2_kg") >= 0)
    )
    if low is not None:
        usable = usable.where(F.col("distance_km") >= low)
    if high is not None:
        usable = usable.where(F.col("distance_km") <= high)
    cities = ("origine_ville", "destination_ville")
    ends = cities if set(cities) <= set(view.columns) else ("origine", "destination")
    return usable.withColumns(
        {
            "mode": mode_of(F.col("vehicule_type")),
            "train_type": day_or_night(F.col("vehicule_type")),
            "route": arrow(F.col("origine"), F.col("destination")),
            "city_route": arrow(F.col(ends[0]), F.col(ends[1])),
            "co2_par_km": intensity(F.col("co2_kg"), F.col("distance_km")),
        }
    )


def top_savings(rows: DataFrame, n: int = 15) -> DataFrame:
    """City pairs served by both modes with the largest saving, from one aggregate."""
    train, plane = (F.avg(F.when(F.col("mode") == m, F.col("co2_kg"))) for m in ("Train", "Avion"))
    saving = F.col("co2_avion") - F.col("co2_train")
    return (
        rows.groupBy(F.col("city_route").alias("route"))
        .agg(train.alias("co2_train"), plane.alias("co2_avion"))
        .withColumn("economie_kg", saving)
        .where(F.col("economie_kg") > 0)
        .withColumn("reduction_pct", F.round(F.try_divide(F.col("economie_kg") * 100, F.col("co2_avion")), 1))
        .orderBy(F.desc("economie_kg"), "route")
        .limit(n)
    )


def savings_mean(top: DataFrame) -> DataFrame:
    return top.agg(
        F.count("*").alias("routes"),
        F.avg("economie_kg").alias("economie_kg"),
        F.avg("reduction_pct").alias("reduction_pct"),
    )


def day_night_means(rows: DataFrame) -> DataFrame:
    return (
        rows.where((F.col("mode") == "Train") & F.col("train_type").isNotNull())
        .groupBy("train_type")
        .agg(F.avg("co2_kg").alias("co2_moyen"), F.count("co2_kg").alias("nb_trajets"))
    )


def train_detail(rows: DataFrame) -> DataFrame:
    return (
        rows.where(F.col("mode") == "Train")
        .groupBy("vehicule_type")
        .agg(
            F.count("co2_kg").alias("nb_trajets"),
            F.avg("co2_kg").alias("co2"),
            F.avg("distance_km").alias("km"),
        )
        .orderBy("co2", "vehicule_type")
        .select(
            "vehicule_type",
            "nb_trajets",
            F.round("co2", 2).alias("co2_moyen"),
            F.round("km", 1).alias("distance_moyenne"),
        )
    )


def kpis(rows: DataFrame) -> DataFrame:
    def kg(mode: str) -> Column:
        return F.avg(F.when(F.col("mode") == mode, F.col("co2_kg")))

    return rows.agg(
        F.count_if(F.col("mode") == "Train").alias("nb_train"),
        F.count_if(F.col("mode") == "Avion").alias("nb_avion"),
        kg("Train").alias("co2_train"),
        kg("Avion").alias("co2_avion"),
    ).withColumn(
        "ratio",
        F.when(F.col("co2_train") > 0, F.col("co2_avion") / F.col("co2_train")).otherwise(F.lit(0.0)),
    )


def category_boxes(view: DataFrame, limit: str = "500") -> DataFrame:
    """CO2 box numbers of short and long rides."""
    labelled = view.withColumn("categorie", distance_category(F.col("is_long_distance"), limit))
    return box_stats(labelled.where(F.col("categorie").isNotNull()), "co2_kg", "categorie")


def map_lines(fact: DataFrame) -> DataFrame:
    """One line per placed corridor: both ends, class and texts."""
    placed = fact.dropna(
        subset=["station_lat", "station_long", "station_lat_dest", "station_long_dest"]
    )
    saved = F.when(F.col("co2_saved_kg").isNull(), F.lit("N/A")).otherwise(
        F.format_string("%.1fkg", F.col("co2_saved_kg"))
    )
    return placed.select(
        "station_lat", "station_long", "station_lat_dest", "station_long_dest",
        F.when(F.col("is_substitutable") == 1, F.lit("substituable"))
        .otherwise(F.lit("non substituable")).alias("classe"),
        arrow(F.col("origin"), F.col("destination")).alias("route"),
        F.round("distance_km", 0).alias("km"),
        saved.alias("co2_saved"),
    )


def sections(tables: dict[str, DataFrame]) -> DataFrame:
    """Tables as one long relation (section, row), each row as JSON."""
    parts = [
        df.select(F.lit(name).alias("section"), F.to_json(F.struct(*df.columns)).alias("row"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
