"""The three questions users ask of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railmart import constants as C
from railmart.functions.text import contains_ignore_case

VIEW_ORDER = ["origine", "destination", "vehicule_type", "co2_kg"]


def data_view(
    fact: DataFrame, routes: DataFrame, vehicles: DataFrame, limit: int | None = None
) -> DataFrame:
    """One row per corridor and vehicle: the train rows, and one flight row per corridor that has one."""
    joined = fact.join(routes, "route_id").join(vehicles, "vehicle_type_id")
    train = F.struct(
        F.col("label").alias("vehicule_type"), F.col("co2_vt").cast("double").alias("facteur_co2"),
        F.col("co2_train_kg").cast("double").alias("co2_kg"),
    )
    rows = joined.select("*", train.alias("ride"))
    # a corridor has one flight however many train types serve it
    flights = (
        fact.where(F.col("co2_avion_kg").isNotNull())
        .groupBy("route_id").agg(F.min("co2_avion_kg").alias("co2_avion_kg"))
        .join(routes, "route_id")
        .select(
            "*",
            F.struct(
                F.lit(C.PLANE).alias("vehicule_type"), F.lit(None).cast("double").alias("facteur_co2"),
                F.col("co2_avion_kg").cast("double").alias("co2_kg"),
            ).alias("ride"),
        )
    )
    view = _view_columns(rows).unionByName(_view_columns(flights))
    return view.orderBy(*VIEW_ORDER).limit(limit) if limit else view


def _view_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("dep_name").alias("origine"),
        F.col("arr_name").alias("destination"),
        F.coalesce("dep_city", "dep_name").alias("origine_ville"),
        F.coalesce("arr_city", "arr_name").alias("destination_ville"),
        F.col("distance_km").cast("double").alias("distance_km"),
        "is_long_distance",
        "ride.vehicule_type",
        "ride.facteur_co2",
        "ride.co2_kg",
    )


def search(
    view: DataFrame,
    depart: str,
    arrivee: str,
    vehicle_type: str | None = None,
    literal: bool = False,
) -> DataFrame:
    """Rides whose ends (and type) contain the given texts, without regard to case; no hit is no row."""
    hits = view.where(
        contains_ignore_case(F.col("origine"), depart, literal)
        & contains_ignore_case(F.col("destination"), arrivee, literal)
    )
    if vehicle_type:
        hits = hits.where(contains_ignore_case(F.col("vehicule_type"), vehicle_type, literal))
    return hits.select(
        F.col("origine").alias("depart"), F.col("destination").alias("arrivee"),
        "distance_km", "vehicule_type", "co2_kg",
    )


def compare(view: DataFrame, depart: str, arrivee: str, literal: bool = False) -> DataFrame:
    """Day against night trains of a connection, one row; no row when there is no day train.

    The gain is taken from the rounded means, as users see them.
    """
    rides = view.where(
        contains_ignore_case(F.col("origine"), depart, literal)
        & contains_ignore_case(F.col("destination"), arrivee, literal)
        & (F.col("vehicule_type") != C.PLANE)
    )
    return compare_rides(rides, F.col("vehicule_type").ilike("%nuit%"), depart, arrivee)


def compare_rides(rides: DataFrame, night: Column, depart: str, arrivee: str) -> DataFrame:
    def stats(tag: str, member: Column) -> list[Column]:
        kg = F.when(member, F.col("co2_kg"))
        return [
            F.round(F.avg(kg), 2).alias(f"{tag}_mean"),
            F.count_if(member).alias(f"{tag}_n"),
            F.round(F.min(kg), 2).alias(f"{tag}_min"),
            F.round(F.max(kg), 2).alias(f"{tag}_max"),
        ]

    row = rides.agg(*stats("day", ~night), *stats("night", night)).where(F.col("day_mean").isNotNull())
    has_night = F.col("night_mean").isNotNull()
    gain = F.when(
        has_night,
        F.round(F.try_divide(F.col("day_mean") - F.col("night_mean"), F.col("day_mean")) * 100, 1),
    ).otherwise(F.lit(0.0))
    filled = row.withColumn("gain_pct", gain).withColumns(
        {c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("night_mean", "night_min", "night_max")}
    ).withColumn("night_n", F.when(has_night, F.col("night_n")).otherwise(F.lit(0)))
    return filled.withColumn("has_night", F.col("night_n") > 0).select(
        F.lit(depart).alias("depart"), F.lit(arrivee).alias("arrivee"),
        *[c for c in filled.columns],
        advice(F.col("has_night"), F.col("gain_pct")).alias("advice"),
    )


def advice(has_night: Column, gain_pct: Column) -> Column:
    """The verdict as a code; the numbers stand beside it."""
    return (
        F.when(~has_night, F.lit("no_night_train"))
        .when(gain_pct > 15, F.lit("night_train"))
        .when(gain_pct > 0, F.lit("slightly_night"))
        .when(gain_pct < -15, F.lit("day_train"))
        .otherwise(F.lit("similar"))
    )


def advice_text(row: dict) -> str:
    """Sentence for one row of `compare` (a caller's few rows, after the query)."""
    gain = row["gain_pct"]
    return {
        "no_night_train": f"Aucun train de nuit entre {row['depart']} et {row['arrivee']}",
        "night_train": f"Train de nuit recommandé : {gain}% de CO2 en moins",
        "slightly_night": f"Léger avantage au train de nuit : {gain}%",
        "day_train": f"Train de jour recommandé : {abs(gain)}% de CO2 en moins",
        "similar": f"Impact similaire ({abs(gain)}% d'écart)",
    }[row["advice"]]


# documented warehouse queries -------------------------------------------------
def top_routes(view: DataFrame, n: int = 10) -> DataFrame:
    """Connections with the highest mean CO2."""
    return (
        view.groupBy("origine", "destination")
        .agg(F.avg("co2_kg").alias("avg_co2"), F.count("*").alias("n"))
        .orderBy(F.desc("avg_co2"), "origine", "destination")
        .limit(n)
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts of several tables in one row."""
    names = list(tables)
    first = tables[names[0]].agg(F.count("*").alias(names[0]))
    return first.select(
        names[0],
        *[tables[name].agg(F.count("*")).scalar().alias(name) for name in names[1:]],
    )


def average_by_type(view: DataFrame, depart: str, arrivee: str) -> DataFrame:
    return (
        view.where(
            contains_ignore_case(F.col("origine"), depart)
            & contains_ignore_case(F.col("destination"), arrivee)
        )
        .groupBy("vehicule_type")
        .agg(F.avg("co2_kg").alias("avg_co2"), F.count("*").alias("n"))
        .orderBy("vehicule_type")
    )
