"""Report, dashboards and data profile as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railmart.operators import profile as P

REPORT_COLUMNS = ["distance_km", "co2_kg", "departure_time", "arrival_time"]
VIEW_KEYS = ["origine", "destination", "vehicule_type", "distance_km", "co2_kg"]
NUMERIC = [
    "distance_km", "co2_train_kg", "co2_avion_kg", "co2_saved_kg",
    "origin_station_traffic", "origin_city_population",
    "dest_station_traffic", "dest_city_population",
]
CORRELATED = [
    "distance_km", "co2_train_kg", "co2_avion_kg", "co2_saved_kg",
    "origin_station_traffic", "origin_city_population", "is_substitutable",
]


def report(routes: DataFrame) -> dict[str, DataFrame]:
    """The analysis report on the final relation, one table per section."""
    with_mode = routes.where(F.col("vehicule_type").isNotNull())
    return {
        "overview": P.overview(routes),
        "sources": P.frequencies(routes, "source"),
        "types": P.frequencies(routes, "vehicule_type"),
        "stats_by_type": P.stats_by_type(with_mode),
        "longest": P.longest(routes),
        "train_against_plane": P.train_against_plane(routes),
        "train_types": P.frequencies(P.train_rows(routes), "vehicule_type"),
        "night": P.night_stats(routes),
        "night_types": P.frequencies(P.night_rows(routes), "vehicule_type"),
        "coverage": P.distinct_ends(routes),
        "most_connected": P.most_connected(routes),
        "quality": P.completeness(routes, REPORT_COLUMNS),
    }


def charts(view: DataFrame, n: int = 15) -> dict[str, DataFrame]:
    """Tables behind the static charts."""
    named = view.withColumn("route", P.arrow(F.col("origine"), F.col("destination")))
    return {
        "summary": P.summary(view, ["distance_km", "co2_kg"]),
        "distance_histogram": P.histogram(view, "distance_km", 50),
        "co2_histogram": P.histogram(view, "co2_kg", 50),
        "distance_co2": view.select("distance_km", "co2_kg", "vehicule_type"),
        "top_routes": P.longest(named, n, ["route", "distance_km", "co2_kg"]),
        "by_vehicle": P.vehicle_stats(view),
        "categories": P.category_boxes(view),
    }


def dashboard(
    view: DataFrame, n: int = 15, low: float | None = None, high: float | None = None
) -> dict[str, DataFrame]:
    """Tables behind the four tabs, for a distance range."""
    rows = P.dashboard_rows(view, low, high)
    train_rows = rows.where(F.col("mode") == "Train")
    top = P.top_savings(rows, n)
    return {
        "rows": rows,
        "kpis": P.kpis(rows),
        "co2_by_mode": P.mean_by(rows, "mode", "co2_kg", descending=True),
        "intensity": P.mean_by(rows, "vehicule_type", "co2_par_km", descending=False),
        "day_night_counts": P.frequencies(train_rows, "train_type"),
        "day_night": P.day_night_means(rows),
        "train_detail": P.train_detail(rows),
        "top_savings": top,
        "savings_mean": P.savings_mean(top),
        "modes": P.frequencies(rows, "mode"),
        "nulls": P.null_counts(rows),
        "quality": P.null_total(rows),
        "duplicates": P.duplicate_rows(rows, VIEW_KEYS),
        "outliers": P.iqr_outliers(rows, "co2_kg"),
    }


def explore(fact: DataFrame) -> dict[str, DataFrame]:
    """The data profile of the wide fact."""
    flown = fact.where(F.col("co2_avion_kg").isNotNull())
    return {
        "columns": P.column_profile(fact),
        "describe": P.describe(fact, NUMERIC),
        "classes": P.frequencies(fact, "is_substitutable"),
        **{f"histogram_{c}": P.histogram(fact, c, 40) for c in NUMERIC[:4]},
        "histogram_traffic_millions": P.histogram(
            fact.select((F.col("origin_station_traffic") / 1e6).alias("x")), "x", 30
        ),
        "histogram_population_thousands": P.histogram(
            fact.select((F.col("origin_city_population") / 1e3).alias("x")), "x", 30
        ),
        "coverage": P.completeness(fact, ["origin_station_traffic", "origin_city_population"]),
        "saving_by_type": P.box_stats(flown, "co2_saved_kg", "vehicule_type"),
        "saving": P.saving_summary(fact),
        "correlations": P.correlations(fact, CORRELATED),
        "target_correlations": P.correlation_with(fact, CORRELATED, "is_substitutable"),
        "nulls": P.null_counts(fact).where(F.col("nulls") > 0),
        "map_lines": P.map_lines(fact),
    }
