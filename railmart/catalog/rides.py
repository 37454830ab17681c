"""Descriptive statistics over rides."""

from __future__ import annotations

from pyspark.sql import functions as F

from railmart.catalog import standins as S
from railmart.operators import profile as P
from railmart.operators.quantiles import median
from railmart.session import cut_lineage

ENDS = ["origins", "destinations", "stations"]
COMPLETE = ["distance_km", "co2_kg", "departure_time", "station_lat"]
MONEY = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def rows_of_view(spark, sf):
    return P.dashboard_rows(S.view(spark, sf))


def stored_rides(spark, sf):
    """Rides as a table, for the statistics that pass over them more than once."""
    return cut_lineage(S.rides(spark, sf).select("vehicule_type", "distance_km", "co2_kg"))


def lines(spark, sf):
    return S.table(spark, sf, "lineitem")


def overview(spark, sf):
    return P.overview(S.rides(spark, sf))


def freq_share(spark, sf):
    return S.rounded(P.frequencies(S.rides(spark, sf), "vehicule_type"), 4, "pct")


def stats_by_type(spark, sf):
    return P.stats_by_type(S.rides(spark, sf), digits=4)


def subset_intensity(spark, sf):
    return S.rounded(P.train_against_plane(S.rides(spark, sf)), 4, " ".join(SUBSET_DOUBLES))


SUBSET_DOUBLES = [
    f"{side}_{column}"
    for side in ("train", "plane")
    for column in ("km", "kg", "kg_per_km", "km_min", "km_max")
] + ["factor", "saving_kg"]


def night_breakdown(spark, sf):
    return S.rounded(P.frequencies(P.night_rows(S.rides(spark, sf)), "vehicule_type"), 4, "pct")


def night_stats(spark, sf):
    return S.rounded(P.night_stats(S.rides(spark, sf)), 4, "km kg")


def coverage_distinct(spark, sf):
    return P.distinct_ends(S.legs(spark, sf))


def coverage_sketch(spark, sf):
    """Exact distinct ends, and whether the estimates from the stored sketches of all feeds are within 5% of them."""
    legs = S.legs(spark, sf)
    stored = cut_lineage(P.end_sketches(legs, ["provider"]))
    guessed = P.united_ends(stored).select(F.struct(*ENDS)).scalar()  # one row
    exact = P.distinct_ends(legs).withColumn("guessed", guessed)
    near = {f"{c}_near": F.abs(F.col(f"guessed.{c}") - F.col(c)) <= F.col(c) * 0.05 for c in ENDS}
    return exact.withColumns(near).select(*ENDS, *near)


def node_degree_top(spark, sf):
    return P.most_connected(S.legs(spark, sf))


def completeness(spark, sf):
    return S.rounded(P.completeness(S.rides(spark, sf), COMPLETE), 4, "pct")


def labelled(spark, sf):
    return S.table(spark, sf, "documents").join(S.table(spark, sf, "labels"), "doc_id", "left").select(
        "doc_id", "lang", "quality", "toxic"
    )


def null_profile(spark, sf):
    return P.null_counts(labelled(spark, sf))


def column_profile(spark, sf):
    return P.column_profile(labelled(spark, sf))


def summary_stats(spark, sf):
    stats = P.summary(stored_rides(spark, sf), ["distance_km", "co2_kg"])
    return S.rounded(stats, 4, "sum mean std min max q1 median q3")


def describe_exact(spark, sf):
    return P.describe(lines(spark, sf), MONEY, digits=4)


def by_vehicle(spark, sf):
    return P.vehicle_stats(S.rides(spark, sf), digits=4)


def by_mode(spark, sf):
    return S.rounded(P.mean_by(rows_of_view(spark, sf), "mode", "co2_kg", True), 4, "co2_kg_mean")


def intensity_by_type(spark, sf):
    return S.rounded(P.mean_by(rows_of_view(spark, sf), "vehicule_type", "co2_par_km", False), 6, "co2_par_km_mean")


def distance_category(spark, sf):
    boxes = P.category_boxes(cut_lineage(S.view(spark, sf).select("is_long_distance", "co2_kg")))
    return S.rounded(boxes, 4, "q1 median q3 whisker_low whisker_high")


def dashboard_clean(spark, sf):
    rows = P.dashboard_rows(S.view(spark, sf), 200, 700).select(
        "origine", "destination", "mode", F.coalesce("train_type", F.lit("-")).alias("train_type"), "route",
        "city_route", "distance_km", "co2_par_km",
    )
    return S.rounded(rows, 6, "distance_km co2_par_km")


def top_savings(spark, sf):
    return S.rounded(P.top_savings(rows_of_view(spark, sf)), 4, "co2_train co2_avion economie_kg")


def savings_mean(spark, sf):
    return S.rounded(P.savings_mean(P.top_savings(rows_of_view(spark, sf))), 4, "economie_kg reduction_pct")


def day_night_trains(spark, sf):
    return S.rounded(P.day_night_means(rows_of_view(spark, sf)), 4, "co2_moyen")


def train_detail(spark, sf):
    return P.train_detail(rows_of_view(spark, sf))


def kpis(spark, sf):
    return S.rounded(P.kpis(rows_of_view(spark, sf)), 4, "co2_train co2_avion ratio")


def dup_count(spark, sf):
    return P.duplicate_rows(lines(spark, sf), ["l_orderkey", "l_linenumber"])


def iqr_outliers(spark, sf):
    return S.rounded(P.iqr_outliers(cut_lineage(rows_of_view(spark, sf).select("co2_kg")), "co2_kg"), 4, "low high")


def histogram(spark, sf):
    return S.rounded(P.histogram(lines(spark, sf), "l_extendedprice", 40), 4, "low high")


def box_stats(spark, sf):
    boxes = P.box_stats(stored_rides(spark, sf).where(F.col("co2_kg").isNotNull()), "co2_kg", "vehicule_type")
    return S.rounded(boxes, 4, "q1 median q3 whisker_low whisker_high")


def ratio_median(spark, sf):
    """Discounted price against tax, standing for flight against train."""
    fact = lines(spark, sf).select(
        F.when(F.col("l_discount") > 0.02, F.col("l_extendedprice")).alias("co2_avion_kg"),
        F.col("l_quantity").alias("co2_train_kg"),
        (F.col("l_extendedprice") - F.col("l_quantity")).alias("co2_saved_kg"),
    )
    return S.rounded(P.saving_summary(fact), 4, "mean_saving_kg median_ratio")


def median_by_type(spark, sf):
    """Median value by event type, largest first (the order of the box plots)."""
    return S.rounded(median(S.table(spark, sf, "events"), "value", ["event_type"]), 4, "median")


def correlated(spark, sf):
    return lines(spark, sf).select(*MONEY, F.when(F.col("l_returnflag") == "R", F.col("l_tax")).alias("partial"), F.lit(1.0).alias("constant"))


def corr_matrix(spark, sf):
    return S.rounded(P.correlations(correlated(spark, sf), [*MONEY, "partial", "constant"]), 6, "corr")


def corr_target(spark, sf):
    return P.correlation_with(correlated(spark, sf), [*MONEY, "partial"], "l_extendedprice", digits=6)


def class_counts(spark, sf):
    return S.rounded(P.frequencies(S.table(spark, sf, "labels"), "quality"), 4, "pct")


def top_longest(spark, sf):
    rides = S.rides(spark, sf).withColumn("route", P.arrow(F.col("origin"), F.col("destination")))
    top = P.longest(rides, 15, ["route", "vehicule_type", "departure_time", "distance_km", "co2_kg"])
    return S.rounded(top, 4, "distance_km co2_kg")


QUERIES = {
    f.__name__: f
    for f in (
        overview, freq_share, stats_by_type, subset_intensity, night_breakdown, night_stats,
        coverage_distinct, coverage_sketch, node_degree_top, completeness, null_profile, column_profile, summary_stats,
        describe_exact, by_vehicle, by_mode, intensity_by_type, distance_category, dashboard_clean,
        top_savings, savings_mean, day_night_trains, train_detail, kpis, dup_count, iqr_outliers,
        histogram, box_stats, ratio_median, median_by_type, corr_matrix, corr_target, class_counts,
        top_longest,
    )
}

# --- SQL ------------------------------------------------------------------------------
DASH = """(SELECT *, CASE WHEN contains(vehicule_type, 'Avion') THEN 'Avion' ELSE 'Train' END AS mode,
  CASE WHEN contains(vehicule_type, 'Nuit') OR vehicule_type IN ('EuroNight', 'Nightjet') THEN 'Nuit'
    WHEN NOT contains(vehicule_type, 'Avion') THEN 'Jour' END AS train_type,
  origine || ' → ' || destination AS route, origine_ville || ' → ' || destination_ville AS city_route,
  co2_kg / distance_km AS co2_par_km FROM ride_view WHERE distance_km > 0 AND co2_kg >= 0)"""
IS_TRAIN = "regexp_matches(vehicule_type, 'Train|Night|Euro|City')"
IS_NIGHT = "regexp_matches(vehicule_type, 'Nuit|Night')"


def subset_sql(side: str, member: str) -> str:
    return f"""count(*) FILTER ({member}) AS {side}_n, avg(distance_km) FILTER ({member}) AS {side}_km,
  avg(co2_kg) FILTER ({member}) AS {side}_kg,
  avg(co2_kg) FILTER ({member}) / avg(distance_km) FILTER ({member}) AS {side}_kg_per_km,
  min(distance_km) FILTER ({member}) AS {side}_km_min, max(distance_km) FILTER ({member}) AS {side}_km_max"""


def summary_sql(source: str, columns: list[str], with_sum: bool) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS metric, count({c}) AS n, {f"sum({c}) AS sum," if with_sum else ""} avg({c}) AS mean,
  stddev_samp({c}) AS std, min({c}) AS min, max({c}) AS max, quantile_cont({c}, 0.25) AS q1,
  quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3 FROM {source}"""
        for c in columns
    )


def box_sql(source: str, column: str, by: str) -> str:
    return f"""SELECT b.{by} AS {by}, count(x) AS n, q1, median, q3,
  min(x) FILTER (x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
  max(x) FILTER (x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
  count(*) FILTER (x NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
  FROM (SELECT {by}, {column} AS x FROM {source}) s JOIN (SELECT {by}, quantile_cont({column}, 0.25) AS q1,
    quantile_cont({column}, 0.5) AS median, quantile_cont({column}, 0.75) AS q3 FROM {source} GROUP BY {by}) b
  ON s.{by} = b.{by} GROUP BY b.{by}, q1, median, q3"""


CORRELATED = """(SELECT l_quantity, l_extendedprice, l_discount, l_tax,
  CASE WHEN l_returnflag = 'R' THEN l_tax END AS "partial", 1e0 AS constant FROM lineitem)"""


def corr_sql(columns: list[str]) -> str:
    def one(a: str, b: str) -> str:
        value = "max(CAST(NULL AS DOUBLE))" if "constant" in (a, b) else f'corr("{a}", "{b}")'
        return f"SELECT '{a}' AS a, '{b}' AS b, {value} AS corr FROM {CORRELATED}"

    return " UNION ALL ".join(one(a, b) for a in columns for b in columns)


CATEGORY = """(SELECT *, CASE WHEN is_long_distance THEN 'Longue distance (>500km)'
  WHEN NOT is_long_distance THEN 'Courte distance (≤500km)' END AS categorie FROM ride_view
  WHERE is_long_distance IS NOT NULL)"""
TOP = f"""SELECT city_route AS route, avg(co2_kg) FILTER (mode = 'Train') AS co2_train,
  avg(co2_kg) FILTER (mode = 'Avion') AS co2_avion FROM {DASH} GROUP BY 1"""
SAVINGS = f"""SELECT route, co2_train, co2_avion, co2_avion - co2_train AS economie_kg,
  round((co2_avion - co2_train) * 100 / co2_avion, 1) AS reduction_pct FROM ({TOP})
  WHERE co2_avion - co2_train > 0 ORDER BY economie_kg DESC, route LIMIT 15"""
LABELLED = "(SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))"


def share_sql(source: str, column: str) -> str:
    return f"""SELECT {column}, count(*) AS n, count(*) * 100e0 / (SELECT count(*) FROM {source}) AS pct
  FROM {source} WHERE {column} IS NOT NULL GROUP BY {column}"""


SQL = {
    "overview": S.sql(
        """SELECT count(*) AS total, count(distance_km) AS with_distance,
        count(*) - count(distance_km) AS without_distance FROM rides"""),
    "freq_share": S.sql(share_sql("rides", "vehicule_type"), 4, "pct"),
    "stats_by_type": S.sql(
        """SELECT vehicule_type, count(distance_km) AS n, avg(distance_km) AS distance_mean, min(distance_km)
        AS distance_min, max(distance_km) AS distance_max, avg(co2_kg) AS co2_mean, min(co2_kg) AS co2_min,
        max(co2_kg) AS co2_max FROM rides GROUP BY 1""",
        4, "distance_mean distance_min distance_max co2_mean co2_min co2_max"),
    "subset_intensity": S.sql(
        f"""SELECT *, plane_kg_per_km / train_kg_per_km AS factor, plane_kg - train_kg AS saving_kg FROM (
        SELECT {subset_sql('train', IS_TRAIN)}, {subset_sql('plane', "vehicule_type = 'Avion'")} FROM rides)""",
        4, " ".join(SUBSET_DOUBLES)),
    "night_breakdown": S.sql(
        share_sql(f"(SELECT vehicule_type FROM rides WHERE {IS_NIGHT})", "vehicule_type"), 4, "pct"),
    "night_stats": S.sql(
        f"SELECT count(*) AS n, avg(distance_km) AS km, avg(co2_kg) AS kg FROM rides WHERE {IS_NIGHT}", 4, "km kg"),
    "coverage_distinct": S.sql(
        """SELECT (SELECT count(DISTINCT origin) FROM legs) AS origins, (SELECT count(DISTINCT destination) FROM legs)
        AS destinations, (SELECT count(*) FROM (SELECT origin FROM legs UNION SELECT destination FROM legs)) AS stations"""),
    "coverage_sketch": S.sql(
        """SELECT *, true AS origins_near, true AS destinations_near, true AS stations_near FROM (
        SELECT (SELECT count(DISTINCT origin) FROM legs) AS origins, (SELECT count(DISTINCT destination) FROM legs)
        AS destinations, (SELECT count(*) FROM (SELECT origin FROM legs UNION SELECT destination FROM legs)) AS stations)"""),
    "node_degree_top": S.sql(
        """SELECT station, count(*) AS connections FROM (SELECT origin AS station FROM legs UNION ALL
        SELECT destination FROM legs) GROUP BY 1 ORDER BY connections DESC, station LIMIT 10"""),
    "completeness": S.sql(
        """SELECT c AS "column", filled, filled * 100e0 / total AS pct FROM (SELECT count(*) AS total,
        unnest(['distance_km', 'co2_kg', 'departure_time', 'station_lat']) AS c, unnest([count(distance_km),
        count(co2_kg), count(departure_time), count(station_lat)]) AS filled FROM rides)""", 4, "pct"),
    "null_profile": f"""SELECT unnest(['doc_id', 'lang', 'quality', 'toxic']) AS "column",
        unnest([count(*) - count(doc_id), count(*) - count(lang), count(*) - count(quality), count(*) - count(toxic)])
        AS nulls FROM {LABELLED}""",
    "column_profile": f"""SELECT c AS "column", t AS type, filled, total - filled AS nulls,
        round((total - filled) * 100e0 / total, 1) AS null_pct FROM (SELECT count(*) AS total,
        unnest(['doc_id', 'lang', 'quality', 'toxic']) AS c, unnest(['bigint', 'string', 'int', 'int']) AS t,
        unnest([count(doc_id), count(lang), count(quality), count(toxic)]) AS filled FROM {LABELLED})""",
    "summary_stats": S.sql(
        summary_sql("rides", ["distance_km", "co2_kg"], True), 4, "sum mean std min max q1 median q3"),
    "describe_exact": S.sql(summary_sql("lineitem", MONEY, False), 4, "mean std min max q1 median q3"),
    "by_vehicle": S.sql(
        """SELECT vehicule_type, avg(co2_kg) AS co2_mean, sum(co2_kg) AS co2_sum, count(co2_kg) AS n,
        avg(distance_km) AS distance_mean FROM rides GROUP BY 1""", 4, "co2_mean co2_sum distance_mean"),
    "by_mode": S.sql(f"SELECT mode, avg(co2_kg) AS co2_kg_mean FROM {DASH} GROUP BY 1", 4, "co2_kg_mean"),
    "intensity_by_type": S.sql(
        f"SELECT vehicule_type, avg(co2_par_km) AS co2_par_km_mean FROM {DASH} GROUP BY 1", 6, "co2_par_km_mean"),
    "distance_category": S.sql(
        box_sql(CATEGORY, "co2_kg", "categorie"), 4, "q1 median q3 whisker_low whisker_high"),
    "dashboard_clean": S.sql(
        f"""SELECT origine, destination, mode, coalesce(train_type, '-') AS train_type, route, city_route, distance_km,
        co2_par_km FROM {DASH} WHERE distance_km BETWEEN 200 AND 700""", 6, "distance_km co2_par_km"),
    "top_savings": S.sql(SAVINGS, 4, "co2_train co2_avion economie_kg"),
    "savings_mean": S.sql(
        f"""SELECT count(*) AS routes, avg(economie_kg) AS economie_kg, avg(reduction_pct) AS reduction_pct
        FROM ({SAVINGS})""", 4, "economie_kg reduction_pct"),
    "day_night_trains": S.sql(
        f"""SELECT train_type, avg(co2_kg) AS co2_moyen, count(co2_kg) AS nb_trajets FROM {DASH}
        WHERE mode = 'Train' AND train_type IS NOT NULL GROUP BY 1""", 4, "co2_moyen"),
    "train_detail": S.sql(
        f"""SELECT vehicule_type, count(co2_kg) AS nb_trajets, round(avg(co2_kg), 2) AS co2_moyen,
        round(avg(distance_km), 1) AS distance_moyenne FROM {DASH} WHERE mode = 'Train' GROUP BY 1"""),
    "kpis": S.sql(
        f"""SELECT *, CASE WHEN co2_train > 0 THEN co2_avion / co2_train ELSE 0 END AS ratio FROM (
        SELECT count(*) FILTER (mode = 'Train') AS nb_train, count(*) FILTER (mode = 'Avion') AS nb_avion,
        avg(co2_kg) FILTER (mode = 'Train') AS co2_train, avg(co2_kg) FILTER (mode = 'Avion') AS co2_avion
        FROM {DASH})""", 4, "co2_train co2_avion ratio"),
    "dup_count": """SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM lineitem
        GROUP BY l_orderkey, l_linenumber)""",
    "iqr_outliers": S.sql(
        f"""SELECT low, high, count(*) FILTER (co2_kg < low OR co2_kg > high) AS outliers FROM {DASH},
        (SELECT q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM (SELECT quantile_cont(co2_kg, 0.25)
        AS q1, quantile_cont(co2_kg, 0.75) AS q3 FROM {DASH})) GROUP BY low, high""", 4, "low high"),
    "histogram": S.sql(
        """SELECT bin, lo + (hi - lo) / 40 * (bin - 1) AS low, lo + (hi - lo) / 40 * bin AS high,
        coalesce(n, 0) AS n FROM (SELECT CAST(unnest(range(1, 41)) AS INTEGER) AS bin),
        (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem) LEFT JOIN
        (SELECT CAST(least(1 + floor((l_extendedprice - l) * 40 / (h - l)), 40) AS INTEGER) AS slot, count(*) AS n
          FROM lineitem, (SELECT min(l_extendedprice) AS l, max(l_extendedprice) AS h FROM lineitem) GROUP BY 1)
        ON slot = bin""", 4, "low high"),
    "box_stats": S.sql(
        box_sql("(SELECT * FROM rides WHERE co2_kg IS NOT NULL)", "co2_kg", "vehicule_type"),
        4, "q1 median q3 whisker_low whisker_high"),
    "ratio_median": S.sql(
        """SELECT avg(l_extendedprice - l_quantity) AS mean_saving_kg, quantile_cont(l_extendedprice / l_quantity, 0.5)
        AS median_ratio FROM lineitem WHERE l_discount > 0.02e0""", 4, "mean_saving_kg median_ratio"),
    "median_by_type": S.sql(
        "SELECT event_type, quantile_cont(value, 0.5) AS median FROM events GROUP BY 1", 4, "median"),
    "corr_matrix": S.sql(corr_sql([*MONEY, "partial", "constant"]), 6, "corr"),
    "corr_target": S.sql(
        f"""SELECT a AS "column", corr FROM ({corr_sql([*MONEY, 'partial'])}) WHERE b = 'l_extendedprice'
        AND a <> 'l_extendedprice'""", 6, "corr"),
    "class_counts": S.sql(share_sql("labels", "quality"), 4, "pct"),
    "top_longest": S.sql(
        """SELECT origin || ' → ' || destination AS route, vehicule_type, departure_time, distance_km, co2_kg
        FROM rides WHERE distance_km IS NOT NULL ORDER BY distance_km DESC, route, vehicule_type, departure_time,
        co2_kg LIMIT 15""", 4, "distance_km co2_kg"),
}
