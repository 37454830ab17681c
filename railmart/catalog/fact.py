"""The star schema and the questions asked of it."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from railmart.catalog import standins as S
from railmart.operators.numbering import category_codes, dense_ids, hash_key, key_collisions
from railmart.operators.profile import completeness, match_rate
from railmart.operators.split import (
    apply_scaler, class_balance, encode, exact_split, fit_scaler, model_columns, sample_rows,
)
from railmart.operators.star import (
    dim_route, dim_station, dim_vehicle_type, duplicate_keys, fact_corridors, fact_wide, orphans,
    planes, resolve_keys, trains, upsert, warehouse_types,
)
from railmart.plans import modelling, queries
from railmart.plans.merging import merge
from railmart.session import cut_lineage, drop_staged, staging_folder

FACT_COLUMNS = [
    "origin", "destination", "vehicule_type", "co2_train_kg", "co2_avion_kg", "co2_saved_kg",
    "is_substitutable", "distance_km",
]
KG = "co2_train_kg co2_avion_kg co2_saved_kg distance_km"


def final_routes(spark, sf):
    kept = S.routes(spark, sf).select(
        "origin", "destination", "vehicule_type", "origin_city", "distance_km", "co2_kg",
        "departure_time", "arrival_time", "source", "provider",
    )
    return S.rounded(kept, 4, "distance_km co2_kg")


def mode_split(spark, sf):
    """Trains and flights of the final relation, counted on either side of the split."""
    routes = S.routes(spark, sf)
    sides = trains(routes).select(F.lit("train").alias("side"), "origin").unionByName(
        planes(routes).select(F.lit("plane").alias("side"), "origin")
    )
    return sides.groupBy("side", "origin").agg(F.count("*").alias("n"))


def vehicles(spark, sf):
    return dim_vehicle_type(S.routes(spark, sf)).drop("vehicle_type_id")


def routes_dimension(spark, sf):
    return S.rounded(dim_route(S.routes(spark, sf)).drop("route_id"), 4, "distance_km")


def stations_dimension(spark, sf):
    stations = dim_station(fact_corridors(S.routes(spark, sf)))
    return S.rounded(stations.select("station_name", "city", "lat", "lon"), 2, "lat lon")


def staged_fact(spark, sf):
    """The fact as a table of its own, in the place of the routes it is made from."""
    routes = S.routes(spark, sf)
    fact = cut_lineage(fact_corridors(routes))
    drop_staged(routes)
    return fact


def fact_corridor(spark, sf):
    return S.rounded(fact_corridors(S.routes(spark, sf)).select(*FACT_COLUMNS), 4, KG)


def merge_incremental(spark, sf):
    """The fact after three loads that merge: two feeds, part of a third, then that one in full with all others."""
    rail, airports = S.rail(spark, sf), S.airports(spark, sf)
    root = f"{staging_folder(spark)}/merge-{uuid.uuid4().hex}"
    first, third = F.col("provider").isin("AUTOMOBILE", "FURNITURE"), F.col("provider") == "MACHINERY"
    merge(spark, root, rail.where(first), airports)
    merge(spark, root, rail.where(third & F.col("vehicule_type").contains("T")), airports)
    fact = merge(spark, root, rail.where(~first), airports)["fact"]
    drop_staged(rail)
    return S.rounded(fact.select(*FACT_COLUMNS), 4, KG)


def station_attributes(spark, sf):
    """Footfall and population of every end, from the balances of customers and suppliers."""
    customers = S.table(spark, sf, "customer").select(
        F.col("c_name").alias("station_name"),
        F.floor(F.col("c_acctbal") * 100).alias("annual_station_traffic"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey") * 10).alias("city_population"),
    )
    suppliers = S.table(spark, sf, "supplier").select(
        F.col("s_name").alias("station_name"),
        F.floor(F.col("s_acctbal") * 100).alias("annual_station_traffic"),
        F.when(F.col("s_nationkey") != 3, F.col("s_suppkey") * 10).alias("city_population"),
    )
    return customers.unionByName(suppliers)


def wide(spark, sf):
    return fact_wide(staged_fact(spark, sf), station_attributes(spark, sf))


WIDE_DOUBLES = (
    f"{KG} origin_station_traffic origin_city_population dest_station_traffic dest_city_population"
)


def fact_enriched(spark, sf):
    columns = [*FACT_COLUMNS, "origin_station_traffic", "origin_city_population",
               "dest_station_traffic", "dest_city_population"]
    rows = wide(spark, sf).select(*columns)
    as_double = {c: F.col(c).cast("double") for c in columns[-4:]}
    return S.rounded(rows.withColumns(as_double), 4, WIDE_DOUBLES)


def fk_resolution(spark, sf):
    """Fact rows with all four keys, shown by the natural keys they resolve to. Routes from ends in 7 are missing."""
    routes = S.routes(spark, sf)
    fact, route, vehicle = (cut_lineage(f(routes)) for f in (fact_corridors, dim_route, dim_vehicle_type))
    drop_staged(routes)
    station = cut_lineage(dim_station(fact))
    route = route.where(~F.endswith(F.col("dep_name"), F.lit("7")))
    keyed = cut_lineage(resolve_keys(fact, route, vehicle, station))
    drop_staged(fact)
    start = station.select(F.col("station_id").alias("origin_station_id"), F.col("station_name").alias("origin_station"))
    end = station.select(F.col("station_id").alias("dest_station_id"), F.col("station_name").alias("dest_station"))
    shown = (
        keyed.join(route.select("route_id", "dep_name", "arr_name"), "route_id")
        .join(vehicle.select("vehicle_type_id", "service_type"), "vehicle_type_id")
        .join(start, "origin_station_id").join(end, "dest_station_id")
        .select("dep_name", "arr_name", "service_type", "origin_station", "dest_station", "co2_train_kg", "is_substitutable")
    )
    return S.rounded(shown, 4, "co2_train_kg")


def orphan_check(spark, sf):
    """Orders of customers outside the list of customers in credit."""
    credit = S.table(spark, sf, "customer").where(F.col("c_acctbal") >= 0)
    return orphans(S.table(spark, sf, "orders"), credit, "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


def unique_key_check(spark, sf):
    """(order, line) pairs that are not unique."""
    return duplicate_keys(S.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def upsert_incremental(spark, sf):
    """Customers in credit are loaded; then building and machinery customers arrive with a new
    balance and a new column."""
    customers = S.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    loaded = customers.where(F.col("c_acctbal") >= 0).drop("c_mktsegment")
    arriving = customers.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).withColumn("c_acctbal", F.col("c_acctbal") + 1000)
    return S.rounded(upsert(loaded, arriving, ["c_custkey"]), 2, "c_acctbal")


def decimal_sink(spark, sf):
    rows = S.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey",
        (F.col("l_extendedprice") / 7).alias("distance_km"), (F.col("l_quantity") / 7).alias("co2_train_kg"),
    )
    stored = warehouse_types(rows)
    return stored.withColumns({c: F.col(c).cast("string") for c in ("distance_km", "co2_train_kg")})


def surrogate_keys(spark, sf):
    """Gapless ids of part names and types in their order."""
    pairs = S.table(spark, sf, "part").select("p_name", "p_type").distinct()
    return dense_ids(pairs, ["p_name", "p_type"], "part_id")


def hash_key_collisions(spark, sf):
    """Hash keys of every station name that stand for two names: none."""
    names = S.stations(spark, sf).select(hash_key("station_name").alias("station_id"), "station_name")
    return key_collisions(names, "station_id", ["station_name"])


def short_key_collisions(spark, sf):
    """Keys too short for their names: the last three digits of every customer."""
    names = S.table(spark, sf, "customer").select(F.substring("c_name", -3, 3).alias("short_key"), "c_name")
    return key_collisions(names, "short_key", ["c_name"])


def view(spark, sf, limit=None):
    routes = S.routes(spark, sf)
    fact, route, vehicle = (cut_lineage(f(routes)) for f in (fact_corridors, dim_route, dim_vehicle_type))
    drop_staged(routes)
    keys = route.select("route_id", F.col("dep_name").alias("origin"), F.col("arr_name").alias("destination"))
    keyed = fact.select("origin", "destination", "vehicule_type", "co2_train_kg", "co2_avion_kg").join(
        keys, ["origin", "destination"]
    ).join(vehicle.select("vehicle_type_id", F.col("label").alias("vehicule_type")), "vehicule_type")
    keyed = cut_lineage(keyed.select("route_id", "vehicle_type_id", "co2_train_kg", "co2_avion_kg"))
    drop_staged(fact)
    return queries.data_view(keyed, route, vehicle, limit)


def data_view(spark, sf):
    return S.rounded(view(spark, sf), 4, "distance_km co2_kg")


def limited_view(spark, sf):
    return S.rounded(
        view(spark, sf).orderBy(*queries.VIEW_ORDER[:3]).limit(50), 4, "distance_km co2_kg"
    )


def star_join(spark, sf):
    """Mean CO2 per type over the three-table join."""
    return S.rounded(
        view(spark, sf).groupBy("vehicule_type", "is_long_distance").agg(
            F.count("*").alias("n"), F.avg("co2_kg").alias("co2_mean")
        ), 4, "co2_mean")


def data_view_limited(spark, sf):
    """The view's own limit, by its four order columns."""
    return S.rounded(view(spark, sf, limit=50), 4, "distance_km co2_kg")


def star_search(spark, sf):
    """Search over fact, routes and vehicles."""
    return S.rounded(queries.search(view(spark, sf), "customer#0000001", "PPLIER#00000000", "nuit"), 4, "distance_km co2_kg")


def star_compare(spark, sf):
    """Day against night over fact, routes and vehicles."""
    return queries.compare(view(spark, sf), "customer#00000", "supplier#00000")


def star_top_routes(spark, sf):
    return S.rounded(queries.top_routes(view(spark, sf)), 4, "avg_co2")


def search_ilike(spark, sf):
    hits = queries.search(S.view(spark, sf), "customer#00000012", "PPLIER#00000000", "nuit")
    return S.rounded(hits, 4, "distance_km co2_kg")


def compare_day_night(spark, sf):
    return queries.compare(S.view(spark, sf), "customer#000000", "supplier#0000000")


def top_routes(spark, sf):
    return S.rounded(queries.top_routes(S.view(spark, sf)), 4, "avg_co2")


def table_counts(spark, sf):
    return queries.table_counts({
        "orders": S.table(spark, sf, "orders"), "customers": S.table(spark, sf, "customer"),
        "lines": S.table(spark, sf, "lineitem"),
    })


def avg_by_service(spark, sf):
    return S.rounded(queries.average_by_type(S.view(spark, sf), "CUSTOMER#0000001", "supplier"), 4, "avg_co2")


# --- model-ready tables -------------------------------------------------------------
def label_encode(spark, sf):
    """Every part with the code of its name."""
    parts = S.table(spark, sf, "part").select("p_partkey", "p_name")
    return encode(parts, category_codes(parts, "p_name"), "p_name", "code").select("p_partkey", "p_name", "code")


def model_rows(spark, sf):
    rows = model_columns(wide(spark, sf), modelling.KEYS)
    return S.rounded(rows, 4, WIDE_DOUBLES)


def key_hash(column: str):
    """A multiplicative hash both engines can compute: 32 bits."""
    return (F.col(column).cast("long") * 2654435761) % 4294967296


def split_exact(spark, sf):
    labels = S.table(spark, sf, "labels")
    return exact_split(labels, ["doc_id"], ["quality"], key_hash("doc_id"), bits=32)


def split_plain(spark, sf):
    orders = S.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return exact_split(orders, ["o_orderkey"], hashed=key_hash("o_orderkey"), bits=32)


def class_balance_query(spark, sf):
    return S.rounded(class_balance(split_exact(spark, sf), "quality"), 6, "target_share")


def standard_scale(spark, sf):
    """Orders split, deviation and mean taken from the training rows, all rows scaled."""
    rows = split_plain(spark, sf).withColumn("constant", F.lit(3.0))
    columns = ["o_totalprice", "constant"]
    scaler = fit_scaler(rows.where(F.col("split") == "train"), columns)
    return S.rounded(apply_scaler(rows, scaler, columns), 6, "o_totalprice constant")


def sample_200(spark, sf):
    return sample_rows(S.table(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_orderkey"], 200, key_hash("o_orderkey"))


def match_rates(spark, sf):
    joined = S.table(spark, sf, "documents").join(S.table(spark, sf, "labels"), "doc_id", "left")
    return S.rounded(match_rate(joined, "quality"), 6, "rate")


def coverage(spark, sf):
    rows = completeness(wide(spark, sf), ["co2_avion_kg", "origin_station_traffic", "origin_city_population", "dest_city_population"])
    return S.rounded(rows, 4, "pct")


QUERIES = {
    "fact_corridor": fact_corridor,
    "final_routes": final_routes,
    "mode_split": mode_split,
    "dim_vehicle": vehicles,
    "dim_route": routes_dimension,
    "dim_station": stations_dimension,
    "fact_enriched": fact_enriched,
    "fk_resolution": fk_resolution,
    "orphan_check": orphan_check,
    "unique_key_check": unique_key_check,
    "upsert_incremental": upsert_incremental,
    "merge_incremental": merge_incremental,
    "decimal_sink": decimal_sink,
    "surrogate_keys": surrogate_keys,
    "hash_key_collisions": hash_key_collisions,
    "short_key_collisions": short_key_collisions,
    "data_view": data_view,
    "limited_view": limited_view,
    "star_join": star_join,
    "data_view_limited": data_view_limited,
    "star_search": star_search,
    "star_compare": star_compare,
    "star_top_routes": star_top_routes,
    "search_ilike": search_ilike,
    "compare_day_night": compare_day_night,
    "top_routes": top_routes,
    "table_counts": table_counts,
    "avg_by_service": avg_by_service,
    "label_encode": label_encode,
    "model_rows": model_rows,
    "split_exact": split_exact,
    "split_plain": split_plain,
    "class_balance": class_balance_query,
    "standard_scale": standard_scale,
    "sample_200": sample_200,
    "match_rates": match_rates,
    "coverage": coverage,
}

FACT_SQL = f"SELECT {', '.join(FACT_COLUMNS)} FROM fact"
ATTRIBUTES = """(SELECT c_name AS station_name, floor(c_acctbal * 100) AS traffic,
  CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey * 10e0 END AS population FROM customer
  UNION ALL SELECT s_name, floor(s_acctbal * 100), CASE WHEN s_nationkey <> 3 THEN s_suppkey * 10e0 END FROM supplier)"""
WIDE_SQL = f"""SELECT f.*, o.traffic AS origin_station_traffic, o.population AS origin_city_population,
  d.traffic AS dest_station_traffic, d.population AS dest_city_population FROM fact f
  LEFT JOIN {ATTRIBUTES} o ON o.station_name = f.origin LEFT JOIN {ATTRIBUTES} d ON d.station_name = f.destination"""
WIDE_PICKED = f"""SELECT {', '.join(FACT_COLUMNS)}, origin_station_traffic, origin_city_population,
  dest_station_traffic, dest_city_population FROM ({WIDE_SQL})"""
VIEW_HIT = "origine ILIKE '%{o}%' AND destination ILIKE '%{d}%'"


def split_sql(table: str, key: str, within: str) -> str:
    hashed = f"(CAST({key} AS BIGINT) * 2654435761) % 4294967296"
    window = f"PARTITION BY {within}" if within else ""
    return f"""SELECT * EXCLUDE (rank, total), CASE WHEN rank <= total - ceil(total * 0.3e0) THEN 'train'
  WHEN rank <= total - ceil(ceil(total * 0.3e0) / 2) THEN 'val' ELSE 'test' END AS split FROM (
  SELECT *, row_number() OVER ({window} ORDER BY {hashed}, {key}) AS rank, count(*) OVER ({window}) AS total
  FROM {table})"""


ORDER_SPLIT = split_sql("(SELECT o_orderkey, o_totalprice FROM orders)", "o_orderkey", "")
LABEL_SPLIT = split_sql("labels", "doc_id", "quality")
DAY = "vehicule_type NOT ILIKE '%nuit%'"
NIGHT = "vehicule_type ILIKE '%nuit%'"

SQL = {
    "fact_corridor": S.sql(FACT_SQL, 4, KG),
    "merge_incremental": S.sql(FACT_SQL, 4, KG),
    "final_routes": S.sql(
        """SELECT origin, destination, vehicule_type, origin_city, distance_km, co2_kg, departure_time, arrival_time,
        source, provider FROM routes""", 4, "distance_km co2_kg"),
    "mode_split": S.sql(
        """SELECT CASE WHEN contains(vehicule_type, 'Avion') THEN 'plane' ELSE 'train' END AS side, origin,
        count(*) AS n FROM routes GROUP BY 1, 2"""),
    "dim_vehicle": S.sql("SELECT label, service_type, co2_vt FROM dim_vehicle"),
    "dim_route": S.sql("SELECT * FROM dim_route", 4, "distance_km"),
    "dim_station": S.sql("SELECT * FROM dim_station", 2, "lat lon"),
    "fact_enriched": S.sql(WIDE_PICKED, 4, WIDE_DOUBLES),
    "fk_resolution": S.sql(
        """SELECT origin AS dep_name, destination AS arr_name, vehicule_type AS service_type, origin AS origin_station,
        destination AS dest_station, co2_train_kg, is_substitutable FROM fact WHERE origin NOT LIKE '%7'""",
        4, "co2_train_kg"),
    "orphan_check": """SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS
        (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0)""",
    "unique_key_check": """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2
        HAVING count(*) > 1""",
    "upsert_incremental": S.sql(
        """SELECT c_custkey, c_name, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_mktsegment END
        AS c_mktsegment, c_acctbal + CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 1000 ELSE 0 END AS c_acctbal
        FROM customer WHERE c_acctbal >= 0 OR c_mktsegment IN ('BUILDING', 'MACHINERY')""", 2, "c_acctbal"),
    "decimal_sink": """SELECT l_orderkey, l_linenumber, l_suppkey,
        CAST(CAST(l_extendedprice / 7 AS DECIMAL(10, 3)) AS VARCHAR) AS distance_km,
        CAST(CAST(l_quantity / 7 AS DECIMAL(10, 4)) AS VARCHAR) AS co2_train_kg FROM lineitem""",
    "surrogate_keys": """SELECT row_number() OVER (ORDER BY p_name, p_type) AS part_id, p_name, p_type
        FROM (SELECT DISTINCT p_name, p_type FROM part)""",
    "hash_key_collisions": """SELECT CAST(0 AS BIGINT) AS station_id, count(*) AS natural_keys
        FROM (SELECT DISTINCT c_name FROM customer) GROUP BY c_name HAVING count(*) > 1""",
    "short_key_collisions": """SELECT right(c_name, 3) AS short_key, count(DISTINCT c_name) AS natural_keys
        FROM customer GROUP BY 1 HAVING count(DISTINCT c_name) > 1""",
    "data_view": S.sql("SELECT * FROM data_rows", 4, "distance_km co2_kg"),
    "limited_view": S.sql(
        "SELECT * FROM data_rows ORDER BY origine, destination, vehicule_type LIMIT 50", 4, "distance_km co2_kg"),
    "star_join": S.sql(
        """SELECT vehicule_type, is_long_distance, count(*) AS n, avg(co2_kg) AS co2_mean FROM data_rows
        GROUP BY 1, 2""", 4, "co2_mean"),
    "data_view_limited": S.sql(
        "SELECT * FROM data_rows ORDER BY origine, destination, vehicule_type, co2_kg LIMIT 50", 4, "distance_km co2_kg"),
    "star_search": S.sql(
        f"""SELECT origine AS depart, destination AS arrivee, distance_km, vehicule_type, co2_kg FROM data_rows
        WHERE {VIEW_HIT.format(o='customer#0000001', d='PPLIER#00000000')} AND vehicule_type ILIKE '%nuit%'""",
        4, "distance_km co2_kg"),
    "star_compare": S.sql(
        f"""SELECT 'customer#00000' AS depart, 'supplier#00000' AS arrivee, *, CASE WHEN night_n = 0 THEN 'no_night_train'
        WHEN gain_pct > 15 THEN 'night_train' WHEN gain_pct > 0 THEN 'slightly_night' WHEN gain_pct < -15 THEN 'day_train'
        ELSE 'similar' END AS advice FROM (SELECT *, CASE WHEN night_n = 0 THEN 0
          ELSE round((day_mean - night_mean) / day_mean * 100, 1) END AS gain_pct FROM (
          SELECT round(avg(co2_kg) FILTER ({DAY}), 2) AS day_mean, count(*) FILTER ({DAY}) AS day_n,
            round(min(co2_kg) FILTER ({DAY}), 2) AS day_min, round(max(co2_kg) FILTER ({DAY}), 2) AS day_max,
            coalesce(round(avg(co2_kg) FILTER ({NIGHT}), 2), 0) AS night_mean, count(*) FILTER ({NIGHT}) AS night_n,
            coalesce(round(min(co2_kg) FILTER ({NIGHT}), 2), 0) AS night_min,
            coalesce(round(max(co2_kg) FILTER ({NIGHT}), 2), 0) AS night_max
          FROM data_rows WHERE {VIEW_HIT.format(o='customer#00000', d='supplier#00000')} AND vehicule_type <> 'Avion'))"""),
    "star_top_routes": S.sql(
        """SELECT origine, destination, avg(co2_kg) AS avg_co2, count(*) AS n FROM data_rows GROUP BY 1, 2
        ORDER BY avg_co2 DESC NULLS LAST, origine, destination LIMIT 10""", 4, "avg_co2"),
    "search_ilike": S.sql(
        f"""SELECT origine AS depart, destination AS arrivee, distance_km, vehicule_type, co2_kg FROM ride_view
        WHERE {VIEW_HIT.format(o='customer#00000012', d='PPLIER#00000000')} AND vehicule_type ILIKE '%nuit%'""",
        4, "distance_km co2_kg"),
    "compare_day_night": S.sql(
        f"""SELECT 'customer#000000' AS depart, 'supplier#0000000' AS arrivee, *, CASE WHEN night_n = 0 THEN 'no_night_train'
        WHEN gain_pct > 15 THEN 'night_train' WHEN gain_pct > 0 THEN 'slightly_night' WHEN gain_pct < -15 THEN 'day_train'
        ELSE 'similar' END AS advice FROM (SELECT *, CASE WHEN night_n = 0 THEN 0
          ELSE round((day_mean - night_mean) / day_mean * 100, 1) END AS gain_pct FROM (
          SELECT round(avg(co2_kg) FILTER ({DAY}), 2) AS day_mean, count(*) FILTER ({DAY}) AS day_n,
            round(min(co2_kg) FILTER ({DAY}), 2) AS day_min, round(max(co2_kg) FILTER ({DAY}), 2) AS day_max,
            coalesce(round(avg(co2_kg) FILTER ({NIGHT}), 2), 0) AS night_mean, count(*) FILTER ({NIGHT}) AS night_n,
            coalesce(round(min(co2_kg) FILTER ({NIGHT}), 2), 0) AS night_min,
            coalesce(round(max(co2_kg) FILTER ({NIGHT}), 2), 0) AS night_max
          FROM ride_view WHERE {VIEW_HIT.format(o='customer#000000', d='supplier#0000000')} AND vehicule_type <> 'Avion'))"""),
    "top_routes": S.sql(
        """SELECT origine, destination, avg(co2_kg) AS avg_co2, count(*) AS n FROM ride_view GROUP BY 1, 2
        ORDER BY avg_co2 DESC NULLS LAST, origine, destination LIMIT 10""", 4, "avg_co2"),
    "table_counts": """SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM customer) AS customers,
        (SELECT count(*) FROM lineitem) AS lines""",
    "avg_by_service": S.sql(
        f"""SELECT vehicule_type, avg(co2_kg) AS avg_co2, count(*) AS n FROM ride_view
        WHERE {VIEW_HIT.format(o='CUSTOMER#0000001', d='supplier')} GROUP BY 1""", 4, "avg_co2"),
    "label_encode": """SELECT p_partkey, p_name, dense_rank() OVER (ORDER BY p_name) - 1 AS code FROM part""",
    "model_rows": S.sql(
        f"""SELECT * REPLACE (coalesce(co2_avion_kg, 0) AS co2_avion_kg, coalesce(origin_station_traffic, 0) AS
        origin_station_traffic, coalesce(origin_city_population, 0) AS origin_city_population,
        coalesce(dest_station_traffic, 0) AS dest_station_traffic, coalesce(dest_city_population, 0) AS dest_city_population)
        FROM ({WIDE_PICKED})""", 4, WIDE_DOUBLES),
    "split_exact": LABEL_SPLIT,
    "split_plain": ORDER_SPLIT,
    "class_balance": S.sql(
        f"SELECT split, count(*) AS n, avg(quality) AS target_share FROM ({LABEL_SPLIT}) GROUP BY split", 6, "target_share"),
    "standard_scale": S.sql(
        f"""SELECT o_orderkey, (o_totalprice - m) / s AS o_totalprice, 0e0 AS constant, split FROM ({ORDER_SPLIT}),
        (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM ({ORDER_SPLIT}) WHERE split = 'train')""",
        6, "o_totalprice constant"),
    "sample_200": """SELECT o_orderkey, o_custkey FROM orders
        ORDER BY (CAST(o_orderkey AS BIGINT) * 2654435761) % 4294967296, o_orderkey LIMIT 200""",
    "match_rates": S.sql(
        """SELECT count(quality) AS matched, count(*) AS total, count(quality) / count(*) AS rate
        FROM documents LEFT JOIN labels USING (doc_id)""", 6, "rate"),
    "coverage": S.sql(
        f"""SELECT c AS "column", filled, filled * 100e0 / total AS pct FROM (
        SELECT count(*) AS total, unnest(['co2_avion_kg', 'origin_station_traffic', 'origin_city_population',
          'dest_city_population']) AS c, unnest([count(co2_avion_kg), count(origin_station_traffic),
          count(origin_city_population), count(dest_city_population)]) AS filled FROM ({WIDE_SQL}))""", 4, "pct"),
}
