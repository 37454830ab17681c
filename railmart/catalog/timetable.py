"""Trips, calls and legs: orders as trips, lines as calls, customers as routes."""

from __future__ import annotations

from pyspark.sql import functions as F

from railmart.catalog import standins as S
from railmart.functions.trains import (
    classify_sheet, classify_timetable, final_type, hour_of, is_night, service_code,
)
from railmart.operators.cleaning import clean_legs, named_stop, usable_stop, valid_ends
from railmart.operators.keep import keep_first, undirected
from railmart.operators.night_sheet import given_ends, locate_ends, place_names, sheet_legs
from railmart.operators.timetable import (
    rail_calls, rail_trips, stop_pairs, timetable_legs, trip_lengths, trip_summary,
)
from railmart.plans.pipeline import unite
from railmart.schemas import LEG_TYPES, typed

NATION_CODES = {str(i): code for i, code in enumerate(S.BRAND_CODES.values())}
ROUTE_TYPE_SQL = S.s_mapped("c_mktsegment", S.SEGMENT_ROUTE_TYPES)


def tables(spark, sf):
    """The four timetable tables, all text, of one feed."""
    feed = F.lit(S.FEED).alias("feed")
    text = lambda name: F.col(name).cast("string")
    trip, sequence = F.col("l_orderkey"), F.col("l_linenumber")
    return {
        "stops": S.table(spark, sf, "supplier").select(
            feed,
            text("s_suppkey").alias("stop_id"),
            F.col("s_name").alias("stop_name"),
            S.stop_lat(F.col("s_suppkey")).cast("string").alias("stop_lat"),
            S.stop_lon(F.col("s_suppkey")).cast("string").alias("stop_lon"),
        ),
        "stop_times": S.table(spark, sf, "lineitem").select(
            feed,
            text("l_orderkey").alias("trip_id"),
            text("l_suppkey").alias("stop_id"),
            text("l_linenumber").alias("stop_sequence"),
            S.clock(trip, sequence, 0).alias("departure_time"),
            S.clock(trip, sequence, 180).alias("arrival_time"),
        ),
        "trips": S.table(spark, sf, "orders").select(
            feed, text("o_orderkey").alias("trip_id"), text("o_custkey").alias("route_id")
        ),
        "routes": S.table(spark, sf, "customer").select(
            feed,
            text("c_custkey").alias("route_id"),
            S.mapped(F.col("c_mktsegment"), S.SEGMENT_ROUTE_TYPES).alias("route_type"),
            S.mapped(text("c_nationkey"), NATION_CODES).alias("route_short_name"),
            F.col("c_mktsegment").alias("route_long_name"),
        ),
    }


def calls(spark, sf):
    t = tables(spark, sf)
    return rail_calls(t["stop_times"], rail_trips(t["trips"], t["routes"]))


def places(spark, sf):
    key = F.col("s_suppkey")
    return S.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), S.stop_lat(key).alias("lat"), S.stop_lon(key).alias("lon")
    )


def segment_lag_sum(spark, sf):
    lengths = trip_lengths(
        S.table(spark, sf, "lineitem"), places(spark, sf), ["l_orderkey"],
        ["l_linenumber", "l_suppkey"], ["l_suppkey"],
    )
    return S.rounded(lengths, 4, "stop_distance_km")


def trip_bounds_first(spark, sf):
    return trip_summary(calls(spark, sf)).drop("feed")


def rail_trip_join(spark, sf):
    return calls(spark, sf).select(
        "trip_id", "stop_id", "stop_sequence", "route_type", "route_short_name", "departure_time"
    )


def ordered_pairs(spark, sf):
    pairs = stop_pairs(calls(spark, sf), tables(spark, sf)["stops"])
    return pairs.select("origin", "destination", "departure_time", "arrival_time", "trip_id")


def timetable_legs_query(spark, sf):
    legs = timetable_legs(tables(spark, sf)).select(
        "origin", "destination", "vehicule_type", "station_lat", "station_long_dest", "departure_time",
        "arrival_time", "source", "provider",
    )
    return S.rounded(legs, 2, "station_lat station_long_dest")


def messy_legs(spark, sf):
    """Lines with ends as untidy as in the wild: codes, double spaces, numbers, blanks, marks."""
    lines = (
        S.table(spark, sf, "lineitem")
        .join(S.table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(S.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    )
    name, kind = F.col("c_name"), F.col("c_mktsegment")
    origin = (
        F.when(kind == "BUILDING", F.concat(name, F.lit("   Hbf (FR)")))
        .when(kind == "AUTOMOBILE", F.concat(F.lit("  "), name, F.lit(" [SBB] ")))
        .when(kind == "MACHINERY", F.col("c_custkey").cast("string"))
        .when(F.col("c_acctbal") < 0, F.lit("#N/A"))
        .when(F.col("l_linenumber") == 7, F.lit("  "))
        .otherwise(F.concat(name, F.lit(" (Saale)")))
    )
    return lines.select(
        origin.alias("origin"),
        F.when(F.col("l_returnflag") == "R", origin).otherwise(
            F.concat(F.lit("Stop  "), F.col("l_suppkey").cast("string"), F.lit(" (CH)"))
        ).alias("destination"),
        S.station_lat(F.col("c_custkey")).alias("station_lat"),
        S.station_lon(F.col("c_custkey")).alias("station_long"),
        S.stop_lat(F.col("l_suppkey")).alias("station_lat_dest"),
        S.stop_lon(F.col("l_suppkey")).alias("station_long_dest"),
    )


def clean_legs_query(spark, sf):
    return S.rounded(clean_legs(given_ends(messy_legs(spark, sf))), 2,
                     "station_lat station_long station_lat_dest station_long_dest")


def validate_ends(spark, sf):
    return valid_ends(messy_legs(spark, sf)).groupBy("origin", "destination").agg(F.count("*").alias("n"))


def stop_coord_filter(spark, sf):
    """Which suppliers pass as placed stop and as named stop; a zero balance stands for a zero axis."""
    balance = F.col("s_acctbal")
    lat = F.when(balance > 5000, S.stop_lat(F.col("s_suppkey"))).when(balance > 0, F.lit(0.0))
    lon = S.stop_lon(F.col("s_suppkey"))
    name = F.when(F.col("s_nationkey") != 3, F.col("s_name"))
    rows = S.table(spark, sf, "supplier").select("s_suppkey", name.alias("name"), lat.alias("lat"), lon.alias("lon"))
    return rows.select(
        "s_suppkey",
        F.coalesce(usable_stop(F.col("lat"), F.col("lon")), F.lit(False)).alias("usable"),
        F.coalesce(named_stop(F.col("name"), F.col("lat")), F.lit(False)).alias("named"),
    )


def classify(spark, sf):
    code = service_code(S.mapped(F.col("p_brand"), S.BRAND_CODES), F.col("p_type"))
    route_type = F.when(F.col("p_size") > 40, 102).otherwise(2)
    rows = S.table(spark, sf, "part").select(
        "p_partkey",
        classify_timetable(code, route_type).alias("timetable_type"),
        classify_sheet(code, route_type.cast("string")).alias("sheet_type"),
        (F.col("p_size") > 25).alias("night"),
    )
    return rows.select("p_partkey", "timetable_type", "sheet_type",
                       final_type(F.col("timetable_type"), F.col("night")).alias("final_type"))


def night_flag(spark, sf):
    stamp = F.date_format("ts", "HH:mm:ss")
    text = (
        F.when(F.col("event_type") == "click", F.regexp_replace(stamp, "^0", ""))
        .when(F.col("event_type") == "error", F.lit(None).cast("string"))
        .otherwise(stamp)
    )
    base = F.when(F.col("event_type") == "signup", F.lit("EuroNight")).otherwise(F.lit("InterCity"))
    rows = S.table(spark, sf, "events").select("event_id", hour_of(text).alias("hour"), base.alias("base"))
    night = is_night(F.col("hour"), F.col("base"))
    return rows.select(
        "event_id", F.coalesce("hour", F.lit(-1)).alias("hour"), night.alias("is_night"),
        final_type(F.col("base"), night).alias("vehicule_type"),
    )


def keep_one_dedup(spark, sf):
    kept = keep_first(
        S.rides(spark, sf).select("origin", "destination", "vehicule_type", "source", "provider",
                                  "departure_time", "arrival_time", "distance_km"),
        ["origin", "destination", "vehicule_type", "source"],
        ["provider", "departure_time", "arrival_time"],
    )
    return S.rounded(kept, 4, "distance_km")


def undirected_corridors(spark, sf):
    """Supplier pairs of a trip without direction."""
    pairs = stop_pairs(calls(spark, sf), tables(spark, sf)["stops"]).select("origin", "destination", "trip_id")
    return keep_first(undirected(pairs), ["origin", "destination"], ["trip_id"])


def union_missing_cols(spark, sf):
    """Stations and airports as two leg sources with different columns."""
    a = S.table(spark, sf, "customer").select(F.col("c_name").alias("origin"), F.col("c_mktsegment").alias("vehicule_type"), F.lit("a").alias("source"))
    b = S.table(spark, sf, "supplier").select(F.col("s_name").alias("origin"), F.lit("b").alias("source"), F.col("s_acctbal").cast("string").alias("station_lat"))
    united = typed(unite([a, b]), LEG_TYPES)
    return united.select("origin", "vehicule_type", "station_lat", "departure_time", "source")


def name_lookup_twice(spark, sf):
    """Orders between two named places: the customer's nation and the order's status nation; the
    place list holds every nation once per region row, so names repeat."""
    nations = S.table(spark, sf, "nation")
    listed = nations.select(
        F.col("n_name").alias("station_name"),
        F.when(F.col("n_nationkey") != 5, S.stop_lat(F.col("n_nationkey")).cast("string")).otherwise(F.lit("?")).alias("station_lat"),
        S.stop_lon(F.col("n_nationkey")).cast("string").alias("station_long"),
    )
    trips = S.table(spark, sf, "orders").join(
        S.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left"
    ).select(
        "o_orderkey",
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("trip_origin"),
        F.concat(F.lit("NATION_"), (F.col("o_orderkey") % 31).cast("string")).alias("trip_headsign"),
    )
    found = locate_ends(trips, place_names(listed.unionByName(listed)), "trip_origin", "trip_headsign")
    return S.rounded(found, 2, "station_lat station_long station_lat_dest station_long_dest")


def sheet_tabs(spark, sf):
    """Customers as sheet routes, orders as sheet trips, nations as sheet stops."""
    nation = F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"))
    customers = S.table(spark, sf, "customer")
    return {
        "routes": customers.select(
            F.col("c_custkey").cast("string").alias("route_id"),
            S.mapped(F.col("c_mktsegment"), S.SEGMENT_ROUTE_TYPES).alias("vehicule_type"),
        ),
        "trips": S.table(spark, sf, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("o_custkey").cast("string").alias("route_id"),
            F.when(F.col("o_orderstatus") == "P", F.lit("#N/A")).otherwise(nation).alias("trip_origin"),
            F.concat(F.lit("NATION_"), (F.col("o_orderkey") % 25).cast("string")).alias("trip_headsign"),
            S.mapped(F.col("c_nationkey").cast("string"), NATION_CODES).alias("trip_short_name"),
            S.clock(F.col("o_orderkey"), F.col("o_custkey"), 0).alias("origin_departure_time"),
            S.clock(F.col("o_orderkey"), F.col("o_custkey"), 180).alias("destination_arrival_time"),
        ),
        "stops": S.table(spark, sf, "nation").select(
            F.col("n_name").alias("station_name"),
            S.stop_lat(F.col("n_nationkey")).cast("string").alias("station_lat"),
            S.stop_lon(F.col("n_nationkey")).cast("string").alias("station_long"),
        ),
    }


def night_sheet_legs(spark, sf):
    legs = sheet_legs(sheet_tabs(spark, sf)).select(
        "origin", "destination", "vehicule_type", "station_lat", "station_long", "departure_time", "arrival_time"
    )
    return S.rounded(legs, 2, "station_lat station_long")


QUERIES = {
    "segment_lag_sum": segment_lag_sum,
    "trip_bounds_first": trip_bounds_first,
    "rail_trip_join": rail_trip_join,
    "ordered_pairs": ordered_pairs,
    "timetable_legs": timetable_legs_query,
    "clean_legs": clean_legs_query,
    "validate_ends": validate_ends,
    "stop_coord_filter": stop_coord_filter,
    "classify_train": classify,
    "night_flag": night_flag,
    "keep_one_dedup": keep_one_dedup,
    "undirected_corridors": undirected_corridors,
    "union_missing_cols": union_missing_cols,
    "name_lookup_twice": name_lookup_twice,
    "night_sheet_legs": night_sheet_legs,
}

# the rail calls and, by brute force, every pair of them within a trip
CALLS = f"""SELECT l_orderkey, l_suppkey, l_linenumber, CAST({ROUTE_TYPE_SQL} AS VARCHAR) AS rt,
  {S.s_mapped("CAST(c_nationkey AS VARCHAR)", NATION_CODES)} AS short_name, c_mktsegment AS long_name,
  {S.s_clock('l_orderkey', 'l_linenumber', 0)} AS departure_time,
  {S.s_clock('l_orderkey', 'l_linenumber', 180)} AS arrival_time
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  WHERE TRY_CAST({ROUTE_TYPE_SQL} AS INTEGER) = 2 OR TRY_CAST({ROUTE_TYPE_SQL} AS INTEGER) BETWEEN 100 AND 117"""
PAIRS = f"""SELECT a.l_orderkey AS trip, a.l_suppkey AS o, b.l_suppkey AS d, min(a.l_linenumber) AS sa,
  max(b.l_linenumber) AS sb, min(a.rt) AS rt, min(a.short_name) AS short_name, min(a.long_name) AS long_name
  FROM ({CALLS}) a JOIN ({CALLS}) b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber
  AND a.l_suppkey <> b.l_suppkey GROUP BY 1, 2, 3"""
BEST_PAIRS = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o, d ORDER BY departure_time,
  CAST(trip AS VARCHAR)) AS rn FROM (SELECT *, {S.s_clock('trip', 'sa', 0)} AS departure_time,
  {S.s_clock('trip', 'sb', 180)} AS arrival_time FROM ({PAIRS}))) WHERE rn = 1"""


def supplier_name(key: str) -> str:
    return f"'Supplier#' || lpad(CAST({key} AS VARCHAR), 9, '0')"


CODE_SQL = "coalesce(short_name, long_name, '')"
BASE_SQL = S.s_classify(CODE_SQL, "CAST(rt AS INTEGER)")
PART_CODE = f"coalesce({S.s_mapped('p_brand', S.BRAND_CODES)}, p_type)"
PART_TYPE = S.s_classify(PART_CODE, "CASE WHEN p_size > 40 THEN 102 ELSE 2 END")
MESSY_ORIGIN = """CASE WHEN c_mktsegment = 'BUILDING' THEN c_name || '   Hbf (FR)'
  WHEN c_mktsegment = 'AUTOMOBILE' THEN '  ' || c_name || ' [SBB] '
  WHEN c_mktsegment = 'MACHINERY' THEN CAST(c_custkey AS VARCHAR) WHEN c_acctbal < 0 THEN '#N/A'
  WHEN l_linenumber = 7 THEN '  ' ELSE c_name || ' (Saale)' END"""
MESSY = f"""SELECT *, CASE WHEN l_returnflag = 'R' THEN origin
  ELSE 'Stop  ' || CAST(l_suppkey AS VARCHAR) || ' (CH)' END AS destination FROM (
  SELECT *, {MESSY_ORIGIN} AS origin FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey)"""
NOT_BLANK = "trim(origin) <> '' AND trim(destination) <> '' AND origin <> destination"


def cleaned(name: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace({name}, '\\s*[(\\[][A-Z0-9]{{2,5}}[)\\]]\\s*$', ''), '\\s+', ' ', 'g'))"
    )


SHEET_CODE = f"coalesce({S.s_mapped('CAST(c_nationkey AS VARCHAR)', NATION_CODES)}, {ROUTE_TYPE_SQL}, '')"
SHEET_TAIL = (
    f"WHEN regexp_matches(upper(code), 'INTERCITÉS.*NUIT') THEN 'Intercités Nuit' "
    f"WHEN sheet_type = '102' THEN 'Train Nuit' ELSE 'InterCity'"
)

SQL = {
    "segment_lag_sum": S.sql(
        f"""SELECT l_orderkey, sum(km) AS stop_distance_km FROM (SELECT l_orderkey,
        {S.s_haversine('plat', 'plon', 'lat', 'lon')} AS km FROM (SELECT l_orderkey, lat, lon,
          lag(lat) OVER w AS plat, lag(lon) OVER w AS plon FROM (SELECT l_orderkey, l_linenumber, l_suppkey,
            CASE WHEN x <> 0 AND y <> 0 THEN y END AS lat, CASE WHEN x <> 0 AND y <> 0 THEN x END AS lon
            FROM (SELECT *, {S.p_lat('l_suppkey')} AS y, {S.p_lon('l_suppkey')} AS x FROM lineitem))
          WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey))) GROUP BY l_orderkey""",
        4, "stop_distance_km"),
    "trip_bounds_first": f"""SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, min(l_linenumber) AS min_seq,
        max(l_linenumber) AS max_seq, CAST(min(rt) AS INTEGER) AS route_type, min(short_name) AS route_short_name,
        min(long_name) AS route_long_name FROM ({CALLS}) GROUP BY l_orderkey""",
    "rail_trip_join": f"""SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, CAST(l_suppkey AS VARCHAR) AS stop_id,
        l_linenumber AS stop_sequence, CAST(rt AS INTEGER) AS route_type, short_name AS route_short_name,
        departure_time FROM ({CALLS})""",
    "ordered_pairs": f"""SELECT {supplier_name('o')} AS origin, {supplier_name('d')} AS destination, departure_time,
        arrival_time, CAST(trip AS VARCHAR) AS trip_id FROM ({BEST_PAIRS})""",
    "timetable_legs": S.sql(
        f"""SELECT {supplier_name('o')} AS origin, {supplier_name('d')} AS destination,
        {S.s_final_type('base', S.s_is_night(S.s_hour('departure_time'), 'base'))} AS vehicule_type,
        {S.p_lat('o')} AS station_lat, {S.p_lon('d')} AS station_long_dest, departure_time, arrival_time,
        'mobility_db' AS source, '{S.FEED}' AS provider FROM (SELECT *, {BASE_SQL} AS base FROM ({BEST_PAIRS}))""",
        2, "station_lat station_long_dest"),
    "clean_legs": S.sql(
        f"""SELECT * FROM (SELECT {cleaned('origin')} AS origin, {cleaned('destination')} AS destination,
        {S.s_lat('c_custkey')} AS station_lat, {S.s_lon('c_custkey')} AS station_long,
        {S.p_lat('l_suppkey')} AS station_lat_dest, {S.p_lon('l_suppkey')} AS station_long_dest FROM ({MESSY})
        WHERE {NOT_BLANK} AND origin <> '#N/A' AND destination <> '#N/A' AND {S.s_lon('c_custkey')} <> 0
        AND NOT regexp_matches(origin, '^\\d+$') AND NOT regexp_matches(destination, '^\\d+$')) WHERE {NOT_BLANK}""",
        2, "station_lat station_long station_lat_dest station_long_dest"),
    "validate_ends": f"SELECT origin, destination, count(*) AS n FROM ({MESSY}) WHERE {NOT_BLANK} GROUP BY 1, 2",
    "stop_coord_filter": f"""SELECT s_suppkey, s_acctbal > 5000 AND {S.p_lon('s_suppkey')} <> 0 AS usable,
        s_acctbal > 5000 AND s_nationkey <> 3 AS named FROM supplier""",
    "classify_train": f"""SELECT p_partkey, timetable_type, sheet_type,
        {S.s_final_type('timetable_type', 'p_size > 25')} AS final_type FROM (SELECT p_partkey, p_size,
        {PART_TYPE} AS timetable_type, {S.s_by_pattern(PART_CODE, "WHEN p_size > 40 THEN 'Train Nuit' ELSE 'InterCity'",
        [*S.C.SERVICE_PATTERNS, S.C.NIGHT_SHEET_PATTERN])} AS sheet_type FROM part)""",
    "night_flag": f"""SELECT event_id, coalesce(hour, -1) AS hour, {S.s_is_night('hour', 'base')} AS is_night,
        {S.s_final_type('base', S.s_is_night('hour', 'base'))} AS vehicule_type FROM (SELECT event_id,
        CASE WHEN event_type = 'signup' THEN 'EuroNight' ELSE 'InterCity' END AS base,
        {S.s_hour('txt')} AS hour FROM (SELECT *, CASE WHEN event_type = 'click'
          THEN regexp_replace(strftime(ts, '%H:%M:%S'), '^0', '') WHEN event_type = 'error' THEN NULL
          ELSE strftime(ts, '%H:%M:%S') END AS txt FROM events))""",
    "keep_one_dedup": S.sql(
        """SELECT origin, destination, vehicule_type, source, provider, departure_time, arrival_time, distance_km FROM (
        SELECT *, row_number() OVER (PARTITION BY origin, destination, vehicule_type, source
        ORDER BY provider, departure_time, arrival_time) AS rn FROM rides) WHERE rn = 1""", 4, "distance_km"),
    "undirected_corridors": f"""SELECT least({supplier_name('o')}, {supplier_name('d')}) AS origin,
        greatest({supplier_name('o')}, {supplier_name('d')}) AS destination, min(CAST(trip AS VARCHAR)) AS trip_id
        FROM ({BEST_PAIRS}) GROUP BY 1, 2""",
    "union_missing_cols": """SELECT c_name AS origin, c_mktsegment AS vehicule_type, CAST(NULL AS DOUBLE) AS station_lat,
        CAST(NULL AS VARCHAR) AS departure_time, 'a' AS source FROM customer
        UNION ALL SELECT s_name, NULL, s_acctbal, NULL, 'b' FROM supplier""",
    "name_lookup_twice": S.sql(
        f"""SELECT o_orderkey, 'NATION_' || CAST(c_nationkey AS VARCHAR) AS trip_origin,
        'NATION_' || CAST(o_orderkey % 31 AS VARCHAR) AS trip_headsign, a.lat AS station_lat, a.lon AS station_long,
        b.lat AS station_lat_dest, b.lon AS station_long_dest FROM orders LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN (SELECT n_name, {S.p_lat('n_nationkey')} AS lat, {S.p_lon('n_nationkey')} AS lon FROM nation
          WHERE n_nationkey <> 5) a ON a.n_name = 'NATION_' || CAST(c_nationkey AS VARCHAR)
        LEFT JOIN (SELECT n_name, {S.p_lat('n_nationkey')} AS lat, {S.p_lon('n_nationkey')} AS lon FROM nation
          WHERE n_nationkey <> 5) b ON b.n_name = 'NATION_' || CAST(o_orderkey % 31 AS VARCHAR)""",
        2, "station_lat station_long station_lat_dest station_long_dest"),
    "night_sheet_legs": S.sql(
        f"""SELECT origin, destination, {S.s_by_pattern('code', SHEET_TAIL)} AS vehicule_type, lat AS station_lat,
        lon AS station_long, departure_time, arrival_time FROM (SELECT
          'NATION_' || CAST(c_nationkey AS VARCHAR) AS origin, 'NATION_' || CAST(o_orderkey % 25 AS VARCHAR) AS destination,
          {SHEET_CODE} AS code, {ROUTE_TYPE_SQL} AS sheet_type, {S.p_lat('c_nationkey')} AS lat,
          {S.p_lon('c_nationkey')} AS lon, {S.s_clock('o_orderkey', 'o_custkey', 0)} AS departure_time,
          {S.s_clock('o_orderkey', 'o_custkey', 180)} AS arrival_time
          FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'P')""",
        2, "station_lat station_long"),
}
