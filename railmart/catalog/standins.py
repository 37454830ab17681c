"""Rail relations read out of the given tables, in Spark and as SQL.

The tables hold no geography. Customers stand for stations and suppliers for airports and stops, at
places computed from their keys; an order is a trip and its lines are the calls; part brands and
nations carry service codes. Nothing is left out: every relation covers all rows of its tables.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railmart import constants as C
from railmart.functions.trains import classify_timetable, final_type, hour_of, is_night
from railmart.operators.cleaning import rail_routes, with_co2, with_distance
from railmart.operators.nearest import nearest_airports, stations_of
from railmart.plans.pipeline import final_routes
from railmart.schemas import LEG_TYPES, typed
from railmart.session import cut_lineage, drop_staged, tune

FEED = "XX_tables_1"
BRAND_CODES = {
    "Brand#1": "TGV INOUI", "Brand#2": "ICE 71", "Brand#3": "AVE S-103", "Brand#4": "Frecciarossa",
    "Brand#5": "IC", "Brand#6": "EC", "Brand#7": "EuroNight", "Brand#8": "NJ 40",
    "Brand#9": "Intercités de Nuit", "Brand#10": "NICE", "Brand#11": "IC 123",
}
PLANE_BRAND = "Brand#12"
SEGMENT_ROUTE_TYPES = {
    "BUILDING": "2", "AUTOMOBILE": "3", "MACHINERY": "102", "HOUSEHOLD": "abc", "FURNITURE": "117",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    tune(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- places ------------------------------------------------------------------
def station_lat(key: Column) -> Column:
    return F.lit(44.0) + ((key.cast("long") * 7919) % 800) / 100.0


def station_lon(key: Column) -> Column:
    return ((key.cast("long") * 104729) % 1200) / 100.0


def stop_lat(key: Column) -> Column:
    return F.lit(44.0) + ((key.cast("long") * 6271) % 800) / 100.0


def stop_lon(key: Column) -> Column:
    return ((key.cast("long") * 7507) % 1200) / 100.0


def s_lat(key: str) -> str:
    return f"(44e0 + ((CAST({key} AS BIGINT) * 7919) % 800) / 100e0)"


def s_lon(key: str) -> str:
    return f"(((CAST({key} AS BIGINT) * 104729) % 1200) / 100e0)"


def p_lat(key: str) -> str:
    return f"(44e0 + ((CAST({key} AS BIGINT) * 6271) % 800) / 100e0)"


def p_lon(key: str) -> str:
    return f"(((CAST({key} AS BIGINT) * 7507) % 1200) / 100e0)"


def clock(trip: Column, sequence: Column, shift: int) -> Column:
    """A time text from keys, with hours from 00 to 26."""
    minutes = (trip.cast("long") * 31 + sequence.cast("long") * 47 + shift) % 1620
    return F.concat(
        F.lpad((F.floor(minutes / 60)).cast("string"), 2, "0"), F.lit(":"),
        F.lpad((minutes % 60).cast("string"), 2, "0"), F.lit(":00"),
    )


def s_clock(trip: str, sequence: str, shift: int) -> str:
    minutes = f"((CAST({trip} AS BIGINT) * 31 + CAST({sequence} AS BIGINT) * 47 + {shift}) % 1620)"
    return (
        f"(lpad(CAST({minutes} // 60 AS VARCHAR), 2, '0') || ':' || "
        f"lpad(CAST({minutes} % 60 AS VARCHAR), 2, '0') || ':00')"
    )


def mapped(key: Column, values: dict[str, str], default: Column | None = None) -> Column:
    (first, text), *rest = values.items()
    case = F.when(key == first, F.lit(text))
    for k, v in rest:
        case = case.when(key == k, F.lit(v))
    return case if default is None else case.otherwise(default)


def s_mapped(key: str, values: dict[str, str], default: str = "NULL") -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items())
    return f"(CASE {key} {arms} ELSE {default} END)"


# --- SQL twins of the column functions -----------------------------------------
def s_haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return f"(12742e0 * atan2(sqrt({a}), sqrt(1 - {a})))"


def s_country(lat: str, lon: str) -> str:
    arms = " ".join(
        f"WHEN {lat} BETWEEN {a} AND {b} AND {lon} BETWEEN {c} AND {d} THEN '{code}'"
        for code, a, b, c, d in C.COUNTRY_RECTANGLES
    )
    return f"(CASE WHEN {lat} = 0 AND {lon} = 0 THEN NULL {arms} END)"


def s_steps(x: str, steps) -> str:
    arms = " ".join(f"WHEN {x} <= {upper}e0 THEN {value}e0" for upper, value in steps if upper)
    return f"(CASE {arms} WHEN {x} IS NOT NULL THEN {steps[-1][1]}e0 END)"


def s_factor(code: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN {v}e0" for k, v in C.ELECTRICITY.items())
    return f"(CASE {code} {arms} ELSE {C.DEFAULT_ELECTRICITY}e0 END)"


def s_train_co2(km: str, lat: str, lon: str) -> str:
    return f"(CASE WHEN {km} > 0 THEN {km} * 88.2e0 / 1000e0 * {s_factor(s_country(lat, lon))} END)"


def s_plane_co2(km: str) -> str:
    return (
        f"(CASE WHEN {km} > 0 THEN {km} * {s_steps(km, C.KEROSENE_G_PER_SEAT_KM)}"
        f" / {s_steps(km, C.LOAD_FACTOR)} / 1000e0 * 3.78e0 * {s_steps(km, C.RADIATIVE_FORCING)} END)"
    )


def s_co2(km: str, kind: str, lat: str, lon: str) -> str:
    return (
        f"(CASE WHEN {kind} IS NULL THEN NULL WHEN contains({kind}, 'Avion') THEN {s_plane_co2(km)}"
        f" ELSE {s_train_co2(km, lat, lon)} END)"
    )


def s_by_pattern(code: str, tail: str, patterns=None) -> str:
    arms = " ".join(
        f"WHEN regexp_matches(upper({code}), '{p}') THEN '{label}'"
        for p, label in patterns or C.SERVICE_PATTERNS
    )
    return f"(CASE {arms} {tail} END)"


def s_classify(code: str, route_type: str) -> str:
    return s_by_pattern(code, f"WHEN {route_type} = 102 THEN 'Train Nuit' ELSE 'Train Longue Distance'")


def s_hour(text: str) -> str:
    return f"TRY_CAST(trim(substr({text}, 1, 2)) AS INTEGER)"


NIGHT_TYPES_SQL = "('Train Nuit', 'EuroNight', 'Nightjet')"


def s_is_night(hour: str, base: str) -> str:
    return f"(coalesce({hour} >= 22 OR {hour} <= 6, FALSE) OR {base} IN {NIGHT_TYPES_SQL})"


def s_final_type(base: str, night: str) -> str:
    return (
        f"(CASE WHEN {night} AND {base} NOT IN {NIGHT_TYPES_SQL} THEN {base} || ' Nuit' ELSE {base} END)"
    )


# --- relations -----------------------------------------------------------------
def stations(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        F.col("c_name").alias("station_name"),
        station_lat(key).alias("station_lat"),
        station_lon(key).alias("station_long"),
    )


def airports(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        F.col("s_name").alias("airport_name"),
        stop_lat(key).alias("aero_lat"),
        stop_lon(key).alias("aero_long"),
        F.concat(F.lit("S"), key.cast("string")).alias("iata_code"),
        F.col("s_nationkey").cast("string").alias("country_code"),
    )


def part_types(spark: SparkSession, sf: str) -> DataFrame:
    """Parts with the train type of their service code."""
    code = mapped(F.col("p_brand"), BRAND_CODES, F.col("p_type"))
    coded = table(spark, sf, "part").withColumn("code", code)
    route_type = F.when(F.col("p_size") > 40, 102).otherwise(2)
    return coded.select(
        "p_partkey", "p_brand", "p_type", classify_timetable(F.col("code"), route_type).alias("base")
    )


def legs(spark: SparkSession, sf: str) -> DataFrame:
    """One leg per order line, from the customer's place to the supplier's; a customer in debt has no
    known place."""
    lines = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(part_types(spark, sf), F.col("l_partkey") == F.col("p_partkey"))
    )
    placed = F.col("c_acctbal") >= 0
    departure = clock(F.col("l_orderkey"), F.col("l_linenumber"), 0)
    night = is_night(hour_of(F.col("departure_time")), F.col("base"))
    kind = F.when(F.col("p_brand") == PLANE_BRAND, F.lit(C.PLANE)).otherwise(final_type(F.col("base"), night))
    rows = lines.withColumn("departure_time", departure).select(
        F.col("c_name").alias("origin"),
        F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("destination"),
        kind.alias("vehicule_type"),
        F.when(placed, station_lat(F.col("c_custkey"))).alias("station_lat"),
        F.when(placed, station_lon(F.col("c_custkey"))).alias("station_long"),
        stop_lat(F.col("l_suppkey")).alias("station_lat_dest"),
        stop_lon(F.col("l_suppkey")).alias("station_long_dest"),
        "departure_time",
        clock(F.col("l_orderkey"), F.col("l_linenumber"), 180).alias("arrival_time"),
        F.col("p_type").alias("source"),
        F.col("c_mktsegment").alias("provider"),
    )
    return typed(rows, LEG_TYPES)


def rides(spark: SparkSession, sf: str) -> DataFrame:
    """Every leg with km and kg, trains and planes."""
    return with_co2(with_distance(legs(spark, sf)))


def view(spark: SparkSession, sf: str) -> DataFrame:
    """Every ride in the shape users query."""
    return rides(spark, sf).select(
        F.col("origin").alias("origine"),
        "destination",
        F.col("source").alias("origine_ville"),
        F.col("provider").alias("destination_ville"),
        "distance_km",
        (F.col("distance_km") > 500).alias("is_long_distance"),
        "vehicule_type",
        F.when(F.col("vehicule_type") == C.PLANE, F.lit(None).cast("double")).otherwise(F.lit(0.9)).alias("facteur_co2"),
        "co2_kg",
    )


def train_legs(spark: SparkSession, sf: str) -> DataFrame:
    return legs(spark, sf).where(F.col("vehicule_type") != C.PLANE)


def rail(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned rail routes; stations, corridors and the final relation all read them."""
    return cut_lineage(rail_routes(train_legs(spark, sf)))


def routes(spark: SparkSession, sf: str) -> DataFrame:
    """The final relation: rail routes and the flights beside them."""
    rail_part = rail(spark, sf)
    links = cut_lineage(nearest_airports(stations_of(rail_part), airports(spark, sf)))
    found = cut_lineage(final_routes(rail_part, links))
    drop_staged(rail_part, links)
    return found


LEG_JOIN = """lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey"""
SUPPLIER_NAME = "'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0')"

CTES = {
    "stations": f"""SELECT c_name AS station_name, {s_lat('c_custkey')} AS station_lat,
  {s_lon('c_custkey')} AS station_long FROM customer""",
    "airports": f"""SELECT s_name AS airport_name, {p_lat('s_suppkey')} AS aero_lat,
  {p_lon('s_suppkey')} AS aero_long, 'S' || CAST(s_suppkey AS VARCHAR) AS iata_code,
  CAST(s_nationkey AS VARCHAR) AS country_code FROM supplier""",
    "coded": f"""SELECT *, {s_mapped('p_brand', BRAND_CODES, 'p_type')} AS code,
  CASE WHEN p_size > 40 THEN 102 ELSE 2 END AS route_type,
  {s_clock('l_orderkey', 'l_linenumber', 0)} AS departure_time FROM {LEG_JOIN}""",
    "based": f"SELECT *, {s_classify('code', 'route_type')} AS base FROM coded",
    "legs": f"""SELECT c_name AS origin, {SUPPLIER_NAME} AS destination,
  CASE WHEN p_brand = '{PLANE_BRAND}' THEN 'Avion'
    ELSE {s_final_type('base', s_is_night(s_hour('departure_time'), 'base'))} END AS vehicule_type,
  CASE WHEN c_acctbal >= 0 THEN {s_lat('c_custkey')} END AS station_lat,
  CASE WHEN c_acctbal >= 0 THEN {s_lon('c_custkey')} END AS station_long,
  {p_lat('l_suppkey')} AS station_lat_dest, {p_lon('l_suppkey')} AS station_long_dest,
  departure_time, {s_clock('l_orderkey', 'l_linenumber', 180)} AS arrival_time,
  p_type AS source, c_mktsegment AS provider FROM based""",
    "measured": f"""SELECT *, {s_haversine('station_lat', 'station_long', 'station_lat_dest', 'station_long_dest')}
  AS distance_km FROM legs""",
    "rides": f"""SELECT *, {s_co2('distance_km', 'vehicule_type', 'station_lat', 'station_long')} AS co2_kg
  FROM measured""",
    "ride_view": """SELECT origin AS origine, destination, source AS origine_ville, provider AS destination_ville,
  distance_km, distance_km > 500 AS is_long_distance, vehicule_type,
  CASE WHEN vehicule_type = 'Avion' THEN NULL ELSE 0.9e0 END AS facteur_co2, co2_kg FROM rides""",
    "rail": """SELECT *, origin AS origin_city, destination AS destination_city FROM rides
  WHERE vehicule_type <> 'Avion' AND trim(origin) <> '' AND trim(destination) <> '' AND origin <> destination
    AND (station_lat IS NULL OR station_lat <> 0) AND (station_long IS NULL OR station_long <> 0)
    AND (distance_km >= 100 OR distance_km IS NULL)""",
    "ends": """SELECT origin AS station_name, station_lat, station_long FROM rail
  UNION SELECT destination, station_lat_dest, station_long_dest FROM rail""",
    "links": f"""SELECT * FROM (SELECT e.*, a.*, {s_haversine('station_lat', 'station_long', 'aero_lat', 'aero_long')}
    AS station_airport_km, row_number() OVER (PARTITION BY station_name ORDER BY
      round({s_haversine('station_lat', 'station_long', 'aero_lat', 'aero_long')}, 6), iata_code, airport_name) AS rn
  FROM ends e JOIN airports a ON abs(station_lat - aero_lat) <= 1 AND abs(station_long - aero_long) <= 1
  WHERE {s_haversine('station_lat', 'station_long', 'aero_lat', 'aero_long')} <= 50) WHERE rn = 1""",
    "flight_pairs": f"""SELECT c.origin, c.destination, o.iata_code AS iata_origin, d.iata_code AS iata_dest,
  o.aero_lat AS lat_origin, o.aero_long AS lon_origin, d.aero_lat AS lat_dest, d.aero_long AS lon_dest,
  {s_haversine('o.aero_lat', 'o.aero_long', 'd.aero_lat', 'd.aero_long')} AS distance_km
  FROM (SELECT DISTINCT origin, destination FROM rail) c
  JOIN links o ON o.station_name = c.origin JOIN links d ON d.station_name = c.destination""",
    "flights": f"""SELECT *, {s_plane_co2('distance_km')} AS co2_kg FROM flight_pairs WHERE distance_km >= 100""",
    "united": """SELECT origin, destination, vehicule_type, origin_city, destination_city, station_lat, station_long,
    station_lat_dest, station_long_dest, distance_km, co2_kg, departure_time, arrival_time, source, provider FROM rail
  UNION ALL SELECT origin, destination, 'Avion', origin, destination, lat_origin, lon_origin, lat_dest, lon_dest,
    distance_km, co2_kg, NULL, NULL, 'airports', 'OurAirports' FROM flights""",
    "routes": """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY origin, destination,
    vehicule_type, source ORDER BY provider, departure_time, arrival_time) AS rn FROM united) WHERE rn = 1""",
    "trains": "SELECT * FROM routes WHERE NOT contains(vehicule_type, 'Avion')",
    "train_corridors": """SELECT origin, destination, vehicule_type, min(co2_kg) AS co2_train_kg,
  avg(distance_km) AS distance_km, min(station_lat) AS station_lat, min(station_long) AS station_long,
  min(station_lat_dest) AS station_lat_dest, min(station_long_dest) AS station_long_dest,
  min(origin_city) AS origin_city, min(destination_city) AS destination_city
  FROM trains GROUP BY origin, destination, vehicule_type""",
    "plane_minimum": """SELECT origin, destination, min(co2_kg) AS co2_avion_kg FROM routes
  WHERE contains(vehicule_type, 'Avion') GROUP BY origin, destination""",
    "fact": """SELECT t.*, co2_avion_kg, co2_avion_kg - co2_train_kg AS co2_saved_kg,
  CASE WHEN distance_km <= 600 AND co2_avion_kg IS NOT NULL THEN 1 ELSE 0 END AS is_substitutable
  FROM train_corridors t LEFT JOIN plane_minimum p ON p.origin = t.origin AND p.destination = t.destination""",
    "dim_route": """SELECT origin AS dep_name, destination AS arr_name, min(origin_city) AS dep_city,
  min(destination_city) AS arr_city, avg(distance_km) AS distance_km, avg(distance_km) > 100 AS is_long_distance
  FROM trains GROUP BY origin, destination""",
    "dim_vehicle": """SELECT DISTINCT vehicule_type AS label, vehicule_type AS service_type,
  CASE WHEN vehicule_type IN ('TGV', 'ICE', 'AVE', 'Frecciarossa', 'Frecciargento') THEN 0.29e0 ELSE 0.9e0 END
  AS co2_vt FROM trains""",
    "dim_station": """SELECT station_name, city, lat, lon FROM (SELECT *, row_number() OVER (PARTITION BY station_name
    ORDER BY lat IS NULL OR lon IS NULL, city, lat, lon) AS rn FROM
    (SELECT origin AS station_name, origin_city AS city, station_lat AS lat, station_long AS lon FROM fact
     UNION ALL SELECT destination, destination_city, station_lat_dest, station_long_dest FROM fact)) WHERE rn = 1""",
    "data_rows": """SELECT origin AS origine, destination, r.dep_city AS origine_ville, r.arr_city AS destination_ville,
    r.distance_km, r.is_long_distance, vehicule_type, co2_vt AS facteur_co2, co2_train_kg AS co2_kg
    FROM fact f JOIN dim_route r ON dep_name = origin AND arr_name = destination
    JOIN dim_vehicle ON label = vehicule_type
  UNION ALL SELECT origin, destination, r.dep_city, r.arr_city, r.distance_km, r.is_long_distance, 'Avion', NULL,
    co2_avion_kg FROM plane_minimum JOIN dim_route r ON dep_name = origin AND arr_name = destination""",
}


def sql(body: str, digits: int | None = None, rounded: str = "") -> str:
    """`body` with the relations it names put before it; `rounded` lists columns to round."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(CTES[name])
                needed.add(name)

    visit(body)
    if rounded:
        swaps = ", ".join(f"round({c}, {digits}) + 0e0 AS {c}" for c in rounded.split())
        body = f"SELECT * REPLACE ({swaps}) FROM ({body})"
    relations = [f"{name} AS ({CTES[name]})" for name in CTES if name in needed]
    return f"WITH {', '.join(relations)} {body}" if relations else body


def rounded(df: DataFrame, digits: int, columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns.split()})
