"""Places, distances, CO2 and airports."""

from __future__ import annotations

from pyspark.sql import functions as F

from railmart.catalog import standins as S
from railmart.functions.carbon import electricity_factor, plane_co2, train_co2, vehicle_factor
from railmart.functions.geo import country_of, haversine
from railmart.operators.cleaning import far_enough, rail_routes, with_distance
from railmart.operators.nearest import (
    distinct_airports, nearby_pairs, nearest_airports, stations_of,
)
from railmart.operators.planes import corridors_of, plane_corridors
from railmart.operators.profile import map_lines
from railmart.operators.star import fact_corridors
from railmart.session import cut_lineage, drop_staged
from railmart.sources.airports import usable_airports

LINK_COLUMNS = ["station_name", "airport_name", "iata_code", "country_code", "station_airport_km"]


def haversine_pairs(spark, sf):
    measured = far_enough(with_distance(S.legs(spark, sf)))
    return S.rounded(measured.select("origin", "destination", "vehicule_type", "distance_km"), 4, "distance_km")


def country_rect(spark, sf):
    lat, lon = F.col("station_lat"), F.col("station_long")
    return S.stations(spark, sf).select(
        "station_name", country_of(lat, lon).alias("country"), electricity_factor(lat, lon).alias("factor")
    )


def co2_train(spark, sf):
    """Every station's ride to the fixed point (48, 6)."""
    lat, lon = F.col("station_lat"), F.col("station_long")
    km = S.stations(spark, sf).withColumn("km", haversine(lat, lon, F.lit(48.0), F.lit(6.0)))
    return S.rounded(km.select("station_name", "km", train_co2(F.col("km"), lat, lon).alias("kg")), 4, "km kg")


def co2_plane(spark, sf):
    """Flight CO2 with each order's value as its km, which crosses every step."""
    km = F.col("o_totalprice") / 300.0 - 10.0
    rows = S.table(spark, sf, "orders").select("o_orderkey", km.alias("km"))
    return S.rounded(rows.select("o_orderkey", plane_co2(F.col("km")).alias("kg")), 4, "kg")


def band_join(spark, sf):
    pairs = nearby_pairs(S.stations(spark, sf), distinct_airports(S.airports(spark, sf)))
    return S.rounded(pairs.select("station_name", "iata_code", "station_airport_km"), 4, "station_airport_km")


def nearest_airport(spark, sf):
    links = nearest_airports(S.stations(spark, sf), S.airports(spark, sf))
    return S.rounded(links.select(*LINK_COLUMNS), 4, "station_airport_km")


def nearest_window(spark, sf):
    """Nearest airport by the full 50 km circle, without the degree band."""
    links = nearest_airports(S.stations(spark, sf), S.airports(spark, sf), band=None)
    return S.rounded(links.select(*LINK_COLUMNS), 4, "station_airport_km")


def station_points(spark, sf):
    return S.rounded(stations_of(S.legs(spark, sf)), 4, "station_lat station_long")


def airport_points(spark, sf):
    """Every supplier listed twice collapses to one row per code and place."""
    twice = S.airports(spark, sf)
    return S.rounded(distinct_airports(twice.unionByName(twice)), 4, "aero_lat aero_long")


def airport_filter(spark, sf):
    """Supplier list in a raw airport list's columns, category by balance, some without a place."""
    balance = F.col("s_acctbal")
    raw = S.table(spark, sf, "supplier").select(
        F.col("s_name").alias("name"),
        F.when(balance > 0, S.stop_lat(F.col("s_suppkey")).cast("string")).otherwise(F.lit("n/a")).alias("latitude_deg"),
        S.stop_lon(F.col("s_suppkey")).cast("string").alias("longitude_deg"),
        F.when(balance < 2000, F.lit("small_airport")).when(balance < 4000, F.lit("heliport"))
        .when(balance < 7000, F.lit("medium_airport")).otherwise(F.lit("large_airport")).alias("type"),
        F.col("s_nationkey").cast("string").alias("iso_country"),
    )
    usable = usable_airports(raw).select("airport_name", "aero_lat", "aero_long", "category", "country_code")
    return S.rounded(usable, 4, "aero_lat aero_long")


def corridors(spark, sf):
    return corridors_of(rail_routes(S.train_legs(spark, sf)))


def plane_corridors_query(spark, sf):
    rail = S.rail(spark, sf)
    links = nearest_airports(stations_of(rail), S.airports(spark, sf))
    flights = plane_corridors(rail, links).select(
        "origin", "destination", "iata_origin", "iata_dest", "distance_km", "co2_kg"
    )
    return S.rounded(flights, 4, "distance_km co2_kg")


def vehicle_factors(spark, sf):
    return S.legs(spark, sf).select("vehicule_type").distinct().select(
        "vehicule_type", vehicle_factor(F.col("vehicule_type")).alias("co2_vt")
    )


def map_lines_query(spark, sf):
    routes = S.routes(spark, sf)
    fact = cut_lineage(fact_corridors(routes))
    drop_staged(routes)
    lines = map_lines(fact)
    return S.rounded(lines, 2, "station_lat station_long station_lat_dest station_long_dest")


QUERIES = {
    "haversine_pairs": haversine_pairs,
    "country_rect": country_rect,
    "co2_train": co2_train,
    "co2_plane": co2_plane,
    "band_join": band_join,
    "nearest_airport": nearest_airport,
    "nearest_window": nearest_window,
    "station_points": station_points,
    "airport_points": airport_points,
    "airport_filter": airport_filter,
    "corridors": corridors,
    "plane_corridors": plane_corridors_query,
    "vehicle_factor": vehicle_factors,
    "map_lines": map_lines_query,
}

HERE = S.s_haversine("station_lat", "station_long", "aero_lat", "aero_long")
NEAREST = f"""SELECT station_name, airport_name, iata_code, country_code, km AS station_airport_km FROM (
  SELECT *, row_number() OVER (PARTITION BY station_name ORDER BY round(km, 6), iata_code, airport_name) AS rn
  FROM (SELECT s.*, a.*, {HERE} AS km FROM stations s JOIN airports a ON {{band}})
  WHERE km <= 50) WHERE rn = 1"""
IN_BAND = "abs(station_lat - aero_lat) <= 1 AND abs(station_long - aero_long) <= 1"
TO_FIXED = S.s_haversine("station_lat", "station_long", "48e0", "6e0")
STATION_COUNTRY = S.s_country("station_lat", "station_long")

SQL = {
    "haversine_pairs": S.sql(
        """SELECT origin, destination, vehicule_type, distance_km FROM measured
        WHERE distance_km >= 100 OR distance_km IS NULL OR contains(vehicule_type, 'Avion')""",
        4, "distance_km"),
    "country_rect": S.sql(
        f"SELECT station_name, {STATION_COUNTRY} AS country, {S.s_factor(STATION_COUNTRY)} AS factor FROM stations"),
    "co2_train": S.sql(
        f"""SELECT station_name, km, {S.s_train_co2('km', 'station_lat', 'station_long')} AS kg
        FROM (SELECT *, {TO_FIXED} AS km FROM stations)""", 4, "km kg"),
    "co2_plane": S.sql(
        f"SELECT o_orderkey, {S.s_plane_co2('km')} AS kg FROM (SELECT o_orderkey, o_totalprice / 300e0 - 10e0 AS km FROM orders)",
        4, "kg"),
    "band_join": S.sql(
        f"""SELECT station_name, iata_code, {HERE} AS station_airport_km FROM stations JOIN airports ON {IN_BAND}
        WHERE {HERE} <= 50""", 4, "station_airport_km"),
    "nearest_airport": S.sql(NEAREST.format(band=IN_BAND), 4, "station_airport_km"),
    "nearest_window": S.sql(NEAREST.format(band="TRUE"), 4, "station_airport_km"),
    "station_points": S.sql(
        """SELECT origin AS station_name, station_lat, station_long FROM legs WHERE station_lat IS NOT NULL
        UNION SELECT destination, station_lat_dest, station_long_dest FROM legs""", 4, "station_lat station_long"),
    "airport_points": S.sql(
        "SELECT iata_code, aero_lat, aero_long, airport_name, country_code FROM airports", 4, "aero_lat aero_long"),
    "airport_filter": S.sql(
        f"""SELECT s_name AS airport_name, {S.p_lat('s_suppkey')} AS aero_lat, {S.p_lon('s_suppkey')} AS aero_long,
        CASE WHEN s_acctbal < 2000 THEN 'small_airport' WHEN s_acctbal < 7000 THEN 'medium_airport'
        ELSE 'large_airport' END AS category, CAST(s_nationkey AS VARCHAR) AS country_code
        FROM supplier WHERE s_acctbal > 0 AND NOT (s_acctbal >= 2000 AND s_acctbal < 4000)""",
        4, "aero_lat aero_long"),
    "corridors": S.sql("SELECT DISTINCT origin, destination FROM rail"),
    "plane_corridors": S.sql(
        "SELECT origin, destination, iata_origin, iata_dest, distance_km, co2_kg FROM flights", 4, "distance_km co2_kg"),
    "vehicle_factor": S.sql(
        """SELECT DISTINCT vehicule_type, CASE WHEN vehicule_type IN ('TGV', 'ICE', 'AVE', 'Frecciarossa',
        'Frecciargento') THEN 0.29e0 ELSE 0.9e0 END AS co2_vt FROM legs"""),
    "map_lines": S.sql(
        """SELECT station_lat, station_long, station_lat_dest, station_long_dest,
        CASE WHEN is_substitutable = 1 THEN 'substituable' ELSE 'non substituable' END AS classe,
        origin || ' → ' || destination AS route, round(distance_km, 0) + 0e0 AS km,
        CASE WHEN co2_saved_kg IS NULL THEN 'N/A' ELSE printf('%.1fkg', co2_saved_kg) END AS co2_saved
        FROM fact WHERE station_lat IS NOT NULL AND station_long IS NOT NULL""",
        2, "station_lat station_long station_lat_dest station_long_dest"),
}
