"""Reader-side operators: catalogue filters, tolerant typing, cubes and JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from railmart import constants as C
from railmart.catalog import standins as S
from railmart.schemas import keep_existing, rename_existing, typed
from railmart.sources.catalogue import feeds_to_load
from railmart.sources.cube import decode_cube
from railmart.sources.population import of_listed_countries

COUNTRIES = {"BUILDING": "FR", "AUTOMOBILE": "DE", "MACHINERY": "US", "HOUSEHOLD": "CH", "FURNITURE": "IT"}
WORDS = {"PROMO": " Bus", "SMALL": " autocars", "LARGE": " Fernverkehr", "ECONOMY": " TER"}
CUBE_ID = ["flag", "status", "line"]
FLAGS, STATUSES, LINES = ["A", "N", "R"], ["F", "O"], 7
CODED_LINES = 5


def feed_filter(spark, sf):
    """Parts as catalogue entries; every fifth size class has no dataset."""
    catalogue = S.table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.concat("p_name", S.mapped(F.col("p_type"), WORDS, F.lit(""))).alias("provider"),
        F.when(F.col("p_size") > 10, F.col("p_brand")).alias("feed_name"),
        F.when(F.col("p_size") < 25, F.lit("FR")).otherwise(F.lit("DE")).alias("country"),
        F.when(
            F.col("p_retailprice") > 950,
            F.struct(F.when(F.col("p_size") != 7, F.concat(F.lit("https://x/"), "p_name")).alias("hosted_url")),
        ).alias("latest_dataset"),
    )
    return feeds_to_load(catalogue, ["FR"])


def country_whitelist(spark, sf):
    """Customers of listed countries only."""
    rows = S.table(spark, sf, "customer").select("c_custkey", S.mapped(F.col("c_mktsegment"), COUNTRIES).alias("country"))
    return of_listed_countries(rows, "country")


def typed_clean(spark, sf):
    """Events as text columns under raw names, some unreadable, brought to our names and types."""
    raw = S.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("latitude_deg"),
        F.col("event_type").alias("type"),
        F.when(F.col("event_type") == "click", F.lit("1")).when(F.col("event_type") == "view", F.lit("?")).alias("flag"),
        F.lit("x").alias("name"),
        F.lit("kept").alias("airport_name"),
    )
    named = rename_existing(raw, C.COLUMN_NAMES["airports"])
    picked = keep_existing(named, ["event_id", "aero_lat", "category", "flag", "airport_name", "missing"])
    clean = typed(picked, {"event_id": "long", "aero_lat": "double", "category": "string", "flag": "int",
                           "airport_name": "string", "ident": "string"})
    return clean.withColumn("flag", F.coalesce("flag", F.lit(0)))


def sdmx_decode(spark, sf):
    """Every supplier's quantities as a cube over (flag, status, line), decoded again. Lines beyond
    the fifth have no code and come back as their position."""
    flag = F.array_position(F.array(*map(F.lit, FLAGS)), F.col("l_returnflag")) - 1
    status = F.array_position(F.array(*map(F.lit, STATUSES)), F.col("l_linestatus")) - 1
    flat = (flag * len(STATUSES) + status) * LINES + F.col("l_linenumber") - 1
    cells = S.table(spark, sf, "lineitem").groupBy("l_suppkey", flat.cast("string").alias("flat")).agg(
        F.sum("l_quantity").alias("value")
    )

    def index(codes: list[str]):
        return F.map_from_arrays(
            F.array(*map(F.lit, codes)), F.array(*[F.lit(i).cast("long") for i in range(len(codes))])
        )

    def category(codes: list[str]):
        return F.struct(F.struct(index(codes).alias("index")).alias("category"))

    lines = [f"L{i + 1}" for i in range(CODED_LINES)]
    # a cube holds at most 42 cells
    cubes = cells.groupBy("l_suppkey").agg(
        F.map_from_entries(F.collect_list(F.struct("flat", "value"))).alias("value")
    ).select(
        "l_suppkey",
        F.array(*map(F.lit, CUBE_ID)).alias("id"),
        F.array(*[F.lit(n).cast("long") for n in (len(FLAGS), len(STATUSES), LINES)]).alias("size"),
        "value",
        F.create_map(
            F.lit("flag"), category(FLAGS), F.lit("status"), category(STATUSES), F.lit("line"), category(lines)
        ).alias("dimension"),
    )
    decoded = decode_cube(cubes, ["l_suppkey"])
    return decoded.select("l_suppkey", *[F.try_element_at("codes", F.lit(d)).alias(d) for d in CUBE_ID], "value")


def json_props(spark, sf):
    """The JSON text of every event as typed columns."""
    parsed = F.from_json("props", "k long")
    return S.table(spark, sf, "events").select("event_id", parsed["k"].alias("k"))


QUERIES = {f.__name__: f for f in (feed_filter, country_whitelist, typed_clean, sdmx_decode, json_props)}

PROVIDER = f"(p_name || {S.s_mapped('p_type', WORDS, chr(39) * 2)})"
SQL = {
    "feed_filter": f"""SELECT 'FR' AS country, CAST(p_partkey AS VARCHAR) AS feed,
        'FR_' || left(replace({PROVIDER}, ' ', '_'), 40) || '_' || CAST(p_partkey AS VARCHAR) AS folder,
        'https://x/' || p_name AS url FROM part WHERE p_retailprice > 950 AND p_size <> 7 AND p_size < 25
        AND NOT regexp_matches(lower({PROVIDER} || ' ' || CASE WHEN p_size > 10 THEN p_brand ELSE '' END),
          '{"|".join(C.FEED_EXCLUDE_WORDS)}')""",
    "country_whitelist": f"""SELECT c_custkey, {S.s_mapped('c_mktsegment', COUNTRIES)} AS country FROM customer
        WHERE c_mktsegment <> 'MACHINERY'""",
    "typed_clean": """SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS aero_lat, event_type AS category,
        CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS flag, 'kept' AS airport_name, CAST(NULL AS VARCHAR) AS ident
        FROM events""",
    "sdmx_decode": """SELECT l_suppkey, l_returnflag AS flag, l_linestatus AS status, CASE WHEN l_linenumber <= 5
        THEN 'L' || CAST(l_linenumber AS VARCHAR) ELSE CAST(l_linenumber - 1 AS VARCHAR) END AS line,
        sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2, 3, 4""",
    "json_props": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
}
