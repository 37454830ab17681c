"""Name folding and lookups, over every document and part name."""

from __future__ import annotations

from pyspark.sql import functions as F

from railmart import constants as C
from railmart.catalog import standins as S
from railmart.functions.text import (
    clean_station, file_safe, fold_name, prefix_candidates, strip_name_prefix,
)
from railmart.operators.lookups import (
    fold_reference, largest_by_name, prefix_lookup, prefix_lookup_with_fallback, tiered_lookup,
)

PREFIXED = {"SMALL": "Gare de ", "LARGE": "Gare du ", "PROMO": "Aéroport d'", "MEDIUM": "GARE-DES_"}


def part(spark, sf):
    return S.table(spark, sf, "part")


def fold_names(spark, sf):
    """Every document's whole text as a folded key, shown by digest and length."""
    folded = fold_name(F.col("text"))
    rows = S.table(spark, sf, "documents").select("doc_id", folded.alias("key"))
    return rows.select("doc_id", F.md5("key").alias("digest"), F.length("key").alias("size"))


def clean_titles(spark, sf):
    """Station cleaning over every conversation turn with a code put behind it."""
    turns = S.table(spark, sf, "conversations").select(
        "conv_id", "turn", F.concat("text", F.lit("  ("), F.upper("role"), F.lit(") ")).alias("name")
    )
    cleaned = turns.select("conv_id", "turn", clean_station(F.col("name")).alias("name"))
    return cleaned.select("conv_id", "turn", F.md5("name").alias("digest"))


def names(spark, sf):
    """Distinct folded names: part names with a prefix by type and the brand behind."""
    name = F.concat(S.mapped(F.col("p_type"), PREFIXED, F.lit("")), "p_name", F.lit(" "), "p_brand")
    return part(spark, sf).select(fold_name(name).alias("norm")).distinct()


def reference(spark, sf):
    """Listing in part order: whole names, last words, names with more behind, brands."""
    words = F.split("p_name", " ")
    kind = F.col("p_type")
    name = (
        F.when(kind == "SMALL", F.get(words, F.lit(1)))
        .when(kind == "ECONOMY", F.concat(F.lit("Gare du "), "p_name", F.lit(" "), "p_brand", F.lit(" Hbf")))
        .when(kind == "PROMO", F.concat("p_name", F.lit(" "), "p_brand"))
        .when(kind == "LARGE", F.concat("p_brand", F.lit(" nord")))
        .otherwise(F.substring("p_brand", -2, 2))
    )
    return part(spark, sf).select(name.alias("name"), F.col("p_retailprice").alias("value"), F.col("p_partkey").alias("ord"))


def tiered_name_lookup(spark, sf):
    return tiered_lookup(names(spark, sf), fold_reference(reference(spark, sf)))


def places(spark, sf):
    """Communes: first words, whole names and one prefix word, with repeated names."""
    kind = F.col("p_type")
    name = (
        F.when(kind == "SMALL", F.get(F.split("p_name", " "), F.lit(0)))
        .when(kind == "ECONOMY", F.col("p_name"))
        .when((kind == "PROMO") & (F.col("p_size") < 5), F.lit("Gare"))
        .otherwise(F.concat(F.lit("Saint-"), "p_name"))
    )
    return part(spark, sf).select(name.alias("name"), F.col("p_retailprice").alias("population"))


def gazetteer(spark, sf):
    """Second listing with two spellings per row."""
    return part(spark, sf).select(
        F.concat(F.lit("Aeroport "), F.get(F.split("p_name", " "), F.lit(1))).alias("ascii_name"),
        F.concat(F.lit("gare-"), "p_name").alias("name"),
        (F.col("p_retailprice") * 2).alias("population"),
    )


def token_prefix_lookup(spark, sf):
    found = prefix_lookup(names(spark, sf), largest_by_name(places(spark, sf), ["name"]))
    return S.rounded(found, 2, "population")


def fallback_lookup(spark, sf):
    first = largest_by_name(places(spark, sf).where("name <> 'Gare'"), ["name"])
    second = largest_by_name(gazetteer(spark, sf), ["ascii_name", "name"])
    return S.rounded(prefix_lookup_with_fallback(names(spark, sf), first, second), 2, "population")


def two_spellings(spark, sf):
    return S.rounded(largest_by_name(gazetteer(spark, sf), ["ascii_name", "name"]), 2, "population")


def prefix_strip(spark, sf):
    return names(spark, sf).select("norm", strip_name_prefix(F.col("norm")).alias("bare"),
                                   F.array_join(prefix_candidates(F.col("norm")), "|").alias("candidates"))


def sanitize_names(spark, sf):
    return S.table(spark, sf, "pages").select("page_id", file_safe(F.col("url")).alias("folder"))


QUERIES = {
    f.__name__: f
    for f in (
        fold_names, clean_titles, tiered_name_lookup, token_prefix_lookup, fallback_lookup, two_spellings,
        prefix_strip, sanitize_names,
    )
}


def s_fold(text: str) -> str:
    plain = f"strip_accents(replace({text}, 'ß', 'ss'))"
    return f"trim(replace(replace(upper({plain}), '-', ' '), '_', ' '))"


NAME = f"{S.s_mapped('p_type', {k: v.replace(chr(39), chr(39) * 2) for k, v in PREFIXED.items()}, chr(39) * 2)} || p_name || ' ' || p_brand"
NAMES = f"(SELECT DISTINCT {s_fold(NAME)} AS norm FROM part)"
REF_NAME = """CASE p_type WHEN 'SMALL' THEN split_part(p_name, ' ', 2)
  WHEN 'ECONOMY' THEN 'Gare du ' || p_name || ' ' || p_brand || ' Hbf' WHEN 'PROMO' THEN p_name || ' ' || p_brand
  WHEN 'LARGE' THEN p_brand || ' nord' ELSE right(p_brand, 2) END"""
REFERENCE = f"""(SELECT ref, arg_max(p_retailprice, p_partkey) AS value, min(p_partkey) AS ord FROM
  (SELECT *, {s_fold(REF_NAME)} AS ref FROM part) GROUP BY ref)"""
PLACE_NAME = """CASE WHEN p_type = 'SMALL' THEN split_part(p_name, ' ', 1) WHEN p_type = 'ECONOMY' THEN p_name
  WHEN p_type = 'PROMO' AND p_size < 5 THEN 'Gare' ELSE 'Saint-' || p_name END"""
STRIP = "^(" + "|".join(C.NAME_PREFIXES) + ")"


def places_sql(where: str = "TRUE") -> str:
    return f"""(SELECT {s_fold(PLACE_NAME)} AS key, max(p_retailprice) AS population FROM part WHERE {where} GROUP BY 1)"""


GAZETTEER = f"""(SELECT key, max(population) AS population FROM (
  SELECT {s_fold("'Aeroport ' || split_part(p_name, ' ', 2)")} AS key, p_retailprice * 2 AS population FROM part
  UNION ALL SELECT {s_fold("'gare-' || p_name")}, p_retailprice * 2 FROM part) GROUP BY 1)"""
# every leading token run of the name, then of the stripped name, by brute force
CANDIDATES = f"""(SELECT norm, min(rank) AS rank, key FROM (
  SELECT norm, 100 - n AS rank, array_to_string(list_slice(t, 1, n), ' ') AS key FROM (
    SELECT norm, t, unnest(range(1, len(t) + 1)) AS n FROM (SELECT norm, string_split(norm, ' ') AS t FROM {NAMES}))
  UNION ALL SELECT norm, 200 - n, array_to_string(list_slice(t, 1, n), ' ') FROM (
    SELECT norm, t, unnest(range(1, len(t) + 1)) AS n FROM (
      SELECT norm, string_split(regexp_replace(norm, '{STRIP}', ''), ' ') AS t FROM {NAMES}))) GROUP BY norm, key)"""


def lookup_sql(table: str) -> str:
    return f"""(SELECT norm, arg_min(population, rank) AS population FROM {CANDIDATES} c
  JOIN {table} t ON t.key = c.key GROUP BY norm)"""


SQL = {
    "fold_names": f"""SELECT doc_id, md5(key) AS digest, length(key) AS size FROM
        (SELECT doc_id, {s_fold('text')} AS key FROM documents)""",
    "clean_titles": """SELECT conv_id, turn, md5(trim(regexp_replace(CASE WHEN length(role) BETWEEN 2 AND 5
        THEN regexp_replace(text, '\\s+$', '') ELSE text || '  (' || upper(role) || ') ' END, '\\s+', ' ', 'g'))) AS digest
        FROM conversations""",
    "tiered_name_lookup": f"""SELECT norm, value, tier FROM (SELECT norm, value,
        CASE WHEN ref = norm THEN 1 WHEN contains(norm, ref) THEN 2 ELSE 3 END AS tier,
        row_number() OVER (PARTITION BY norm ORDER BY CASE WHEN ref = norm THEN 1 WHEN contains(norm, ref) THEN 2
          ELSE 3 END, ord, ref) AS rn FROM {NAMES} n JOIN {REFERENCE} r
        ON ref <> '' AND norm <> '' AND (contains(norm, ref) OR contains(ref, norm))) WHERE rn = 1""",
    "token_prefix_lookup": S.sql(f"SELECT * FROM {lookup_sql(places_sql())}", 2, "population"),
    "fallback_lookup": S.sql(
        f"""SELECT n.norm, coalesce(a.population, b.population) AS population FROM {NAMES} n
        LEFT JOIN {lookup_sql(places_sql(f"{PLACE_NAME} <> 'Gare'"))} a ON a.norm = n.norm
        LEFT JOIN {lookup_sql(GAZETTEER)} b ON b.norm = n.norm""", 2, "population"),
    "two_spellings": S.sql(f"SELECT * FROM {GAZETTEER}", 2, "population"),
    "prefix_strip": f"""SELECT norm, regexp_replace(norm, '{STRIP}', '') AS bare, candidates FROM (
        SELECT norm, string_agg(key, '|' ORDER BY rank) AS candidates FROM {CANDIDATES} GROUP BY norm)""",
    "sanitize_names": """SELECT page_id, left(trim(replace(regexp_replace(url, '[\\\\/*?:"<>|]', '', 'g'), ' ', '_')), 40)
        AS folder FROM pages""",
}
