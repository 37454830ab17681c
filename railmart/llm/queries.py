"""One registered query per operator, over its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railmart.llm import (
    alignment, bpe, chunks, contamination, exact, lines, mixing, ngram_join, phrases, quality, spelling, suffixes, toxicity,
)
from railmart.llm.common import staged

REPEATS = 1.25  # passes over any source that the mix allows


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op2_phrase_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and how near it is to that and to the next document."""
    return phrases.neighbours(table(spark, sf, "documents"))


def op6_chunk_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with the chunks it shares and loses, and the digest of the text that is left."""
    return chunks.dedup(table(spark, sf, "documents").select("doc_id", "text"), tails=True).select(
        "doc_id", "n_bytes", "n_shared", "n_repeated", "n_removed", "first_id", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op4_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with its lines, those dropped as near copies of an earlier line, and the digest of what is left."""
    return lines.dedup(table(spark, sf, "documents").select("doc_id", "text"), distance=None).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


def op5_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's quality, learned from the labelled rows outside the held-out fifth."""
    held_out = toxicity.held_out(parts=5, part=0)
    stats = quality.described(table(spark, sf, "documents"), "doc_id", "text")
    model = quality.train(stats, table(spark, sf, "labels").where(~held_out))
    return quality.score(stats, model).withColumn("held_out", held_out).select("doc_id", "held_out", "score", "predicted")


def op8_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """What is read of every source, when none may be read more than REPEATS times for as many tokens as there are."""
    return mixing.draw(table(spark, sf, "documents"), repeats=REPEATS)


def op9_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Token counts and digests of every document's ids and of the text decoded from them."""
    return bpe.round_trip(table(spark, sf, "documents"))


def op7_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with the copy that stays for its text, by text without regard to the case of A-Z."""
    return exact.dedup(table(spark, sf, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("text_digest").alias("text_sha256")
    )


def op3_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with the size of its shingle set and the smallest id it reaches by links."""
    return ngram_join.link(table(spark, sf, "documents").select("doc_id", "text")).drop("text")


def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's toxicity, learned from the labelled rows outside the held-out quarter."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf, "labels").where(~toxicity.held_out()))
    held = docs.withColumn("held_out", toxicity.held_out())
    return toxicity.score(held, model).select("doc_id", "held_out", "score", "predicted")


def op10_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the bytes that any repeated string of 400 bytes covers."""
    return suffixes.dedup(table(spark, sf, "documents").select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op12_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with its words inside windows of the benchmark's items, and the items they come from."""
    found = contamination.mark(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op13_spelling(spark: SparkSession, sf: str) -> DataFrame:
    """Every word of the documents with the number of words one edit away, its form, and the last form behind it."""
    words = staged(spelling.vocabulary(table(spark, sf, "documents"), slips=97), "words", narrow=8)
    return spelling.grouped(words)


def op11_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with its tokens, groups and links under two tokenizers, and the counts of its linked pairs."""
    return alignment.align(table(spark, sf, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op7_exact_dedup": op7_exact_dedup,
    "op2_phrase_fingerprints": op2_phrase_fingerprints,
    "op4_line_dedup": op4_line_dedup,
    "op5_quality": op5_quality,
    "op6_chunk_dedup": op6_chunk_dedup,
    "op8_mixing": op8_mixing,
    "op9_bpe": op9_bpe,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_alignment": op11_alignment,
    "op12_decontamination": op12_decontamination,
    "op13_spelling": op13_spelling,
}

SQL: dict[str, str] = {
    "op8_mixing": f"""
        WITH RECURSIVE docs AS MATERIALIZED (
            SELECT doc_id, min(coalesce(source, '')) AS source,
                   sum(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')))::BIGINT AS tokens
            FROM documents GROUP BY doc_id
        ), sources AS MATERIALIZED (
            SELECT source, sum(tokens)::BIGINT AS total, sum(tokens) / (SELECT sum(tokens) FROM docs)::DOUBLE AS share
            FROM docs GROUP BY source HAVING sum(tokens) > 0
        ), bisected(i, low, high) AS (
            SELECT 0, 0::DOUBLE, 1::DOUBLE
            UNION ALL
            SELECT i + 1, CASE WHEN fits THEN low ELSE middle END, CASE WHEN fits THEN middle ELSE high END
            FROM (
                SELECT i, low, high, (low + high) / 2 AS middle,
                       (SELECT max(power(share, (low + high) / 2 - 1)) / sum(power(share, (low + high) / 2)) <= {REPEATS}
                        FROM sources) AS fits
                FROM bisected WHERE i < 50
            )
        ), alpha AS (SELECT high AS x FROM bisected WHERE i = 50),
        plan AS MATERIALIZED (
            SELECT *, quota // total AS epochs, quota % total AS rest FROM (
                SELECT source, total, round((SELECT sum(tokens) FROM docs) * power(share, x) / norm)::BIGINT AS quota
                FROM sources, alpha, (SELECT sum(power(share, x)) AS norm FROM sources, alpha)
            )
        ), placed AS MATERIALIZED (
            SELECT doc_id, source, tokens,
                   ('0x' || substr(md5('mix|' || doc_id), 1, 8))::BIGINT % (1 + total // 100000) AS block
            FROM docs JOIN plan USING (source)
        ), blocks AS (
            SELECT source, block, epoch, CASE WHEN epoch < epochs THEN NULL ELSE rest END AS rest,
                   row_number() OVER w AS block_rank, (sum(amount) OVER w - amount)::BIGINT AS before
            FROM (
                SELECT *, md5('mix|' || source || '|' || epoch || '|' || block) AS turn FROM (
                    SELECT *, unnest(range(CASE WHEN rest > 0 THEN epochs + 1 ELSE epochs END)) AS epoch
                    FROM (SELECT source, block, sum(tokens)::BIGINT AS amount FROM placed GROUP BY ALL) JOIN plan USING (source)
                )
            )
            WINDOW w AS (PARTITION BY source, epoch ORDER BY turn, block ROWS UNBOUNDED PRECEDING)
        )
        SELECT doc_id, source, n_tokens, epoch, block_rank, place FROM (
            SELECT doc_id, source, tokens AS n_tokens, epoch, block_rank, rest, before,
                   row_number() OVER w AS place, sum(tokens) OVER w AS so_far
            FROM (SELECT *, md5('mix|' || epoch || '|' || doc_id) AS turn FROM placed JOIN blocks USING (source, block))
            WINDOW w AS (PARTITION BY source, epoch, block ORDER BY turn, doc_id ROWS UNBOUNDED PRECEDING)
        ) WHERE rest IS NULL OR before + so_far <= rest
    """,
    "op7_exact_dedup": """
        WITH t AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x
            FROM documents
        ), g AS (SELECT x, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY x)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(x) AS text_sha256
        FROM t JOIN g USING (x)
    """,
    "op12_decontamination": """
        WITH docs AS MATERIALIZED (
            SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
            FROM documents
        ), items AS (
            SELECT item_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
            FROM benchmark
        ), windows AS MATERIALIZED (
            SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[place:place + least(len(words), 10) - 1], ' ') AS x
            FROM (SELECT *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS place FROM items WHERE len(words) > 0)
        ), spots AS (
            SELECT row, n, place, array_to_string(words[place:place + n - 1], ' ') AS x
            FROM (SELECT row, words, n, unnest(range(1, len(words) - n + 2)) AS place FROM docs, (SELECT DISTINCT n FROM windows))
        ), met AS MATERIALIZED (SELECT row, n, place, item_id FROM spots JOIN windows USING (n, x)),
        hits AS (
            SELECT row, count(DISTINCT word) AS n_hit
            FROM (SELECT row, unnest(range(place, place + n)) AS word FROM (SELECT DISTINCT row, n, place FROM met)) GROUP BY row
        ), listed AS (
            SELECT row, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
            FROM (SELECT DISTINCT row, item_id::VARCHAR AS id FROM met) GROUP BY row
        )
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hits USING (row) LEFT JOIN listed USING (row)
    """,
}
