"""Mixing sources to target weights by temperature, in DataFrame operations only.

Each source's share of all tokens is raised to an exponent between 0 (even) and 1 (as found) and normalised. The exponent is
bisected until the weights' entropy comes down to `entropy`, or until no source is read more than `repeats` times. A weight gives
a source its part of the token budget: whole epochs over all its documents, then part of one more. For every epoch a
source's blocks of documents are permuted, and the documents within each block; the last epoch goes on until the next
document would pass the budget.

Tokens are runs without ASCII white space; null and empty texts have none. A null source counts as the source ''. Sources
without tokens get weight 0: they are left out unless the budget is met exactly by nothing, so their documents, which all are
empty, do not appear. Rows that share an id are one document with their tokens together (its source is the
smallest name). Ties in the permutation go by id. Rows with a null id are never drawn, as in the query's SQL, though
their tokens count in their source's total: what is read is told by id. An empty table or a budget of 0 gives no rows.
The table of sources is gathered in one row: a name and two numbers for each source, whatever the number of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railmart.llm.common import staged

WORD = r"[^\x20\x09-\x0D]+"
STEPS = 50  # of the bisection
BLOCK_TOKENS = 100_000
SEED = "mix"


def tokens(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def counted(df: DataFrame, key: str, source: str, text: str) -> DataFrame:
    """(id, source, tokens), one row per id."""
    rows = df.select(F.col(key).alias("id"), F.coalesce(F.col(source), F.lit("")).alias("source"), tokens(text).alias("tokens"))
    return rows.groupBy("id").agg(F.min("source").alias("source"), F.sum("tokens").alias("tokens"))


def exponent(entropy: float | None, repeats: float | None) -> str:
    """SQL of the bisected exponent over the row's array `shares` and its ratio `stretch` of budget to all tokens."""
    powered = "transform(shares, p -> power(p, m))"
    total = f"aggregate({powered}, 0D, (a, x) -> a + x)"
    if repeats is not None:
        fits = f"stretch * array_max(transform(shares, p -> power(p, m - 1))) / {total} <= {repeats!r}D"
    else:
        fits = f"aggregate({powered}, 0D, (a, x) -> a - x / {total} * ln(x / {total})) <= {entropy!r}D"
    step = (
        "(s, i) -> aggregate(array((s.low + s.high) / 2), s, (r, m) -> "
        f"IF({fits}, named_struct('low', r.low, 'high', m), named_struct('low', m, 'high', r.high)))"
    )
    return f"aggregate(sequence(1, {STEPS}), named_struct('low', 0D, 'high', 1D), {step}).high"


def weighted(docs: DataFrame, budget: int | None, entropy: float | None, repeats: float | None) -> DataFrame:
    """Per source: tokens, exponent, weight, quota, whole epochs and the tokens left for one more."""
    if (entropy is None) == (repeats is None):
        raise ValueError("give either a target entropy or a limit on repeats")
    sources = docs.groupBy("source").agg(F.sum("tokens").alias("total")).where("total > 0")
    row = (
        sources.agg(F.sort_array(F.collect_list(F.struct("source", "total"))).alias("sources"))
        .selectExpr("sources", "aggregate(sources, 0L, (a, s) -> a + s.total) AS everything")
        .where("everything > 0")
        .selectExpr("*", "transform(sources, s -> s.total / CAST(everything AS DOUBLE)) AS shares",
                    f"{'everything' if budget is None else str(int(budget)) + 'L'} AS budget")
        .selectExpr("*", "budget / CAST(everything AS DOUBLE) AS stretch")
        .withColumn("exponent", F.expr(exponent(entropy, repeats)))
        .selectExpr("*", "aggregate(shares, 0D, (a, p) -> a + power(p, exponent)) AS norm")
    )
    return (
        row.select("exponent", "norm", "budget", "everything", F.explode("sources").alias("s"))
        .selectExpr("s.source", "s.total", "exponent", "power(s.total / CAST(everything AS DOUBLE), exponent) / norm AS weight", "budget")
        .selectExpr("source", "total", "exponent", "weight", "CAST(round(budget * weight) AS LONG) AS quota")
        .selectExpr("*", "quota DIV total AS epochs", "quota % total AS rest")
    )


def draw(
    df: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", budget: int | None = None,
    entropy: float | None = None, repeats: float | None = None, block_tokens: int = BLOCK_TOKENS, seed: str = SEED,
) -> DataFrame:
    """(key, source, n_tokens, epoch, block_rank, place): what is read, and where. The budget is all tokens unless given.

    Reading a source in the order of (epoch, block_rank, place) is its permutation. Blocks are windows of some
    `block_tokens`, so no task sorts a source; running totals of a source run over its blocks only.
    """
    docs = staged(counted(df, key, source, text), "tokens")
    plan = staged(weighted(docs, budget, entropy, repeats), "weights")
    of_block = f"CAST(conv(substr(md5(concat('{seed}|', CAST(id AS STRING))), 1, 8), 16, 10) AS LONG)"
    placed = docs.join(plan.select("source", "total"), "source").selectExpr(
        "id", "source", "tokens", f"{of_block} % (1 + total DIV {int(block_tokens)}) AS block"
    )
    blocks = (
        placed.groupBy("source", "block").agg(F.sum("tokens").alias("block_tokens"))
        .join(plan, "source").where("quota > 0")
        .selectExpr("*", "explode(sequence(0L, IF(rest > 0, epochs, epochs - 1))) AS epoch")
        .selectExpr("*", f"md5(concat_ws('|', '{seed}', source, CAST(epoch AS STRING), CAST(block AS STRING))) AS turn")
        .selectExpr(
            "source", "block", "epoch", "IF(epoch < epochs, NULL, rest) AS rest",
            "row_number() OVER (PARTITION BY source, epoch ORDER BY turn, block) AS block_rank",
            "sum(block_tokens) OVER (PARTITION BY source, epoch ORDER BY turn, block ROWS UNBOUNDED PRECEDING) - block_tokens AS before",
        )
        .where("rest is null or before < rest")
    )
    order = "PARTITION BY source, epoch, block ORDER BY turn, id"
    return (
        placed.join(blocks, ["source", "block"])
        .selectExpr("*", f"md5(concat_ws('|', '{seed}', CAST(epoch AS STRING), CAST(id AS STRING))) AS turn")
        .selectExpr(
            "*", f"row_number() OVER ({order}) AS place",
            f"sum(tokens) OVER ({order} ROWS UNBOUNDED PRECEDING) AS so_far",
        )
        .where("rest is null or before + so_far <= rest")
        .select(F.col("id").alias(key), "source", F.col("tokens").alias("n_tokens"), "epoch",
                F.col("block_rank").cast("long"), F.col("place").cast("long"))
    )


def realise(df: DataFrame, key: str = "doc_id", **how) -> DataFrame:
    """The rows of `df` as often as they are drawn, with all their columns. Texts are shuffled once, by id."""
    drawn = draw(df, key, **how).groupBy(key).agg(F.count(F.lit(1)).alias("_times")).withColumnRenamed(key, "_id")
    return (
        df.join(drawn, F.col(key) == F.col("_id")).withColumn("_time", F.explode(F.expr("sequence(1L, _times)")))
        .drop("_id", "_times", "_time")
    )
