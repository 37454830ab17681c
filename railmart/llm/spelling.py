"""Spelling variants: words one edit apart, by composing a minimised acceptor with a one-edit transducer and the acceptor again.

Words are counted in Spark. Two words one edit apart share all but one region of their letters, so the vocabulary is dealt by
what is shared: for the shorter length s, the edit falls into the first or the second half of s, and words agree in the rest.
What both words read outside the region leads to one pair of states, from which a task composes: the middle parts of the
partition's words make two minimised acceptors (of the shorter and the longer words), joined through the transducer's
"nothing edited yet" and "edited" states, and all accepted pairs are listed, each once. A partition of more than `limit` words
is dealt anew by half of its region, down to a single place, where a partition holds no more words than there are letters
(squared for the longer ones). So no partition grows with the vocabulary.

Of the near words of a word, the one of largest count (ties: the smallest by code points) is its form if that count is at
least twice the word's. Forms are followed to the last by pointer doubling; counts double with each step, so six rounds
reach the end of any chain.

Null and empty texts hold no words; a null id counts as an empty one. Repeated rows count again. Words may be of any length.
No words: no rows. Extra columns of the documents are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railmart.llm.common import drop_staged, staged
from railmart.llm.exact import LOWER, UPPER

RUN = r"[A-Za-zÀ-ÿ]+"
LEAST_LETTERS, LEAST_COUNT = 5, 3
LIMIT = 4096  # words of a partition
Acceptor = tuple[list[tuple[tuple[str, int], ...]], list[int], int]


def vocabulary(
    docs: DataFrame, key: str = "doc_id", text: str = "text", slips: int | None = None,
    letters: int = LEAST_LETTERS, count: int = LEAST_COUNT,
) -> DataFrame:
    """(word, n): words of at least `letters` code points and `count` occurrences.

    With `slips`, a run whose crc32 of "<id>:<run>" is divisible by it loses the letter at that number modulo its length.
    """
    words = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(text), F.lit(RUN), F.lit(0))).alias("run"),
    ).where(F.char_length("run") >= letters).select("id", F.translate("run", UPPER, LOWER).alias("word"))
    if slips:
        words = words.withColumn("h", F.crc32(F.concat_ws(":", "id", "word").cast("binary"))).selectExpr(
            f"if(h % {slips} = 0, overlay(word placing '' from int(h % char_length(word)) + 1 for 1), word) AS word"
        ).where(F.char_length("word") >= letters)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= count)


def acceptor(words: list[str]) -> Acceptor:
    """Minimised acceptor of sorted distinct words of one length: arcs of every state, words below it, first state."""
    arcs: list[tuple[tuple[str, int], ...]] = [()]
    below = [1]
    known: dict[tuple[tuple[str, int], ...], int] = {(): 0}

    def state(found: list[tuple[str, int]]) -> int:
        key = tuple(found)
        if key not in known:
            known[key] = len(arcs)
            arcs.append(key)
            below.append(sum(below[t] for _, t in key))
        return known[key]

    size = len(words[0])
    path: list[list[tuple[str, int]]] = [[] for _ in range(size + 1)]
    last = words[0]
    for word in [*words[1:], None]:
        shared = -1
        if word is not None:
            shared = next(i for i in range(size) if word[i] != last[i])
        for i in range(size - 1, shared - 1 if word is not None else -1, -1):
            path[i].append((last[i], state(path[i + 1])))
            path[i + 1] = []
        last = word if word is not None else last
    return arcs, below, state(path[0])


def numbered(side: Acceptor, at: int, rank: int) -> Iterator[tuple[str, int, int]]:
    """Letter, next state and number of the first word behind it, for each arc of a state."""
    arcs, below, _ = side
    for letter, then in arcs[at]:
        yield letter, then, rank
        rank += below[then]


def alike(left: Acceptor, right: Acceptor, p: int, q: int, i: int, j: int) -> Iterator[tuple[int, int]]:
    """Numbers of the words that end alike from states p and q on: the transducer's state "edited"."""
    todo = [(p, q, i, j)]
    while todo:
        p, q, i, j = todo.pop()
        if left is right and p == q:
            yield from zip(range(i, i + left[1][p]), range(j, j + left[1][p]))
        elif not left[0][p]:
            yield i, j
        else:
            there = {letter: (then, rank) for letter, then, rank in numbered(right, q, j)}
            todo += [(then, *there[letter][:1], rank, there[letter][1]) for letter, then, rank in numbered(left, p, i) if letter in there]


def replaced(side: Acceptor) -> Iterator[tuple[int, int]]:
    """Pairs of words of one acceptor that differ in one letter, each once."""
    todo = [(side[2], 0)]
    while todo:
        at, rank = todo.pop()
        ways = list(numbered(side, at, rank))
        for k, (_, p, i) in enumerate(ways):
            for _, q, j in ways[k + 1:]:
                yield from alike(side, side, p, q, i, j)
        todo += [(then, first) for _, then, first in ways]


def inserted(left: Acceptor, right: Acceptor, at_end: bool) -> Iterator[tuple[int, int]]:
    """Pairs of a word and one with a letter more. That letter is the first where both differ, so each pair comes once;
    `at_end`: also those where it is the last letter of the right word.
    """
    todo = [(left[2], right[2], 0, 0)]
    while todo:
        p, q, i, j = todo.pop()
        ways = list(numbered(left, p, i))
        for letter, then, rank in numbered(right, q, j):
            if not ways:
                if at_end:
                    yield i, rank
                continue
            there = {x: (t, r) for x, t, r in numbered(right, then, rank)}
            for x, t, r in ways:
                if x == letter:
                    todo.append((t, then, r, rank))
                elif x in there:
                    yield from alike(left, right, t, there[x][0], r, there[x][1])


def pairs(shorter: dict[str, tuple[str, int]], longer: dict[str, tuple[str, int]], at_end: bool) -> Iterator[tuple[tuple, tuple]]:
    """Accepted pairs of one partition; keys are the words' middle parts."""
    if not shorter or len(shorter) + len(longer) < 2:
        return
    first = sorted(shorter)
    left = acceptor(first)
    if len(first) > 1:
        for i, j in replaced(left):
            yield shorter[first[i]], shorter[first[j]]
    if longer:
        second = sorted(longer)
        for i, j in inserted(left, acceptor(second), at_end):
            yield shorter[first[i]], longer[second[j]]


def dealt(rows: DataFrame) -> DataFrame:
    """With what a word of `size` letters reads outside the region `low` to `high` of the shorter length `s`."""
    return rows.withColumn("around", F.expr("concat(substr(word, 1, low), '|', substr(word, high + size - s + 1))"))


def partitioned(words: DataFrame, letters: int, limit: int) -> DataFrame:
    """(s, low, high, around, size, word, n): every word under all regions it can be edited in, none with over `limit` words
    unless its region is a single place."""
    rows = dealt(
        words.withColumn("size", F.char_length("word"))
        .selectExpr("word", "n", "size", "explode(array(size, size - 1)) AS s").where(F.col("s") >= letters)
        .selectExpr("*", "inline(array(struct(0 AS low, s div 2 AS high), struct(s div 2 AS low, s AS high)))")
        .selectExpr("word", "n", "size", "s", "int(low) AS low", "int(high) AS high")
    )
    key = ["s", "low", "high", "around"]
    done = None
    while True:
        large = staged(rows.groupBy(*key).count().where((F.col("count") > limit) & (F.col("high") - F.col("low") > 1)).select(*key), "large", narrow=8)
        if large.isEmpty():
            drop_staged(large)
            return rows if done is None else done.unionByName(rows)
        fits = rows.join(large, key, "left_anti")
        done = fits if done is None else done.unionByName(fits)
        rows = dealt(
            rows.join(large, key, "left_semi")
            .selectExpr("word", "n", "size", "s", "inline(array(struct(low AS low, (low + high) div 2 AS high), struct((low + high) div 2 AS low, high AS high)))")
            .selectExpr("word", "n", "size", "s", "int(low) AS low", "int(high) AS high")
        )


def near(words: DataFrame, letters: int = LEAST_LETTERS, limit: int = LIMIT) -> DataFrame:
    """(word, other, other_n) both ways for all pairs of (word, n) that are one edit apart."""
    key = ["s", "low", "high", "around"]

    def run(batches):
        now, shorter, longer = None, {}, {}
        found: list[tuple[tuple, tuple]] = []

        def table() -> pa.RecordBatch:
            both = [*found, *((b, a) for a, b in found)]
            found.clear()
            return pa.RecordBatch.from_arrays([
                pa.array([a[0] for a, _ in both], pa.string()), pa.array([b[0] for _, b in both], pa.string()),
                pa.array([b[1] for _, b in both], pa.int64()),
            ], ["word", "other", "other_n"])

        for batch in batches:
            for *state, size, word, n in zip(*(batch.column(c).to_pylist() for c in [*key, "size", "word", "n"])):
                if state != now:
                    if now:
                        found.extend(pairs(shorter, longer, now[0] == now[2]))
                    if len(found) > 50_000:
                        yield table()
                    now, shorter, longer = state, {}, {}
                s, low, high, _ = state
                (longer if size > s else shorter)[word[low:high + size - s]] = (word, n)
        if now:
            found.extend(pairs(shorter, longer, now[0] == now[2]))
        yield table()

    rows = partitioned(words, letters, limit)
    return rows.repartition(*key).sortWithinPartitions(*key).select(*key, "size", "word", "n").mapInArrow(
        run, "word string, other string, other_n long"
    )


def grouped(words: DataFrame, letters: int = LEAST_LETTERS, limit: int = LIMIT) -> DataFrame:
    """`words` (word, n; distinct) with n_near, form, form_n and root."""
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    met = near(words, letters, limit).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    known = staged(words.join(met, "word", "left").selectExpr(
        "word", "n", "coalesce(n_near, 0L) AS n_near", "if(-best.less >= 2 * n, best.form, NULL) AS form",
        "if(-best.less >= 2 * n, -best.less, NULL) AS form_n",
    ), "forms", narrow=8)
    steps = known.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        then = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = staged(steps.join(then, "root", "left").selectExpr(
            "word", "coalesce(next, root) AS root", "next IS NOT NULL AS moved"
        ), "roots", narrow=8)
        steps = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return known.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))
