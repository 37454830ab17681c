"""Jaccard self-join on word shingles by T-occurrence search (DivideSkip), and the groups it links.

A document's set holds its distinct shingles of `size` words (words: runs without ASCII white space, A-Z lower-cased); a
shorter document has its whole word sequence as the one element. Sets link when 100 * |A & B| >= percent * |A | B|.
Empty, null and blank texts have an empty set, link with nothing and are their own component. Rows of one id are linked,
whatever their texts, and n_shingles is that of the largest set. Rows with a null id are linked by their texts only; their
component is the smallest id they reach, null if they reach none. Rows are told apart by 64 bits of id and text. An empty table gives no rows. Extra columns are left alone; added ones replace namesakes.

How every link is found without pairing whole groups:

* Copies (equal sets) collapse to one row; everything below runs on these representatives.
* Shingles get one order for all documents: how far a table of counters over all shingles stands above what chance puts there
  (its size is fixed, so it may be sent to all tasks), then their hash. Only the order depends on the counters, never the result.
* Linked sets share one of their first |A| - ceil(t |A|) + 1 shingles in that order, so only these short lists are
  shuffled. Common passages come last in it and fall out.
* First each document is searched against one lead of its lists, then, in lists that still hold several components, each
  member against all leads. A list is led by the member that is in most lists: in a group of near copies the text they come from,
  which most of them link with, so the group is one component after N searches.
* Members of different components are then paired only in the shortest of the lists they are in, as many as any link must
  show in, and searched if they share as many of their first shingles as a link needs, so no link is missed.
* A search takes one document as query and merges the short inverted lists of its candidates by heap, then probes the
  long lists by binary search (DivideSkip), and keeps those that reach the overlap their sizes ask for.

Shingles are 64-bit hashes; two different shingles of a pair are taken for one with a chance of about 1e-13 per pair.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railmart.llm.common import BLANK, LOWER, STEP, Spans, components, drop_staged, mix, partitions, row_key, runs, staged, text_slices

COUNTERS = 1 << 22  # size of the table of shingle counters
COUNTER_BLOCK = 1 << 14
BLOCK_SHINGLES = 200_000  # shingles of the candidates one search holds
BROADCAST_ROWS = 300_000  # of three numbers each
PROBE_WEIGHT = 0.05  # DivideSkip's mu


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, sorted by row and hash, and the rows' offsets into them."""
    data = LOWER[data]
    starts, ends, row = runs(~BLANK[data], offsets)
    words = Spans(data).hash(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    rows = len(offsets) - 1
    first = np.searchsorted(row, np.arange(rows + 1))
    per_row = np.diff(first)
    total = np.zeros(len(words), np.uint64)
    for j in range(min(size, len(words))):  # a shingle that would cross into the next row is not used
        total[: len(words) - j] += mix(words[j:] + np.uint64((j + 1) * int(STEP) % (1 << 64)))
    full = np.arange(len(words)) + size <= first[1:][row] if len(words) else np.zeros(0, bool)
    out, out_row = mix(total[full]), row[full]
    for r in np.flatnonzero((per_row > 0) & (per_row < size)):
        part = words[first[r]:first[r + 1]]
        key = mix(part + np.arange(1, len(part) + 1, dtype=np.uint64) * STEP).sum(dtype=np.uint64)
        out = np.append(out, mix(np.array([key + np.uint64(len(part))], np.uint64)))
        out_row = np.append(out_row, r)
    order = np.lexsort((out, out_row))
    out, out_row = out[order], out_row[order]
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != out[:-1]) | (out_row[1:] != out_row[:-1])
    out, out_row = out[keep], out_row[keep]
    return out, np.searchsorted(out_row, np.arange(rows + 1))


def profile(docs: DataFrame, size: int) -> DataFrame:
    """Per document its set's size and digest; per task also blocks of the counters over its shingles."""

    def run(batches):
        counters = np.zeros(COUNTERS, np.uint32)
        for batch, data, offsets in text_slices(batches):
            found, at = shingles(data, offsets, size)
            np.add.at(counters, (found % np.uint64(COUNTERS)).astype(np.int64), 1)
            digests = []
            for i in range(len(at) - 1):
                own = found[at[i]:at[i + 1]]
                a = int(mix(own).sum(dtype=np.uint64))
                b = int(mix(own * STEP + STEP).sum(dtype=np.uint64))
                digests.append(a.to_bytes(8, "big") + b.to_bytes(8, "big"))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(np.diff(at), pa.int64()), pa.array(digests, pa.binary()),
                pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
            ], ["id", "n", "digest", "block", "counters"])
        blocks = range(0, COUNTERS, COUNTER_BLOCK)
        used = [b // COUNTER_BLOCK for b in blocks if counters[b:b + COUNTER_BLOCK].any()]
        counters = np.minimum(counters, 255).astype(np.uint8)  # of one task
        yield pa.RecordBatch.from_arrays([
            pa.nulls(len(used), pa.int64()), pa.nulls(len(used), pa.int64()), pa.nulls(len(used), pa.binary()),
            pa.array(used, pa.int32()),
            pa.array([counters[b * COUNTER_BLOCK:(b + 1) * COUNTER_BLOCK].tobytes() for b in used], pa.binary()),
        ], ["id", "n", "digest", "block", "counters"])

    return staged(docs.mapInArrow(run, "id long, n long, digest binary, block int, counters binary"), "sets")


def rarity(counters: np.ndarray) -> np.ndarray:
    """Levels of one block of counters: 0 up to what chance adds to its median, then one more for every doubling."""
    usual = float(np.median(counters))
    return np.ceil(np.log2(np.maximum((counters - usual) / (6 * math.sqrt(usual) + 8), 1.0))).astype(np.uint8)


def levels(profiled: DataFrame):
    """Rarity levels of the counters, as a broadcast of COUNTERS bytes; each block is added up in one task."""

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, blob in zip(batch.column("block").to_pylist(), batch.column("counters").to_pylist()):
                sums.setdefault(block, np.zeros(COUNTER_BLOCK, np.int64))
                sums[block] += np.frombuffer(blob, np.uint8)
        yield pa.RecordBatch.from_arrays([
            pa.array(list(sums), pa.int32()), pa.array([rarity(v).tobytes() for v in sums.values()], pa.binary()),
        ], ["block", "counters"])

    blobs = profiled.where("block is not null").select("block", "counters")
    level = np.zeros(COUNTERS, np.uint8)
    for block, blob in blobs.repartition("block").mapInArrow(add, blobs.schema).collect():  # at most COUNTERS / COUNTER_BLOCK rows
        level[block * COUNTER_BLOCK:(block + 1) * COUNTER_BLOCK] = np.frombuffer(blob, np.uint8)
    return blobs.sparkSession.sparkContext.broadcast(level)


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """How many shingles of a set of `n` leave too few for any link when none of them is shared."""
    return n - (n * percent + 99) // 100 + 1


def needed(n: int, m: int, percent: int) -> int:
    """Least overlap of linked sets of n and m shingles."""
    return -(-percent * (n + m) // (100 + percent))


def prefixes(docs: DataFrame, size: int, percent: int, level) -> DataFrame:
    """(token, id, n, place): the first shingles of each set in the common order."""

    def run(batches):
        rarity = level.value
        for batch, data, offsets in text_slices(batches):
            found, at = shingles(data, offsets, size)
            n = np.diff(at)
            row = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((found, rarity[(found % np.uint64(COUNTERS)).astype(np.int64)], row))
            place = np.arange(len(found)) - at[:-1][row]
            keep = place < prefix_length(n, percent)[row]
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([
                pa.array(found[order][keep].view(np.int64)), pa.array(ids[row[keep]], pa.int64()),
                pa.array(n[row[keep]].astype(np.int32)), pa.array(place[keep].astype(np.int32)),
            ], ["token", "id", "n", "place"])

    return docs.mapInArrow(run, "token long, id long, n int, place int")


def t_occurrence(query: np.ndarray, sets: list[np.ndarray], percent: int) -> list[int]:
    """Places in `sets` of those that link with `query`; all are sorted arrays of distinct hashes."""
    wanted = [needed(len(query), len(s), percent) for s in sets]
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    hit = np.searchsorted(query, flat)
    hit[hit == len(query)] = 0
    used = query[hit] == flat
    flat, owner = hit[used], owner[used]
    order = np.lexsort((owner, flat))
    flat, owner = flat[order], owner[order].tolist()
    at = np.searchsorted(flat, np.arange(len(query) + 1)).tolist()
    lists = sorted((owner[a:b] for a, b in zip(at, at[1:]) if b > a), key=len)
    if not lists:
        return []
    least = min(wanted)
    n_long = min(int(least / (PROBE_WEIGHT * math.log2(max(2, len(lists[-1]))) + 1)), least - 1, len(lists))
    short, long = lists[:len(lists) - n_long], lists[len(lists) - n_long:]
    found, last, count = [], -1, 0
    for candidate in [*heapq.merge(*short), -1]:
        if candidate == last:
            count += 1
            continue
        if last >= 0 and count + len(long) >= wanted[last]:
            missing = len(long)
            for entries in long:
                i = bisect_left(entries, last)
                count += i < len(entries) and entries[i] == last
                missing -= 1
                if count >= wanted[last] or count + missing < wanted[last]:
                    break
            if count >= wanted[last]:
                found.append(last)
        last, count = candidate, 1
    return found


def search(pairs: DataFrame, sizes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the `pairs` (a, b) that link. a is the query; its candidates are cut into blocks by their shingles."""
    spark = pairs.sparkSession
    load = pairs.join(sizes.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.sum("n").alias("load"))
    blocks = pairs.join(load, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("load") / BLOCK_SHINGLES)).alias("block")
    )
    members = staged(blocks.select("a", "block", F.explode(F.array("a", "b")).alias("id")).distinct(), "search")
    # both sides of a checked size, else joined by shuffles
    small = F.broadcast if members.count() <= BROADCAST_ROWS else lambda side: side
    ids = small(members.select("id").distinct())

    def sets(batches):
        for batch, data, offsets in text_slices(batches):
            found, at = shingles(data, offsets, size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([found[x:y].tobytes() for x, y in zip(at, at[1:])], pa.binary())], ["id", "hashes"]
            )

    def one(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        own = block["id"] == key[0]
        query = np.frombuffer(block["hashes"][own].iloc[0], np.uint64)
        others = block[~own]
        found = t_occurrence(query, [np.frombuffer(h, np.uint64) for h in others["hashes"]], percent) if len(others) else []
        return pd.DataFrame({"a": key[0], "b": others["id"].iloc[found]}, columns=["a", "b"])

    hashed = docs.join(ids, "id", "left_semi").mapInArrow(sets, "id long, hashes binary")
    out = staged(
        hashed.join(small(members), "id").groupBy("a", "block").applyInPandas(one, "a long, b long"), "links"
    )
    drop_staged(members)
    return out


def headed(lists: DataFrame) -> DataFrame:
    """`lists` with live, how many of them a member is in, before, how many of these come first in its set, and the lead of
    each list: the member that is in most.

    Near copies of one text share more with that text than with each other, so it leads their lists.
    """
    return lists.selectExpr(
        "*", "cast(count(1) OVER (PARTITION BY id) AS int) AS live", "row_number() OVER (PARTITION BY id ORDER BY place) - 1 AS before"
    ).withColumn(
        "lead", F.expr("first_value(struct(id, n, place, component, live, before)) OVER (PARTITION BY token ORDER BY live DESC, id)")
    )


def reaches(a: str, b: str, percent: int) -> str:
    """SQL: may these members of a list link? False for no list of a linked pair.

    They share at most what both have before this shingle, and from it on what either has left, or the lists both are
    still in and what lies beyond the first part that ends earlier.
    """
    beyond = f"ceil(greatest({a}.n, {b}.n) * {percent} / 100) - 1"
    return (
        f"100 * least({a}.n, {b}.n) >= {percent} * greatest({a}.n, {b}.n) AND {100 + percent} * (least({a}.before, {b}.before) "
        f"+ least({a}.n - {a}.place, {b}.n - {b}.place, {a}.live - {a}.before + {beyond}, {b}.live - {b}.before + {beyond})) "
        f">= {percent} * ({a}.n + {b}.n)"
    )


def rarest(lists: DataFrame, percent: int) -> DataFrame:
    """Per member of open lists (id, n, component, tokens, probes): all of its lists, and those that any link must show in.

    Sets that link share at least `shared` lists, which is least for the smallest or the largest size met. Of two members that
    share c lists or more, the first live - c + 1 of both, in the order of the lists' lengths, have one in common.
    """
    window = "OVER (PARTITION BY token)"
    held = lists.selectExpr("*", f"min(n) {window} AS least", f"max(n) {window} AS most", f"count(1) {window} AS members")
    per_id = held.groupBy("id", "n", "component").agg(
        F.min("least").alias("least"), F.max("most").alias("most"),
        F.sort_array(F.collect_list(F.struct("members", "token", "place", "live", "before"))).alias("probes"),  # of one document
    )
    def shared(m: str) -> str:
        return f"greatest(0L, {percent}L * (100 * (n + {m}) - {100 + percent} * greatest(n, {m}))) div {100 * (100 + percent)} + 1"

    smaller, larger = f"greatest(least, cast(ceil(n * {percent} / 100) AS int))", f"least(most, cast(floor(n * 100 / {percent}) AS int))"
    return per_id.selectExpr("id", "n", "component", "probes.token AS tokens", f"size(probes) - least({shared(smaller)}, {shared(larger)}) + 1 AS first", "probes").where(
        "first > 0"
    ).withColumn("probes", F.expr("slice(probes, 1, cast(first AS int))")).drop("first")


def led(lists: DataFrame, percent: int) -> DataFrame:
    """(a, b, live): the lead of a list, a member of another component that may link with it, and live of the lead."""
    own = lists.withColumn("own", F.expr("struct(n, place, live, before)")).where("lead.component <> component")
    return own.where(reaches("lead", "own", percent)).select(
        F.col("lead.id").alias("a"), F.col("id").alias("b"), F.col("lead.live").alias("live")
    )


def still_open(lists: DataFrame, links: DataFrame) -> DataFrame:
    """(token, id, n, place, component) of the lists that hold several components. Drops `lists`."""
    known = staged(components(links), "components")
    placed = lists.select("token", "id", "n", "place").join(known, F.col("id") == F.col("node"), "left").withColumn(
        "component", F.coalesce("component", "id")
    ).drop("node")
    several = placed.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    out = staged(placed.join(several.select("token"), "token"), "lists")
    drop_staged(lists)
    return out


def link(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """`df` with n_shingles and component_id, the smallest id reachable by links."""
    docs = df.select(row_key(key, text).alias("id"), F.col(text).alias("text"))
    profiled = profile(docs, size)
    sets = profiled.where("block is null").select("id", "n", "digest")
    # the smallest row key stands for all copies of a set
    copies = staged(sets.where("n > 0").groupBy("n", "digest").agg(F.min("id").alias("rep")), "copies")
    of = staged(
        sets.join(copies, ["n", "digest"], "left").select("id", "n", F.coalesce("rep", "id").alias("rep")), "members"
    )
    drop_staged(copies)
    level = levels(profiled)
    sizes = of.where("id = rep").select("id", "n").distinct()
    others = of.where("id <> rep").select("id").distinct()
    if others.count() <= BROADCAST_ROWS:
        others = F.broadcast(others)
    reps = docs.join(others, "id", "left_anti")

    window = "PARTITION BY token ORDER BY id"
    lists = staged(
        prefixes(reps, size, percent, level)
        .selectExpr("token", "id", "n", "place", f"lag(id) OVER ({window}) AS before", f"lead(id) OVER ({window}) AS after")
        .where("before is not null or after is not null")  # a list of one member holds no link
        .selectExpr("token", "id", "n", "place", "id AS component"), "lists"
    )
    drop_staged(profiled)
    # each document against the one of its leads that is in most lists: one pair each
    first = staged(
        led(headed(lists), percent).groupBy("b").agg(F.max_by("a", F.struct("live", "a")).alias("a")).select("a", "b"), "pairs"
    )
    links = search(first, sizes, docs, size, percent)
    lists = still_open(lists, links)
    # against all leads of the lists that still hold several components
    again = staged(led(headed(lists), percent).select("a", "b").distinct().join(first, ["a", "b"], "left_anti"), "pairs")
    links = links.unionByName(search(again, sizes, docs, size, percent))
    first = first.unionByName(again)
    members = staged(rarest(headed(still_open(lists, links)).drop("lead"), percent), "members")
    probes = members.select("id", "n", "component", F.explode("probes").alias("probe")).select("id", "n", "component", "probe.*")
    met = (
        probes.alias("p").join(
            probes.alias("q"), F.expr(f"p.token = q.token AND p.component < q.component AND {reaches('p', 'q', percent)}"),
        )
        .selectExpr("least(p.id, q.id) AS a", "greatest(p.id, q.id) AS b").distinct()
    )
    own = members.select("id", "n", "tokens")
    second = (
        met.join(own.toDF("a", "n", "x"), "a").join(own.toDF("b", "m", "y"), "b")
        .where(f"{100 + percent} * (size(array_intersect(x, y)) + ceil(greatest(n, m) * {percent} / 100) - 1) >= {percent} * (n + m)")
        .select("a", "b").join(first, ["a", "b"], "left_anti")
    )
    second = staged(second, "pairs")
    links = links.unionByName(search(second, sizes, docs, size, percent))

    named = df.select(row_key(key, text).alias("id"), F.col(key).cast("long").alias("doc")).distinct()
    of = staged(of.distinct().join(named, "id"), "named")
    # rows of one id
    several = of.where("doc is not null").groupBy("doc").agg(F.min("rep").alias("a"), F.max("rep").alias("b"), F.max("n").alias("most")).where("a < b")
    several = staged(several, "several")
    same = of.join(several, "doc").where("a < rep").select("a", F.col("rep").alias("b"))
    grouped = components(links.unionByName(same))

    found = of.join(grouped, F.col("rep") == F.col("node"), "left").join(several.select("doc", "most"), "doc", "left").select(
        "id", "doc", F.coalesce("most", "n").alias("n_shingles"), F.coalesce("component", "rep").alias("group")
    )
    found = staged(found, "grouped")
    least = found.groupBy("group").agg(F.min("doc").alias("component_id"))
    found = found.join(least, "group").select(F.col("id").alias("_id"), "n_shingles", "component_id")
    rest = df.drop("n_shingles", "component_id")
    return rest.withColumn("_row", row_key(key, text)).join(found, F.col("_row") == F.col("_id")).drop("_id", "_row")
