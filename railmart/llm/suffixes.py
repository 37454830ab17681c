"""Suffix-array dedup: removes every byte covered by a string of `length` bytes that also starts anywhere else.

1. Runs. Every string of `length` bytes takes its key from its own content, the smallest hash of its grams of `length` // 3
   bytes, so equal strings have equal keys wherever they stand. Neighbouring starts with one key form a run (cut after
   MAX_RUN starts); its region is the text its strings cover. Equal regions of a key collapse to one with its multiplicity.
2. Shards. Only keys with two runs or more can hold a repeat. Their regions are dealt by key to shards of some SHARD_BYTES;
   a key with more than that is dealt over several shards of its own.
3. In a shard, a suffix array is made by Larsson-Sadakane refinement (groups of equal prefixes are sorted by the rank of what
   follows them, doubling the prefix), then the common prefixes of neighbours by Kasai's rule. Starts whose common prefix
   reaches `length` are one class; a class of two occurrences or more repeats.
4. Shards of one key are merged: each sends the sorted digests of its classes, cut into ranges, and a binary search of
   every shard's digests in the others' finds classes that occur in several.
5. Repeated starts go back to all runs with that region, and to the documents.

Strings are compared within documents only, as UTF-8 bytes, on the input and not on what is left. Regions and classes are told
apart by 128 bits of hashes. Null and empty texts, and those shorter than `length`, lose nothing. A row
is known by its id and 64 bits of id and text, so rows of one id lose their own strings only, and rows without id are judged
like any other. An empty table gives no rows. What is left may begin or end within a character, so it is
returned as bytes. Added columns replace namesakes.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railmart.llm.bpe import schema_with, with_columns
from railmart.llm.common import STEP, Spans, drop_staged, free_names, mix, row_key, staged, text_slices

SHARD_BYTES = 1 << 21
MAX_RUN = 4096
PIECE = 1 << 16  # starts worked on at a time, so that numbers of 8 bytes stay in a core's cache
RANGES = 16  # slices of the digests of a key that fills several shards
BROADCAST_ROWS = 300_000


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every `width` neighbours, by doubling."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span:]) if span < width else values


def runs_of(data: np.ndarray, offsets: np.ndarray, length: int):
    """Row, first start, number of starts, key, region digest (two numbers), and whether one string may be there twice, of all runs."""
    gram = max(1, length // 3)
    width = length - gram + 1
    parts = []
    for low in range(0, max(0, len(data) - length + 1), PIECE):
        part = data[low:low + PIECE + length - 1]
        spans = Spans(part)
        # a second digest of a region: codes of byte pairs, weighted 1, 3, 5, ... from the region's start
        code = mix((part.astype(np.uint64) << np.uint64(8) | np.append(part[1:], np.uint8(0))) * STEP)
        plain, weighted = np.zeros((2, len(part) + 1), np.uint64)
        np.cumsum(code, out=plain[1:], dtype=np.uint64)
        np.cumsum(code * (np.arange(len(part), dtype=np.uint64) * np.uint64(2) + np.uint64(1)), out=weighted[1:], dtype=np.uint64)
        at = np.arange(len(part) - gram + 1)
        hashes = spans.hash(at, at + gram)
        least = sliding_least(hashes, width)
        # places of grams that are the smallest of some string: most of all the least that hold them
        around = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
        minima = np.flatnonzero(hashes == ~sliding_least(~around, width))
        start = np.arange(len(least)) + low
        row = np.searchsorted(offsets, start, "right") - 1
        fits = start + length <= offsets[row + 1]
        start, row, key = start[fits], row[fits], least[fits]
        if not len(start):
            continue
        new = np.ones(len(start), bool)
        new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(start)))
        # a run can hold one string twice only if its smallest gram stands in it twice
        low_min = np.searchsorted(minima, start[first] - low)
        n_min = np.searchsorted(minima, start[first] - low + count + width - 1) - low_min
        of_run = np.repeat(np.arange(len(first)), n_min)
        each = np.repeat(low_min - (np.cumsum(n_min) - n_min), n_min) + np.arange(n_min.sum())
        twice = np.bincount(of_run, hashes[minima[each]] == key[first][of_run], len(first)) > 1
        pieces = -(-count // MAX_RUN)
        cut = np.repeat(first, pieces) + (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * MAX_RUN
        n = np.minimum(np.repeat(first + count, pieces) - cut, MAX_RUN)
        a = start[cut] - low
        b = a + n + length - 1
        inner = b - 1  # the last byte's pair lies outside
        other = weighted[inner] - weighted[a] - np.uint64(2) * a.astype(np.uint64) * (plain[inner] - plain[a])
        parts.append((row[cut], start[cut] - offsets[row[cut]], n, key[cut], spans.hash(a, b), mix(other), np.repeat(twice, pieces)))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none, *[none.astype(np.uint64)] * 3, none.astype(bool)
    return tuple(np.concatenate(column) for column in zip(*parts))


def runs_in(docs: DataFrame, length: int) -> DataFrame:
    """(id, row, start, n, key, d, e, twice): the runs of all texts."""
    def run(batches):
        for batch, data, offsets in text_slices(batches):
            row, start, n, key, d, e, twice = runs_of(data, offsets, length)
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(pa.array(row)), batch.column("row").take(pa.array(row)), pa.array(start, pa.int64()), pa.array(n.astype(np.int32)),
                *(pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (key, d, e)), pa.array(twice),
            ], ["id", "row", "start", "n", "key", "d", "e", "twice"])

    return docs.mapInArrow(run, "id long, row long, start long, n int, key long, d long, e long, twice boolean")


def eight(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every place as one number, zeros beyond the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(text) + 1, np.uint64)
    for j in range(8):
        out[:-1] = out[:-1] << np.uint64(8) | padded[j:j + len(text)]
    return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Larsson-Sadakane: groups that share a prefix are sorted by the rank of the place that far behind them.

    A suffix that ends first sorts first. Groups of one are done and leave the work; the others double their prefix.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    # one more than the byte, so that the end sorts before a zero byte: seven of nine bits to a number
    padded = np.concatenate([text.astype(np.uint64) + np.uint64(1), np.zeros(8, np.uint64)])
    key = np.zeros(n, np.uint64)
    for j in range(7):
        key = key << np.uint64(9) | padded[j:j + n]
    sa = np.argsort(key, kind="stable")
    sorted_key = key[sa]
    new = np.ones(n, bool)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    rank = np.zeros(n + 1, np.int64)  # 1 + first place of the group; 0 beyond the end
    group = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[sa] = group + 1
    depth = 7
    open_places = np.flatnonzero(~(new & np.append(new[1:], True)))
    while len(open_places) and depth < n:
        suffix = sa[open_places]
        own = group[open_places]
        behind = rank[np.minimum(suffix + depth, n)]
        pair = own.astype(np.uint64) << np.uint64(32) | behind.astype(np.uint64)
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        sa[open_places] = suffix[order]
        new = np.ones(len(pair), bool)
        new[1:] = pair[1:] != pair[:-1]
        group[open_places] = np.maximum.accumulate(np.where(new, open_places, 0))
        rank[sa[open_places]] = group[open_places] + 1
        alone = new & np.append(new[1:], True)
        open_places = open_places[~alone]
        depth *= 2
    return sa


def common_prefixes(text: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """Length each suffix shares with the one before it in the array.

    Kasai's rule in text order: where the bytes before a suffix and before its neighbour agree, the length is one less than
    that of the suffix before. Only the other places are compared, eight bytes at a time, and the rest follows from them.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    place = np.arange(n)
    irreducible = np.ones(n, bool)
    irreducible[1:] = (before[1:] <= 0) | (text[:-1] != text[before[1:] - 1])
    length = np.zeros(n, np.int64)
    active = place[irreducible & (before >= 0)]
    word = eight(text)
    while len(active):
        a, b = active + length[active], before[active] + length[active]
        x = word[np.minimum(a, n)] ^ word[np.minimum(b, n)]
        room = np.minimum(n - a, n - b)
        # leading zero bytes of the difference; without each bit below a set one the number is not rounded up to the next power
        same = (64 - np.frexp((x & ~(x >> np.uint64(1))).astype(np.float64))[1]) >> 3
        step = np.minimum(same, room)
        length[active] += step
        active = active[step == 8]
    last = np.maximum.accumulate(np.where(irreducible, place, 0))
    length = length[last] - (place - last)
    return length[sa]


def classes(texts: list[bytes], starts: list[int], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (in the joined regions) of all starts in suffix order, their classes of equal strings, and each region's first place."""
    text = np.frombuffer(b"".join(texts), np.uint8)
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    valid = np.zeros(len(text) + 1, np.int8)
    np.add.at(valid, first[:-1], 1)
    np.add.at(valid, first[:-1] + np.array(starts), -1)
    valid = np.cumsum(valid[:-1]) > 0
    sa = suffix_array(text)
    shared = common_prefixes(text, sa)
    at = np.flatnonzero(valid[sa])
    least = np.minimum.reduceat(shared[:at[-1] + 1], np.append(0, at[:-1] + 1)) if len(at) else shared
    new = least < length
    if len(new):
        new[0] = True
    return sa[at], np.cumsum(new) - 1, first


def digests(text: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    spans = Spans(text)
    turned = Spans(text ^ np.uint8(0x5A))
    return np.stack([spans.hash(places, places + length), turned.hash(places, places + length)], 1)


def intervals(places: np.ndarray, first: np.ndarray) -> pd.DataFrame:
    """Runs of neighbouring places as (region, low, high), high beyond the last."""
    places = np.sort(places)
    region = np.searchsorted(first, places, "right") - 1
    new = np.ones(len(places), bool)
    new[1:] = (places[1:] != places[:-1] + 1) | (region[1:] != region[:-1])
    low = np.flatnonzero(new)
    high = np.append(low[1:], len(places)) - 1 if len(low) else low
    base = first[region[low]]
    return pd.DataFrame({"region": region[low], "low": places[low] - base, "high": places[high] - base + 1})


def typed(rows: pd.DataFrame) -> pd.DataFrame:
    """The columns of `repeats`, with whole numbers that may be missing but never turn into floats."""
    rows = rows.reindex(columns=["key", "d", "e", "low", "high", "shard", "slice", "found"])
    return rows.astype({name: "Int64" for name in rows.columns[:-1]})


def repeats(regions: DataFrame, length: int) -> DataFrame:
    """(key, d, e, low, high): starts that repeat, of regions (key, d, e, n, times, shard, split, body)."""
    kind = "key long, d long, e long, low int, high int, shard long, slice int, found binary"

    def one(group: tuple, block: pd.DataFrame) -> pd.DataFrame:
        block = block.reset_index(drop=True)
        places, of, first = classes(block["body"].tolist(), block["n"].tolist(), length)
        region = np.searchsorted(first, places, "right") - 1
        seen = np.bincount(of, block["times"].to_numpy()[region])
        out = intervals(places[seen[of] > 1], first)
        for name in ("key", "d", "e"):
            out[name] = block[name].to_numpy()[out["region"]]
        out["shard"], out["slice"], out["found"] = group[0], -1, None
        split = block["split"].to_numpy()[region] if len(region) else np.zeros(0, bool)
        if split.any():  # a shard of a split key holds that key alone
            lead = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            text = np.frombuffer(b"".join(block["body"]), np.uint8)
            table = np.empty(len(lead), dtype=[("a", "u8"), ("b", "u8"), ("open", "?"), ("region", "u4"), ("start", "u4")])
            table["a"], table["b"] = digests(text, places[lead], length).T
            table["open"] = seen[of[lead]] == 1
            table["region"], table["start"] = region[lead], places[lead] - first[region[lead]]
            table.sort(order=["a", "b"])
            bounds = np.searchsorted(table["a"], (np.arange(RANGES + 1) * (2.0**64 / RANGES)).clip(0, 2.0**64 - 2048).astype(np.uint64))
            bounds[-1] = len(table)
            sent = pd.DataFrame({"slice": range(RANGES), "found": [table[x:y].tobytes() for x, y in zip(bounds, bounds[1:])]})
            sent["shard"], sent["key"] = group[0], block["key"].iloc[0]
            names = pd.DataFrame({"d": block["d"], "e": block["e"], "key": block["key"], "low": range(len(block))})
            names["shard"], names["slice"] = group[0], -2
            return pd.concat([typed(out), typed(sent), typed(names)])
        return typed(out)

    return staged(regions.groupBy("shard").applyInPandas(one, kind), "repeats")


LEAD = np.dtype([("a", "u8"), ("b", "u8"), ("open", "?"), ("region", "u4"), ("start", "u4")])


def merged(found: DataFrame) -> DataFrame:
    """Starts of split keys that repeat in another shard only, as rows like those of `repeats`."""
    def one(group: tuple, block: pd.DataFrame) -> pd.DataFrame:
        tables = [np.frombuffer(f, LEAD) for f in block["found"]]
        out = []
        for shard, own in zip(block["shard"], tables):
            hit = np.zeros(len(own), bool)
            for other in tables:
                if other is own or not len(other):
                    continue
                at = np.searchsorted(other["a"], own["a"])
                inside = at < len(other)
                at[~inside] = 0
                hit |= inside & (other["a"][at] == own["a"]) & (other["b"][at] == own["b"])
            picked = own[hit & own["open"]]
            out.append(pd.DataFrame({"shard": shard, "region": picked["region"].astype(np.int64), "start": picked["start"].astype(np.int64)}))
        return pd.concat(out) if out else pd.DataFrame({"shard": [], "region": [], "start": []})

    hits = found.where("slice >= 0").groupBy("key", "slice").applyInPandas(one, "shard long, region long, start long")
    names = found.where("slice = -2").select("shard", F.col("low").alias("region"), "key", "d", "e")
    return hits.join(names, ["shard", "region"]).selectExpr("key", "d", "e", "CAST(start AS INT) AS low", "CAST(start + 1 AS INT) AS high")


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = 400, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """`df` with kept (bytes), n_bytes, n_removed and n_spans (maximal removed runs)."""
    row = {"id": F.coalesce(F.col(key).cast("long"), F.lit(0)), "row": row_key(key, text)}  # never null
    docs = df.select(*(c.alias(name) for name, c in row.items()), F.col(text).alias("text"))
    found = staged(runs_in(docs, length), "runs")  # read three times below
    distinct = found.groupBy("key", "d", "e", "n").agg(
        F.count(F.lit(1)).alias("times"), F.max("twice").alias("twice"), F.min("row").alias("row"),
        F.min_by("id", "row").alias("id"), F.min_by("start", "row").alias("start"),
    )
    per_key = distinct.groupBy("key").agg(
        F.sum("times").alias("total"), F.max("twice").alias("twice"), F.sum(F.col("n") + F.lit(length - 1)).alias("bytes")
    ).where("total > 1 or twice")
    kept = staged(distinct.drop("twice").join(per_key.select("key", "bytes"), "key"), "regions")
    volume = kept.agg(F.sum(F.col("n") + F.lit(length - 1))).first()[0] or 0
    shards = max(1, math.ceil(volume / shard_bytes))
    # a key beyond a shard's size gets shards of its own: numbers below zero, by key and region
    placed = kept.withColumn("split", F.col("bytes") > shard_bytes).withColumn("shard", F.when(
        F.col("split"),
        -1 - F.abs(F.xxhash64("key", F.pmod(F.col("d"), F.ceil(F.col("bytes") / (shard_bytes // 2)))) / 2).cast("long"),
    ).otherwise(F.pmod(F.xxhash64("key"), F.lit(shards)).cast("long")))
    ids = placed.select("id", "row").distinct()
    if ids.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    wanted = placed.groupBy("id", "row").agg(F.collect_list(F.struct("key", "d", "e", "n", "times", "start", "shard", "split")).alias("wanted"))

    def cut(batches):
        names = ["key", "d", "e", "n", "times", "shard", "split"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
        for batch, data, offsets in text_slices(batches):
            raw, out = data.tobytes(), []
            for base, regions in zip(offsets.tolist(), batch.column("wanted").to_pylist()):
                for r in regions:
                    a = base + r["start"]
                    out.append((*(r[c] for c in names), raw[a:a + r["n"] + length - 1]))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds], [*names, "body"])

    regions = (
        docs.join(ids, ["id", "row"], "left_semi").dropDuplicates(["id", "row"]).join(wanted, ["id", "row"])
        .mapInArrow(cut, "key long, d long, e long, n int, times long, shard long, split boolean, body binary")
    )
    starts = repeats(regions, length)
    again = starts.where("slice = -1").select("key", "d", "e", "low", "high")
    if not starts.where("slice >= 0").isEmpty():
        again = again.unionByName(merged(starts))
    drop_staged(kept)

    spans = staged(
        found.join(again, ["key", "d", "e"]).groupBy("id", "row").agg(  # of one text
            F.collect_set(F.struct((F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high"))).alias("spans")
        ), "spans"
    )
    drop_staged(found)
    rest = df.drop("kept", "n_bytes", "n_removed", "n_spans")
    own_id, own_row, cut_spans = free_names(df, "id", "row", "spans")
    joined = rest.withColumns({own_id: row["id"], own_row: row["row"]}).join(
        spans.toDF(own_id, own_row, cut_spans), [own_id, own_row], "left"
    ).drop(own_id, own_row)

    def remove(batches):
        for batch, data, offsets in text_slices(batches, text):
            left, removed, runs = [], [], []
            for i, found in enumerate(batch.column(cut_spans).to_pylist()):
                own = data[offsets[i]:offsets[i + 1]]
                if found:
                    change = np.zeros(len(own) + 1, np.int64)
                    low = np.array([s["low"] for s in found])
                    high = np.array([s["high"] for s in found])
                    np.add.at(change, np.minimum(low, len(own)), 1)
                    np.add.at(change, np.minimum(high + length - 1, len(own)), -1)
                    gone = np.cumsum(change[:-1]) > 0
                    runs.append(int((gone & ~np.append(False, gone[:-1])).sum()))
                    removed.append(int(gone.sum()))
                    own = own[~gone]
                else:
                    runs.append(0)
                    removed.append(0)
                left.append(own.tobytes())
            yield with_columns(batch.drop_columns([cut_spans]), {
                "kept": pa.array(left, pa.binary()), "n_bytes": pa.array(np.diff(offsets), pa.int64()),
                "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(runs, pa.int64()),
            })

    return joined.mapInArrow(remove, schema_with(joined.drop(cut_spans), [
        T.StructField("kept", T.BinaryType()), *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")),
    ]))
