"""Benchmark decontamination by one Aho-Corasick automaton over normalised test questions and answers.

Words are runs of digits, letters and characters beyond ASCII, A-Z lower-cased. Every run of `width` words of an item is a
window; an item of fewer words, but not none, is one window. All windows go into one automaton, each with a blank on both
sides. Texts are normalised to words with one blank between, scanned once, and what is found is led back to the words it
covers and their places in the text as it was. A word of more than LONG bytes stands as its digest in both.

The automaton holds up to `shard_bytes` of windows (the bound of what is collected and broadcast). Windows of a larger
benchmark are dealt to several such automata, and the texts pass them one after another, written in between.

Null and empty texts hold no words and are not hit; null and empty items have no windows. An item whose id is null hits words
but is not listed. Items of one id, and repeated items, count as one. Repeated rows and ids stay rows of their own. No items:
nothing is hit. An empty table gives no rows. Columns of `docs` are left alone; the columns added replace namesakes.
"""

from __future__ import annotations

import uuid
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railmart.llm.bpe import schema_with, with_columns
from railmart.llm.common import LOWER, drop_staged, runs, staged, text_slices
from railmart.llm.exact import normalised

WIDTH = 10
LONG = 64  # bytes; longer words stand as their digest
SHARD_BYTES = 8 << 20  # bytes of windows in one automaton; some 50 bytes of memory each
MARK = "\x01"  # starts a digest; never part of a word
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BREAK = np.ones(256, bool)
BREAK[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def words_of(text: str) -> Column:
    """The words of a text column, long ones as digests."""
    found = F.regexp_extract_all(normalised(text), F.lit(WORD), F.lit(0))
    return F.transform(found, lambda w: F.when(F.octet_length(w) > LONG, F.concat(F.lit(MARK), F.md5(w.cast("binary")))).otherwise(w))


def windows(items: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(item, window, n): the distinct windows of each item and their numbers of words."""
    words = items.select(F.col(key).cast("string").alias("item"), words_of(text).alias("words")).where("size(words) > 0")
    return words.selectExpr(
        "item", f"explode(sequence(1, greatest(size(words) - {width - 1}, 1))) AS place", "words"
    ).selectExpr(
        "item", f"array_join(slice(words, place, {width}), ' ') AS window", f"least(size(words), {width}) AS n"
    ).distinct()


class Normalised:
    """Texts of a slice as one string of words with a blank on both sides, a line break before each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        low = LOWER[data]
        inside = ~BREAK[low]
        self.starts, self.ends, self.rows = runs(inside, offsets)
        size = self.ends - self.starts
        shown = np.where(size > LONG, 1 + 32, size)
        texts = len(offsets) - 1
        self.counts = np.bincount(self.rows, minlength=texts)
        # a word follows the blanks of all words so far and break and last blank of all texts before
        self.at = np.cumsum(shown + 1) - shown + 2 * self.rows + 1
        out = np.full(int(shown.sum()) + len(size) + 2 * texts, 0x20, np.uint8)
        row_size = np.bincount(self.rows, shown + 1, minlength=texts).astype(np.int64) + 2
        out[np.cumsum(row_size) - row_size] = 0x0A
        short = size <= LONG
        kept = size[short]
        source = np.repeat(self.starts[short] - np.cumsum(kept) + kept, kept) + np.arange(int(kept.sum()))
        out[source + np.repeat(self.at[short] - self.starts[short], kept)] = low[source]
        for k in np.flatnonzero(~short).tolist():
            digest = MARK + md5(low[self.starts[k]:self.ends[k]].tobytes()).hexdigest()
            out[self.at[k]:self.at[k] + 33] = np.frombuffer(digest.encode(), np.uint8)
        self.string = out.tobytes().decode("latin-1")


class Windows:
    """The automaton of a set of windows, and the items each stands for."""

    def __init__(self, table: pa.Table) -> None:
        import ahocorasick

        coded = table.column("window").combine_chunks().dictionary_encode()
        self.names = sorted({i for i in table.column("item").to_pylist() if i is not None})
        numbers = {name: k for k, name in enumerate(self.names)}
        items = np.array([numbers.get(i, -1) for i in table.column("item").to_pylist()], np.int64)
        windows = coded.indices.to_numpy()
        self.sizes = np.zeros(len(coded.dictionary), np.int64)
        self.sizes[windows] = table.column("n").to_numpy()
        windows, items = windows[items >= 0], items[items >= 0]
        by = np.argsort(windows, kind="stable")
        self.items, self.first = items[by], np.searchsorted(windows[by], np.arange(len(self.sizes) + 1))
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, window in enumerate(coded.dictionary.to_pylist()):
            self.automaton.add_word(f" {window} ".encode().decode("latin-1"), k)
        self.automaton.make_automaton()

    def find(self, texts: Normalised) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and last word and window of every occurrence."""
        if not len(self.sizes):
            return (np.zeros(0, np.int64),) * 3
        met = np.fromiter((x for pair in self.automaton.iter(texts.string) for x in pair), np.int64).reshape(-1, 2)
        last = np.searchsorted(texts.at, met[:, 0], "left") - 1
        return last - self.sizes[met[:, 1]] + 1, last, met[:, 1]

    def items_of(self, rows: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, item) of the occurrences, in order."""
        rows, windows = np.unique(np.stack([rows, windows], 1), axis=0).T
        many = self.first[windows + 1] - self.first[windows]
        place = np.repeat(self.first[windows] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
        rows, items = np.unique(np.stack([np.repeat(rows, many), self.items[place]], 1), axis=0).T
        return rows, items


_loaded: dict[str, Windows] = {}


def loaded(name: str, shared) -> Windows:
    """The automaton of a broadcast table, built once per Python worker."""
    if name not in _loaded:
        _loaded.clear()
        with pa.ipc.open_stream(shared.value) as reader:
            _loaded[name] = Windows(reader.read_all())
    return _loaded[name]


def lists(rows: np.ndarray, texts: int, values: pa.Array) -> pa.Array:
    """`values` dealt to one list per text; their rows ascend."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(texts + 1)), pa.int32()), values)


def scanned(docs: DataFrame, text: str, shared, before: bool) -> DataFrame:
    """`docs` with what one automaton finds; `before`: n_hit and spans go on from those that are there."""
    name = uuid.uuid4().hex

    def run(batches):
        found = loaded(name, shared)
        for batch, data, offsets in text_slices(batches, text):
            texts, count = Normalised(data, offsets), len(offsets) - 1
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
            begin, starts, ends = points[offsets[:-1]], points[texts.starts], points[texts.ends]
            first, last, window = found.find(texts)
            item_rows, items = found.items_of(texts.rows[first], window)
            if before:
                spans = batch.column("spans")
                rows, flat = np.repeat(np.arange(count), np.diff(spans.offsets.to_numpy())), spans.flatten()
                first = np.append(first, np.searchsorted(starts, flat.field("start").to_numpy() + begin[rows]))
                last = np.append(last, np.searchsorted(ends, flat.field("end").to_numpy() + begin[rows]))
            change = np.bincount(first, minlength=len(starts) + 1) - np.bincount(last + 1, minlength=len(starts) + 1)
            hit = np.cumsum(change)[:-1] > 0
            a, b, _ = runs(hit, np.searchsorted(texts.rows, np.arange(count + 1)))
            rows = texts.rows[a]
            yield with_columns(batch, {
                "n_words": pa.array(texts.counts, pa.int64()),
                "n_hit": pa.array(np.bincount(texts.rows[hit], minlength=count), pa.int64()),
                "spans": lists(rows, count, pa.StructArray.from_arrays(
                    [pa.array(starts[a] - begin[rows], pa.int32()), pa.array(ends[b - 1] - begin[rows], pa.int32())], ["start", "end"]
                )),
                "items": lists(item_rows, count, pa.array(found.names, pa.string()).take(pa.array(items, pa.int64()))),
            })

    pair = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    return docs.mapInArrow(run, schema_with(docs, [
        T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("spans", T.ArrayType(pair)), T.StructField("items", T.ArrayType(T.StringType())),
    ]))


def mark(
    docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
    width: int = WIDTH, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """`docs` with n_words, n_hit (words inside any window), spans (start and end of each run of hit words, in code points of
    the text as it is) and items (ids, as strings in order, of the items with windows in the text).
    """
    spark = docs.sparkSession
    found = staged(windows(items, item_key, item_text, width), "windows", narrow=8)
    size = found.selectExpr("coalesce(sum(octet_length(window) + coalesce(octet_length(item), 0) + 8), 0)").first()[0]
    shards = int(-(-size // shard_bytes)) or 1
    for shard in range(shards):
        part = found.where(F.pmod(F.xxhash64("window", "item"), F.lit(shards)) == shard).toArrow()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, part.schema) as writer:
            writer.write_table(part)
        shared = spark.sparkContext.broadcast(sink.getvalue().to_pybytes())
        if not shard:
            docs = scanned(docs, text, shared, before=False)
        else:
            last = staged(docs, "scanned")
            earlier = next(n for n in (f"items_{k}" for k in range(len(last.columns) + 1)) if n not in last.columns)
            docs = scanned(last.withColumnRenamed("items", earlier), text, shared, before=True).withColumn(
                "items", F.array_sort(F.array_union("items", earlier))
            ).drop(earlier)
    drop_staged(found)
    return docs
