"""Helpers shared by the text operators: texts as byte arrays, hashes of spans, staged tables, components.

Texts are read from Arrow batches as one array of UTF-8 bytes with row offsets, and worked on in slices of
about a megabyte, so memory follows the slice (or the longest text), not the batch.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railmart.session import staging_folder

SLICE_BYTES = 1 << 20

# Odd 64-bit multipliers of the splitmix64 finaliser and of the span hash.
MIX_A, MIX_B, STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: spreads every input bit over all 64."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * STEP)
_inverse = pow(int(STEP), -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP to the powers 0..n and their inverses, modulo 2^64; only those of usual slices are kept."""
    if len(_powers[0]) <= n:
        size = max(n + 1, SLICE_BYTES + 4096)
        made = []
        for base in (int(STEP), _inverse):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            made.append(np.cumprod(x, dtype=np.uint64))
        if size > 2 * SLICE_BYTES:
            return made[0], made[1]
        _powers[:] = made
    return _powers[0], _powers[1]


class Spans:
    """Hashes of any spans of one byte array, by prefix sums of a polynomial over byte codes."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = powers(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_CODE[data] * up[: len(data)], out=self.sums[1:], dtype=np.uint64)

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows and the rows' offsets; a null row is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most `limit` bytes together, or one row."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, min(last, rows)
        first = min(last, rows)


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES):
    """(rows of the batch, bytes, offsets) for every slice of every batch."""
    for batch in batches:
        data, offsets = bytes_of(batch.column(column))
        for first, last in row_slices(offsets, limit):
            yield batch.slice(first, last - first), data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of maximal runs of `inside` that do not cross a row."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def staged(df: DataFrame, name: str = "part", narrow: int = 1) -> DataFrame:
    """`df` written to the application's folder in the shared one and read again: cuts lineage, and a lost executor costs a
    read. What is not dropped before goes with `session.clear_staged`.

    `narrow`: how many times fewer files than partitions, for tables of a few numbers where others carry texts.
    """
    if narrow > 1:
        df = df.coalesce(max(1, partitions(df.sparkSession) // narrow))
    path = f"{staging_folder(df.sparkSession)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def drop_staged(df: DataFrame) -> None:
    """Delete a staged table that no later step reads."""
    jvm, path = df.sparkSession._jvm, df._staged_path
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(jpath, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key(key: str, text: str) -> Column:
    """64 bits of id and text, never null; the place of nulls is hashed too."""
    return F.xxhash64(F.col(key).isNull(), F.col(key).cast("long"), F.col(text).isNull(), F.col(text))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, led by underscores until `df` has no column of that name in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the undirected `edges` (a, b); a component is its smallest node.

    Alternates the large-star and small-star steps, each an aggregate and a join, until the edges stay the
    same; then every edge leads straight to the smallest node. Each round is staged. No edges: no rows.
    """
    def seal(df: DataFrame) -> tuple[DataFrame, tuple]:
        kept = staged(df, "edges", narrow=8)
        found = kept.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        return kept, tuple(found)

    now, state = seal(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = staged(large, "edges", narrow=8)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        then, found = seal(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        drop_staged(large)
        drop_staged(now)
        now, done, state = then, found == state, found
        if done:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def give_back() -> None:
    """Return to the system what this process has freed; else the driver keeps the memory of a training to its end.

    Where the C library has no such call, only Arrow's memory goes.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError, TypeError):
        ctypes.CDLL(None).malloc_trim(0)


def add_blobs(blobs: DataFrame) -> DataFrame:
    """(block int, blob binary): float64 arrays of one length per block, summed per block.

    First in any order over all partitions, then by block, so the last round adds as many arrays as there are partitions.
    """
    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                values = np.frombuffer(blob)
                sums[block] = sums[block] + values if block in sums else values
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], ["block", "blob"]
        )

    kind = "block int, blob binary"
    return blobs.repartition(partitions(blobs.sparkSession)).mapInArrow(add, kind).repartition("block").mapInArrow(add, kind)
