"""Document fingerprints from Lempel-Ziv phrases.

A text's UTF-8 bytes are parsed once from left to right into dictionary phrases (each the longest phrase met so far
and one byte more). The set of phrases, hashed, gives a signature of PERMUTATIONS minima, and two texts are as alike as
their signatures agree: close to the Jaccard likeness of the phrase sets, which is high where one text compresses
well with the other's dictionary. A last phrase cut off by the end of the text counts as a phrase.

Null and empty texts have no phrases; their signatures hold the largest values, so they are alike only among themselves.
Equal texts have equal fingerprints. `neighbours` orders rows by descending id, then text, nulls last; the last row's next is
the first, and a single row is its own next. Repeated rows stay separate. An empty table gives no rows.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railmart.llm.common import Spans, mix, partitions

PERMUTATIONS = 64
TURN = mix(np.arange(1, PERMUTATIONS + 1, dtype=np.uint64)) | np.uint64(1)
SHIFT = mix(np.arange(1001, 1001 + PERMUTATIONS, dtype=np.uint64))
EMPTY = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)
BUCKETS_PER_PARTITION = 4


def parse(data: bytes, known: dict[int, int], node: int, ends: list[int], offset: int) -> int:
    """Go on parsing at `node` of the dictionary; phrase ends go to `ends`. Returns the node that the end leaves open."""
    get, count, add = known.get, len(known), ends.append
    for place, byte in enumerate(data, offset + 1):
        key = node << 8 | byte
        node = get(key)
        if node is None:
            count += 1
            known[key] = count
            add(place)
            node = 0
    return node


def signature(data: bytes, ends: list[int]) -> np.ndarray:
    if not data:
        return EMPTY
    cut = np.array(ends if ends and ends[-1] == len(data) else [*ends, len(data)])
    hashes = Spans(np.frombuffer(data, np.uint8)).hash(np.concatenate([[0], cut[:-1]]), cut)
    least = EMPTY
    for first in range(0, len(hashes), 4096):
        values = (hashes[first:first + 4096, None] * TURN + SHIFT) >> np.uint64(32)
        least = np.minimum(least, values.min(0).astype(np.uint32))
    return least


def written(found: np.ndarray) -> str:
    return found.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


class Parsed:
    """A text parsed up to where its edit begins, and on to its end."""

    def __init__(self, text: str) -> None:
        self.text, self.half = text, len(text) // 2
        self.kept = text[:len(text) - self.half].encode("utf-8", "replace")
        self.known: dict[int, int] = {}
        self.ends: list[int] = []
        self.node = parse(self.kept, self.known, 0, self.ends, 0)
        rest = text[len(text) - self.half:].encode("utf-8", "replace")
        ends = self.ends.copy()
        parse(rest, self.known.copy(), self.node, ends, len(self.kept))
        self.signature = signature(self.kept + rest, ends)

    def edited(self, following: str) -> tuple[bytes, np.ndarray]:
        """The text with its last half replaced by the beginning of the following one, and its signature."""
        rest = following[:self.half].encode("utf-8", "replace")
        parse(rest, self.known, self.node, self.ends, len(self.kept))
        return self.kept + rest, signature(self.kept + rest, self.ends)


def fingerprint(text: str | None) -> str:
    return written(Parsed(text or "").signature)


def likeness_of(a: str, b: str) -> float:
    return likeness(*(np.frombuffer(bytes.fromhex(x), ">u4") for x in (a, b)))


def neighbours(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: length, digest of its edited text, both fingerprints, and its likeness to the edited and the next text.

    Rows are dealt to buckets of neighbouring ids by quantiles of the ids, once; each bucket also gets the row that
    follows its last, so no row waits for another task. Texts cross the network one time.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    n = BUCKETS_PER_PARTITION * partitions(spark)
    cuts = rows.agg(F.percentile_approx("id", [i / n for i in range(1, n)], 100 * n)).first()[0] or []
    cuts = np.unique(np.array(cuts, np.int64))
    bounds = spark.sparkContext.broadcast(cuts)  # one number per bucket

    def bucket_of(ids: pa.Array) -> np.ndarray:
        """Buckets count down with the ids; rows without an id come last."""
        found = len(bounds.value) - np.searchsorted(bounds.value, ids.fill_null(0).to_numpy(zero_copy_only=False), "right")
        return np.where(ids.is_null().to_numpy(zero_copy_only=False), len(bounds.value) + 1, found).astype(np.int32)

    def place(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(bucket_of(batch.column(0))), batch.column(0)], ["bucket", "id"])

    heads = sorted(  # at most one row per bucket
        (r["bucket"], r["id"]) for r in rows.select("id").mapInArrow(place, "bucket int, id long")
        .groupBy("bucket").agg(F.max("id").alias("id")).collect()
    )
    goes_to: dict[tuple, int] = {}
    for i, (bucket, head) in enumerate(heads):
        goes_to[bucket, head] = heads[i - 1][0]
    shared = spark.sparkContext.broadcast(goes_to)

    def deal(batches):
        for batch in batches:
            buckets = bucket_of(batch.column(0))
            plain = [pa.array(buckets), pa.array(np.zeros(len(buckets), np.int32)), batch.column(0), batch.column(1)]
            yield pa.RecordBatch.from_arrays(plain, ["bucket", "tail", "id", "text"])
            extra = [
                (i, shared.value[b, k]) for i, (b, k) in enumerate(zip(buckets.tolist(), batch.column(0).to_pylist()))
                if (b, k) in shared.value
            ]
            if extra:
                at = pa.array([i for i, _ in extra])
                yield pa.RecordBatch.from_arrays([
                    pa.array([b for _, b in extra], pa.int32()), pa.array([1] * len(extra), pa.int32()),
                    batch.column(0).take(at), batch.column(1).take(at),
                ], ["bucket", "tail", "id", "text"])

    def walk(batches):
        pending, bucket, closed = None, None, False
        out: list[tuple] = []
        for batch in batches:
            for b, tail, k, t in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if b != bucket:
                    pending, bucket, closed = None, b, False
                if closed:
                    continue
                now = Parsed(t or "")
                if pending is not None:
                    own, own_key = pending
                    data, found = own.edited(now.text)
                    out.append((
                        own_key, len(own.text), sha256(data).hexdigest(), written(own.signature), written(found),
                        likeness(own.signature, found), likeness(own.signature, now.signature),
                    ))
                pending, closed = (now, k), bool(tail)
                if len(out) >= 500:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), kind)], schema=kind)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), kind)], schema=kind)

    kind = pa.schema([
        (key, pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ])
    dealt = rows.mapInArrow(deal, "bucket int, tail int, id long, text string").repartition(partitions(spark), "bucket")
    return dealt.sortWithinPartitions(
        "bucket", "tail", F.desc_nulls_last("id"), F.asc_nulls_last("text")
    ).mapInArrow(
        walk, f"{key} long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
