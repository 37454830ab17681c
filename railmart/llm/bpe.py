"""Byte-level BPE: encoding by a contiguous array of ranks per word, and decoding.

A word's parts are ids in one list, the merge ranks of neighbouring parts in another. The smallest rank is
found by scanning, its boundary deleted, and the two neighbouring ranks looked up again. Scanning is quadratic in the
word's length, so words over LONG bytes take their minima from a heap instead; the merges are the same.

Null text counts as empty; an empty text has no ids and decodes to an empty text. Ids that are null decode to an
empty text. Rows are never dropped, joined or reordered within a batch; output columns replace columns of the same name.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Fixed values of the byte-level format: the split pattern, and the bytes that stand for themselves.
PATTERN = (
    r" ?+\p{L}++| ?+\p{N}++|'(?:[stmd]|re|ve|ll)| ?+[^\p{White_Space}\p{L}\p{N}]++"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
PLAIN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]

LONG = 96
CACHED_WORDS = 200_000  # words kept per Python worker, and half as many that change; some 60 MB
ID_BITS = 20
ID_MASK = (1 << ID_BITS) - 1
NEVER = 1 << 60


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Vocabulary(dict):
    """Merge table, token bytes and special tokens of one vocabulary file; as a dict, the words seen so far."""

    def __init__(self, text: str) -> None:
        super().__init__()
        spec = json.loads(text)
        others = iter(range(256, 512))
        char = {b: chr(b) if b in set(PLAIN_BYTES) else chr(next(others)) for b in range(256)}
        byte = {c: b for b, c in char.items()}
        ids = spec["model"]["vocab"]
        self.byte_id = [ids[char[b]] for b in range(256)]
        self.late: dict[str, tuple[int, ...]] = {}
        self.merges: dict[int, int] = {}
        for rank, (left, right) in enumerate(
            m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]
        ):
            self.merges[ids[left] << ID_BITS | ids[right]] = rank << ID_BITS | ids[left + right]
        self.bytes_of = {i: bytes(byte[c] for c in token) for token, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.find = regex.compile(PATTERN).findall
        longest = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self.cut = regex.compile(f"({'|'.join(longest)})").split if longest else None

    def __missing__(self, word: str) -> tuple[int, ...]:
        """Words met first stay; later ones share a second, smaller store that is emptied when full."""
        found = self.late.get(word)
        if found is None:
            data = word.encode("utf-8", "replace")
            found = tuple(self.by_scan(data) if len(data) <= LONG else self.by_heap(data))
            if len(self) < CACHED_WORDS:
                self[word] = found
            else:
                if len(self.late) >= CACHED_WORDS // 2:
                    self.late.clear()
                self.late[word] = found
        return found

    def rank(self, left: int, right: int) -> int:
        """Merge rank of two parts in the upper bits, the merged part's id in the lower ones."""
        return self.merges.get(left << ID_BITS | right, NEVER)

    def by_scan(self, data: bytes) -> list[int]:
        parts = [self.byte_id[b] for b in data]
        get = self.merges.get
        ranks = [get(a << ID_BITS | b, NEVER) for a, b in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) < NEVER:
            i = ranks.index(least)
            parts[i] = merged = least & ID_MASK
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get(parts[i - 1] << ID_BITS | merged, NEVER)
            if i < len(ranks):
                ranks[i] = get(merged << ID_BITS | parts[i + 1], NEVER)
        return parts

    def by_heap(self, data: bytes) -> list[int]:
        """The same merges, smallest rank first and leftmost among equals, for long words."""
        parts: list[int | None] = [self.byte_id[b] for b in data]
        before, after = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        heap = [(r, i) for i in range(len(parts) - 1) if (r := self.rank(parts[i], parts[i + 1])) < NEVER]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= len(parts) or self.rank(parts[i], parts[j]) != rank:
                continue
            parts[i], parts[j] = rank & ID_MASK, None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < len(parts) and (r := self.rank(parts[a], parts[after[a]])) < NEVER:
                    heapq.heappush(heap, (r, a))
        return [p for p in parts if p is not None]

    def encode(self, text: str) -> list[int]:
        word = self.__getitem__
        if self.cut is None or not any(s in text for s in self.special):
            return list(chain.from_iterable(map(word, self.find(text))))
        out: list[int] = []
        for piece in self.cut(text):
            if piece in self.special:
                out.append(self.special[piece])
            else:
                out.extend(chain.from_iterable(map(word, self.find(piece))))
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_loaded: dict[int, Vocabulary] = {}


def loaded(shared) -> Vocabulary:
    """The vocabulary of a broadcast file, parsed once per Python worker."""
    text = shared.value
    key = hash(text)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Vocabulary(text)
    return _loaded[key]


def share(spark: SparkSession, path: str | None):
    """The file's text as a broadcast: one vocabulary, whatever the size of the corpus."""
    with open(path or default_vocabulary(), encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def with_columns(batch: pa.RecordBatch, new: dict[str, pa.Array]) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n not in new]
    return pa.RecordBatch.from_arrays(
        [*(batch.column(n) for n in names), *new.values()], [*names, *new]
    )


def schema_with(df: DataFrame, new: list[T.StructField]) -> T.StructType:
    taken = {f.name for f in new}
    return T.StructType([*(f for f in df.schema.fields if f.name not in taken), *new])


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def encode(
    df: DataFrame, text: str = "text", ids: str = "ids", count: str = "n_tokens", vocabulary: str | None = None,
    exact: str | None = None,
) -> DataFrame:
    """`df` with each text's token ids and their number.

    `exact` names a column that says whether the ids, decoded in the same pass, give the text back.
    """
    shared = share(df.sparkSession, vocabulary)

    def run(batches):
        words = loaded(shared)
        for batch in small_batches(batches):
            texts = [t or "" for t in batch.column(text).to_pylist()]
            found = [words.encode(t) for t in texts]
            same = {exact: pa.array([words.decode(i) == t for i, t in zip(found, texts)], pa.bool_())} if exact else {}
            yield with_columns(batch, {
                ids: pa.array(found, pa.list_(pa.int32())), count: pa.array(map(len, found), pa.int64()), **same,
            })

    return df.mapInArrow(run, schema_with(df, [
        T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(count, T.LongType()),
        *([T.StructField(exact, T.BooleanType())] if exact else []),
    ]))


def decode(df: DataFrame, ids: str = "ids", text: str = "decoded", vocabulary: str | None = None) -> DataFrame:
    """`df` with the text its ids stand for."""
    shared = share(df.sparkSession, vocabulary)

    def run(batches):
        words = loaded(shared)
        for batch in small_batches(batches):
            yield with_columns(batch, {
                text: pa.array([words.decode(i or []) for i in batch.column(ids).to_pylist()], pa.string()),
            })

    return df.mapInArrow(run, schema_with(df, [T.StructField(text, T.StringType())]))


def round_trip(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): encodes, decodes the ids, and keeps only digests of both.

    `encode` followed by `decode` in one pass, for when the ids themselves are not wanted: they never leave the task.
    """
    shared = share(df.sparkSession, vocabulary)

    def run(batches):
        words = loaded(shared)
        decimal = {i: str(i) for i in words.bytes_of}.__getitem__
        for batch in small_batches(batches):
            counts, ids_sha, text_sha = [], [], []
            for value in batch.column(1).to_pylist():
                ids = words.encode(value or "")
                counts.append(len(ids))
                ids_sha.append(sha256(",".join(map(decimal, ids)).encode()).hexdigest())
                text_sha.append(sha256(words.decode(ids).encode("utf-8", "replace")).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                [key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return df.select(key, text).mapInArrow(run, T.StructType([
        df.schema[key], T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    ]))
