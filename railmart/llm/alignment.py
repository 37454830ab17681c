"""Alignment of two tokenizers by inverted bitmaps of token pairs.

A text is cut into tokens twice: a blank and the text by a byte-level tokenizer (A), the text by a piece tokenizer that adds the
blank itself (B). Where tokens of both end at the same byte, a group ends; a token of A and one of B are linked where their
bytes overlap. How many texts hold a pair of ids linked is its count, over the whole table.

Texts are worked on in blocks (at most `block_bytes` of text, and 2^16 rows). In a block every pair has a compressed bitmap of
the block's texts: numbers of 16 bits while few, one bit a text from a sixteenth of the block on. A text's links of a pair
beyond the first are kept as planes, one bitmap for each binary digit of that number. Slices of a block are OR-merged into it; the
popcounts of a pair's bitmaps over all blocks, which hold different texts, add up to its count. Counts then go back to the
blocks, where the postings return them to their texts: each bitmap adds its pair's count, times the plane's weight.

A pair comes once a block, so no key holds more rows than there are blocks, and nothing grows with the corpus in one task.

Null and empty texts, and texts whose tokens do not give their bytes back, have no tokens: all numbers are 0 and the digest is
an empty string. Rows are texts of their own, whatever their ids; null ids stay. Very long texts make a block of their own.
An empty table gives no rows. Only the key and the text are read; other columns do not reach the result.
"""

from __future__ import annotations

import uuid
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railmart.llm.bpe import Vocabulary, default_vocabulary
from railmart.llm.common import staged, text_slices

BLOCK_BYTES, BLOCK_ROWS = 16 << 20, 1 << 16
ID_BITS = 20
DENSE = 16  # one bit a text from one text in so many on


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Ragged:
    """Byte strings under numbers."""

    def __init__(self, values: list[bytes]) -> None:
        self.size = np.array([len(v) for v in values], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(values), np.uint8)

    def joined(self, numbers: np.ndarray) -> np.ndarray:
        size = self.size[numbers]
        return self.data[np.repeat(self.start[numbers] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))]


class Tokenizers:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, a: str, b: bytes) -> None:
        import sentencepiece

        self.a = Vocabulary(a)
        self.a.cut = None  # strings of special tokens are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        self.a_bytes = Ragged([self.a.bytes_of.get(i, b"") for i in range(max(self.a.bytes_of) + 1)])
        self.b_bytes = Ragged([
            bytes([int(piece[3:-1], 16)]) if self.b.IsByte(i) else b"" if self.b.IsControl(i) or self.b.IsUnknown(i)
            else piece.replace("▁", " ").encode()
            for i, piece in enumerate(map(self.b.IdToPiece, range(self.b.GetPieceSize())))
        ])
        self.decimal = Ragged([b"%d" % i for i in range(max(len(self.a_bytes.size), len(self.b_bytes.size)))])


_loaded: dict[int, Tokenizers] = {}


def loaded(shared) -> Tokenizers:
    """The tokenizers of broadcast files, made once per Python worker."""
    key = hash(shared.value)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Tokenizers(*shared.value)
    return _loaded[key]


class Side:
    """Tokens of one tokenizer over texts written one after another, and how many bytes and tokens each text has."""

    def __init__(self, tokens: list[list[int]], known: Ragged) -> None:
        self.many = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.ids = np.fromiter(chain.from_iterable(tokens), np.int64, int(self.many.sum()))
        self.sizes = known.size[self.ids]
        self.bytes = np.diff(np.concatenate([[0], np.cumsum(self.sizes)])[np.concatenate([[0], np.cumsum(self.many)])])

    def keep(self, texts: np.ndarray) -> None:
        chosen = np.repeat(texts, self.many)
        self.ids, self.sizes, self.many, self.bytes = self.ids[chosen], self.sizes[chosen], self.many[texts], self.bytes[texts]


class Aligned:
    """Tokens, groups and links of a slice of texts, as if it were one text."""

    def __init__(self, both: Tokenizers, texts: list[str | None]) -> None:
        self.count = len(texts)
        self.rows = np.array([k for k, t in enumerate(texts) if t], np.int64)
        filled = [" " + t for t in texts if t]
        want = [t.encode() for t in filled]
        a, b = Side([both.a.encode(t) for t in filled], both.a_bytes), Side(both.b.encode([t[1:] for t in filled], num_threads=1), both.b_bytes)
        size = np.fromiter(map(len, want), np.int64, len(want))
        right = (a.bytes == size) & (b.bytes == size)  # of the right length, then byte for byte
        self._keep(right, a, b)
        data = np.frombuffer(b"".join(w for w, good in zip(want, right.tolist()) if good), np.uint8)
        same = (both.a_bytes.joined(a.ids) == data) & (both.b_bytes.joined(b.ids) == data)
        if not same.all():
            size = size[right]
            wrong = np.bincount(np.repeat(np.arange(len(size)), size), ~same, minlength=len(size)) > 0
            self._keep(~wrong, a, b)
        self.a, self.b = a.ids, b.ids
        self.a_ends, self.b_ends = np.cumsum(a.sizes), np.cumsum(b.sizes)
        self.a_many, self.b_many, self.text_ends = a.many, b.many, np.cumsum(a.bytes)
        length = int(self.text_ends[-1]) if len(self.text_ends) else 0
        self.a_end, self.b_end = np.zeros(length + 1, bool), np.zeros(length + 1, bool)  # does a token end after so many bytes
        self.a_end[self.a_ends], self.b_end[self.b_ends] = True, True
        self.group = np.cumsum(self.a_end & self.b_end)  # groups that end there or before

    def _keep(self, texts: np.ndarray, a: Side, b: Side) -> None:
        self.rows = self.rows[texts]
        a.keep(texts)
        b.keep(texts)

    def numbers(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of A, tokens of B and groups of every text."""
        out = np.zeros((3, self.count), np.int64)
        out[0, self.rows], out[1, self.rows] = self.a_many, self.b_many
        out[2, self.rows] = np.diff(self.group[self.text_ends], prepend=0)
        return out[0], out[1], out[2]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Pair and text of every link: one for each stretch of bytes between neighbouring ends of either side."""
        ends = np.flatnonzero(self.a_end | self.b_end)
        a, b = (side[np.cumsum(end)[ends - 1]] for side, end in ((self.a, self.a_end), (self.b, self.b_end)))
        return a << ID_BITS | b, np.repeat(self.rows, np.diff(np.searchsorted(ends, self.text_ends, "right"), prepend=0))

    def digests(self, decimal: Ragged) -> list[str]:
        """SHA-256 of the groups of every text, written out."""
        a_group, b_group = self.group[self.a_ends - 1], self.group[self.b_ends - 1]
        groups = int(self.group[-1])
        a_before = np.concatenate([[0], np.cumsum(np.bincount(a_group, minlength=groups))])
        b_before = np.concatenate([[0], np.cumsum(np.bincount(b_group, minlength=groups))])
        token = np.zeros(len(self.a) + len(self.b), np.int64)
        after = np.full(len(token), ord(","), np.uint8)
        a_at = np.arange(len(self.a)) + b_before[a_group]
        b_at = np.arange(len(self.b)) + a_before[b_group + 1]
        token[a_at], token[b_at] = self.a, self.b
        after[a_at[self.b_end[self.a_ends]]] = ord("|")
        after[b_at[self.a_end[self.b_ends]]] = ord(";")
        ends = np.cumsum(decimal.size[token] + 1)
        line = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
        inside = np.ones(len(line), bool)
        inside[ends - 1] = False
        line[inside], line[ends - 1] = decimal.joined(token), after
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(self.a_many + self.b_many)])]
        out = [""] * self.count
        for k, first, last in zip(self.rows.tolist(), edges.tolist(), edges[1:].tolist()):
            out[k] = sha256(line[first:last - 1].tobytes()).hexdigest()
        return out


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and how often each comes."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.diff(first, append=len(keys))


def compressed(texts: int, slot: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, bytes, bytes]:
    """Bitmaps of sorted (slot, text): their slots and popcounts, the 16-bit numbers of the sparse ones, the bits of the dense."""
    slots, size = distinct(slot)
    first = np.cumsum(size) - size
    dense = size * DENSE >= texts
    sparse = text[np.repeat(~dense, size)].astype(np.uint16).tobytes()
    bits = []
    for at, many in zip(first[dense].tolist(), size[dense].tolist()):
        flags = np.zeros(texts, np.uint8)
        flags[text[at:at + many]] = 1
        bits.append(np.packbits(flags).tobytes())
    return slots, size, sparse, b"".join(bits)


def members(texts: int, size: np.ndarray, sparse: bytes, bits: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The texts of all bitmaps and which bitmap each is from; the way back of `compressed`."""
    dense = np.flatnonzero(size * DENSE >= texts)
    number = np.repeat(np.arange(len(size)), np.where(size * DENSE >= texts, 0, size))
    text = np.frombuffer(sparse, np.uint16).astype(np.int64)
    flags = np.unpackbits(np.frombuffer(bits, np.uint8).reshape(len(dense), -1), axis=1) if len(dense) else np.zeros((0, 0), np.uint8)
    which, held = np.nonzero(flags)
    return np.append(text, held), np.append(number, dense[which])


BITMAPS = "array<struct<weight: bigint, slots: array<int>, sizes: array<int>, sparse: binary, bits: binary>>"


class Block:
    """The texts of one block and the links met so far."""

    def __init__(self) -> None:
        self.ids, self.numbers, self.digests, self.met = [], [], [], []
        self.texts = self.size = 0

    def add(self, both: Tokenizers, batch: pa.RecordBatch, size: int) -> None:
        found = Aligned(both, batch.column(1).to_pylist())
        pair, text = found.links()
        self.met.append(distinct(pair << 16 | text + self.texts))
        self.ids.append(batch.column(0))
        self.numbers.append(np.stack(found.numbers()))
        self.digests += found.digests(both.decimal)
        self.texts += batch.num_rows
        self.size += size

    def row(self, schema: pa.Schema) -> pa.RecordBatch:
        keys = np.concatenate([k for k, _ in self.met])
        times = np.concatenate([t for _, t in self.met])
        order = np.argsort(keys, kind="stable")
        keys, more = keys[order], times[order] - 1
        pair = keys >> 16
        pairs, many = distinct(pair)
        slot = np.repeat(np.arange(len(pairs)), many)
        text = keys & 0xFFFF
        bitmaps, counts = [], []
        for digit in range(-1, int(more.max(initial=0)).bit_length()):
            chosen = slice(None) if digit < 0 else (more >> digit & 1).astype(bool)
            slots, sizes, sparse, bits = compressed(self.texts, slot[chosen], text[chosen])
            bitmaps.append({"weight": 1 << max(0, digit), "slots": slots, "sizes": sizes, "sparse": sparse, "bits": bits})
            counts = counts if digit >= 0 else sizes
        ids = pa.chunked_array(self.ids).combine_chunks()
        numbers = np.concatenate(self.numbers, axis=1)
        return pa.RecordBatch.from_arrays([pa.array([value], kind) for value, kind in zip(
            [uuid.uuid4().hex, ids.to_pylist(), *numbers, self.digests, pairs, counts, bitmaps], schema.types
        )], schema.names)


def blocks(docs: DataFrame, key: str, text: str, shared, block_bytes: int) -> DataFrame:
    """One row a block: its texts' own numbers, its pairs with the texts that hold them, and their bitmaps."""
    from pyspark.sql.pandas.types import to_arrow_schema

    longs, kind = T.ArrayType(T.LongType()), docs.schema[key].dataType
    schema = T.StructType([
        T.StructField("block", T.StringType()), T.StructField("ids", T.ArrayType(kind)),
        *(T.StructField(n, longs) for n in ("n_a", "n_b", "n_groups")), T.StructField("digests", T.ArrayType(T.StringType())),
        T.StructField("pairs", longs), T.StructField("held", longs),
        *T._parse_datatype_string(f"bitmaps {BITMAPS}").fields,
    ])
    arrow = to_arrow_schema(schema)

    def run(batches):
        both, now = loaded(shared), Block()
        for batch, data, _ in text_slices(batches, text):
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(first, BLOCK_ROWS)
                if now.texts and (now.size + len(data) > block_bytes or now.texts + part.num_rows > BLOCK_ROWS):
                    yield now.row(arrow)
                    now = Block()
                now.add(both, part, len(data))
        if now.texts:
            yield now.row(arrow)

    return docs.select(key, text).mapInArrow(run, schema)


def scores(batches):
    """Texts of every block with what their postings return."""
    for batch in batches:
        for k in range(batch.num_rows):
            value = {n: batch.column(n)[k] for n in batch.schema.names}
            texts = len(value["ids"])
            slot = value["counts"].values.field("slot").to_numpy()
            count, best = np.zeros(len(value["pairs"]), np.int64), np.zeros(len(value["pairs"]), np.int64)
            count[slot] = value["counts"].values.field("n").to_numpy()
            best[slot] = value["counts"].values.field("best").to_numpy(zero_copy_only=False)
            links, sums, bests = (np.zeros(texts, np.int64) for _ in range(3))
            for plane in value["bitmaps"].as_py():
                size, weight = np.array(plane["sizes"], np.int64), plane["weight"]
                text, number = members(texts, size, plane["sparse"], plane["bits"])
                which = np.array(plane["slots"], np.int64)[number]
                np.add.at(links, text, weight)
                np.add.at(sums, text, weight * count[which])
                np.add.at(bests, text, weight * best[which])
            yield pa.RecordBatch.from_arrays([
                value["ids"].values, *(value[n].values for n in ("n_a", "n_b", "n_groups")),
                pa.array(links), pa.array(bests), pa.array(sums), value["digests"].values,
            ], [batch.schema.names[0], "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def align(
    docs: DataFrame, key: str = "doc_id", text: str = "text", a: str | None = None, b: str | None = None,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row; `a`, `b`: paths of the vocabularies."""
    with open(a or default_vocabulary(), encoding="utf-8") as first, open(b or default_pieces(), "rb") as second:
        shared = docs.sparkSession.sparkContext.broadcast((first.read(), second.read()))  # two vocabularies, whatever the corpus
    found = staged(blocks(docs, key, text, shared, block_bytes), "blocks")
    counts = staged(
        found.select(F.inline(F.arrays_zip("pairs", "held"))).groupBy(F.col("pairs").alias("pair")).agg(F.sum("held").alias("n")),
        "pairs", narrow=4,
    ).withColumn("a", F.shiftright("pair", ID_BITS))
    top = counts.groupBy("a").agg(F.max("n").alias("top"))
    marked = counts.join(top, "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    back = found.select("block", F.posexplode("pairs").alias("slot", "pair")).join(marked, "pair").groupBy("block").agg(
        F.collect_list(F.struct("slot", "n", "best")).alias("counts")  # as many as a block has pairs
    )
    return found.join(back, "block", "left").select(
        "ids", "n_a", "n_b", "n_groups", "digests", "pairs", "bitmaps",
        F.coalesce("counts", F.expr("array()")).cast("array<struct<slot: int, n: bigint, best: boolean>>").alias("counts"),
    ).mapInArrow(scores, T.StructType([
        docs.schema[key], *(T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
        T.StructField("groups_sha256", T.StringType()),
    ]))
