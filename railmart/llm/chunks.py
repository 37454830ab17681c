"""Substring dedup by content-defined chunks.

Texts (UTF-8 bytes) are cut where a gear rolling hash has its upper bits zero: h = 2 h + gear[byte], modulo 2^BITS, so a
cut depends on the last BITS bytes only and cuts fall alike wherever a passage stands. Chunks hold `least` to `most` bytes.
Of equal chunks (by 128-bit digest) the first by (id, hash of id and text, place) stays and the others are dropped, whatever their text.

A passage of several hundred bytes always holds whole chunks; its ragged ends up to the next cut stay. Null and empty texts
have no chunks. A chunk shorter than `least` (only a text's last) counts, with `tails`, as equal to another such chunk if the
chunks before both are equal too, or if both are whole texts; so a copy loses all its bytes, and texts that only end alike
keep their ends. Without `tails` such chunks are never dropped, nor counted as repeats. Cuts fall between characters. A row is known by its id and 64 bits
of id and text: rows of one id lose their own chunks only, rows equal in both lose alike and none to the other. Rows without
id come last. An empty table gives no rows. Added columns replace namesakes.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railmart.llm.bpe import schema_with, with_columns
from railmart.llm.common import free_names, mix, row_key, staged, text_slices

BITS = 16
GEAR = (mix(np.arange(5001, 5257, dtype=np.uint64)) >> np.uint64(48)).astype(np.uint16)
CUT_BITS = 6  # a cut every 64 bytes or so
LEAST, MOST = 32, 512
LAST_ID = (1 << 63) - 1  # place of rows without id


def rolling(data: np.ndarray) -> np.ndarray:
    """Gear hash after each byte, as if rolled from BITS bytes before (or from the start)."""
    gear = GEAR[data]
    out = gear.copy()
    for j in range(1, min(BITS, len(data))):
        out[j:] += gear[:-j] << np.uint16(j)
    return out


def cuts(data: np.ndarray, offsets: np.ndarray, least: int = LEAST, most: int = MOST) -> list[list[int]]:
    """Chunk ends of every text, counted from its own start. The hash starts anew with each text."""
    found = []
    inside = (np.append(data, 0) & 0xC0) == 0x80  # bytes that go on a character
    mark = np.flatnonzero(rolling(data) >> np.uint16(BITS - CUT_BITS) == 0) + 1
    mark = mark[~inside[mark]]
    at = np.searchsorted(mark, offsets, "right")
    for i in range(len(offsets) - 1):
        first, size = int(offsets[i]), int(offsets[i + 1] - offsets[i])
        ends, last = [], 0

        def forced(place: int) -> int:
            place += most
            while inside[first + place]:
                place += 1
            return place

        # hashes of the first BITS bytes may look back into the row before, but no cut falls below `least` > BITS
        for place in (mark[at[i]:at[i + 1]] - first).tolist():
            while place - last > most + 3:
                last = forced(last)
                ends.append(last)
            if place - last >= least:
                last = place
                ends.append(last)
        while size - last > most + 3:
            last = forced(last)
            ends.append(last)
        if size > last:
            ends.append(size)
        found.append(ends)
    return found


def chunked(docs: DataFrame, least: int, most: int, tails: bool) -> DataFrame:
    """(hi, lo, id, row, start, size, again): the chunks of at least `least` bytes; again: not the first such one of its text.

    With `tails` also a short last chunk, its digest taken from where the chunk before it starts.
    """
    def run(batches):
        for batch, data, offsets in text_slices(batches):
            hashes, of, starts, sizes, again = [], [], [], [], []
            raw = data.tobytes()
            for k, (base, ends) in enumerate(zip(offsets.tolist(), cuts(data, offsets, least, most))):
                before, last, met = 0, 0, set()
                for end in ends:
                    whole = end - last >= least
                    if whole or tails:
                        digest = (
                            blake2b(raw[base + last:base + end], digest_size=16) if whole
                            else blake2b(raw[base + before:base + end], digest_size=16, key=(last - before).to_bytes(4, "big"))
                        ).digest()
                        hashes.append(digest)
                        of.append(k)
                        starts.append(last)
                        sizes.append(end - last)
                        again.append(digest in met)
                        met.add(digest)
                    before, last = last, end
            pair = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.ascontiguousarray(pair[:, 0])), pa.array(np.ascontiguousarray(pair[:, 1])),
                *(batch.column(name).take(pa.array(of, pa.int64())) for name in ("id", "row")), pa.array(starts, pa.int64()), pa.array(sizes, pa.int32()), pa.array(again, pa.bool_()),
            ], ["hi", "lo", "id", "row", "start", "size", "again"])

    return docs.mapInArrow(run, "hi long, lo long, id long, row long, start long, size int, again boolean")


def dedup(
    df: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, most: int = MOST, tails: bool = False
) -> DataFrame:
    """`df` with kept_text, n_bytes, n_shared, n_repeated, n_removed and first_id.

    n_shared counts the text's chunks that occur in other texts too, n_repeated those dropped, n_removed their bytes;
    first_id is the smallest id that keeps a chunk this text has lost, null where nothing is lost.
    """
    row = {"id": F.coalesce(F.col(key).cast("long"), F.lit(LAST_ID)), "row": row_key(key, text)}  # never null
    docs = df.select(*(c.alias(name) for name, c in row.items()), F.col(text).alias("text"))
    found = chunked(docs, least, most, tails)
    first = (
        found.where("not again").groupBy("hi", "lo").agg(F.min(F.struct("id", "row")).alias("first"), F.max(F.struct("id", "row")).alias("last"))
        .where("first < last").select("hi", "lo", F.col("first.id").alias("first_id"), F.col("first.row").alias("first_row"))
    )
    lost = found.join(first, ["hi", "lo"], "left").where("again or first_id is not null").withColumn(
        "gone", F.expr("again or id > first_id or (id = first_id and row > first_row)")
    )
    lost = staged(
        lost.groupBy("id", "row").agg(  # the chunks of one text
            F.collect_set(F.when(F.col("gone"), F.struct("start", "size"))).alias("dropped"),
            F.size(F.collect_set(F.when(F.col("first_id").isNotNull(), F.col("start")))).cast("long").alias("n_shared"),
            F.nullif(F.min(F.when(F.col("gone"), F.coalesce("first_id", "id"))), F.lit(LAST_ID)).alias("first_id"),
        ), "chunks"
    )
    rest = df.drop("kept_text", "n_bytes", "n_shared", "n_repeated", "n_removed", "first_id")
    own_id, own_row, cut_chunks = free_names(df, "id", "row", "dropped")
    joined = rest.withColumns({own_id: row["id"], own_row: row["row"]}).join(
        lost.toDF(own_id, own_row, cut_chunks, "n_shared", "first_id"), [own_id, own_row], "left"
    ).drop(own_id, own_row).withColumn("n_shared", F.coalesce("n_shared", F.lit(0)))

    def cut_out(batches):
        for batch, data, offsets in text_slices(batches, text):
            texts, repeated, removed = [], [], []
            for i, dropped in enumerate(batch.column(cut_chunks).to_pylist()):
                own = data[offsets[i]:offsets[i + 1]]
                keep = np.ones(len(own), bool)
                for span in dropped or ():
                    keep[span["start"]:span["start"] + span["size"]] = False
                texts.append(own[keep].tobytes().decode("utf-8", "replace"))
                repeated.append(len(dropped or ()))
                removed.append(int(len(own) - keep.sum()))
            yield with_columns(batch.drop_columns([cut_chunks]), {
                "kept_text": pa.array(texts, pa.string()), "n_bytes": pa.array(np.diff(offsets), pa.int64()),
                "n_repeated": pa.array(repeated, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
            })

    return joined.mapInArrow(cut_out, schema_with(joined.drop(cut_chunks), [
        T.StructField("kept_text", T.StringType()), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_repeated", T.LongType()), T.StructField("n_removed", T.LongType()),
    ]))
