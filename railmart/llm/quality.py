"""Quality: ridge regression on random Fourier features of document statistics, with isotonic calibration.

Each text gives STATISTICS numbers (shares of byte classes, word and line shapes, repetition), standardised by mean and
deviation over all training rows. FOURIER random cosines of them approximate a Gaussian kernel. Partitions
sum their parts of the normal equations, the driver gets the sums (a square of fixed size) and solves for the ridge
weights. A quarter of the training rows is left out of that; their raw scores, counted in BINS bins, give an isotonic
curve by pooling adjacent violators. All labelled training rows take part, and every text is read in full.

Null and empty texts have statistics of zero and are scored like others. Equal texts have equal scores. Without labels
of both kinds every text scores their base rate (0 without any). An empty table gives no rows. Rows with repeated ids are
scored one by one; in training a label counts for each row of its id. Added columns replace namesakes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railmart.llm.common import BLANK, LOWER, Spans, add_blobs, runs, staged, text_slices

STATISTICS = 20
FOURIER = 256
RIDGE = 1e-3
WIDTH = 0.25  # of the kernel, as a weight on distances between standardised statistics
BINS = 1024

# byte classes: 0 other ASCII, 1 small letter, 2 capital, 3 digit, 4 blank, 5 line end, 6 sentence mark, 7 beyond ASCII
CLASS = np.zeros(256, np.int64)
CLASS[97:123], CLASS[65:91], CLASS[48:58], CLASS[128:] = 1, 2, 3, 7
CLASS[np.flatnonzero(BLANK)] = 4
CLASS[10] = 5
CLASS[[ord(c) for c in ".,;:!?"]] = 6


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of numbers per text."""
    rows, size = len(offsets) - 1, np.diff(offsets)
    row = np.repeat(np.arange(rows), size)
    kinds = np.bincount(row * 8 + CLASS[data], minlength=rows * 8).reshape(rows, 8)
    starts, ends, word_row = runs(~BLANK[data], offsets)
    words = np.bincount(word_row, minlength=rows)
    length = (ends - starts).astype(float)

    def per_word(values) -> np.ndarray:
        return np.bincount(word_row, values, rows) / np.maximum(words, 1)

    mean_length = per_word(length)
    hashes = Spans(LOWER[data]).hash(starts, ends) if len(starts) else np.zeros(0, np.uint64)
    again = np.zeros(len(hashes))
    again[1:] = (hashes[1:] == hashes[:-1]) & (word_row[1:] == word_row[:-1])
    order = np.lexsort((hashes, word_row))
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (word_row[order][1:] != word_row[order][:-1])
    distinct = np.bincount(word_row[order][fresh], minlength=rows)
    first = CLASS[data[starts]] if len(starts) else np.zeros(0, int)
    last = CLASS[data[ends - 1]] if len(starts) else np.zeros(0, int)
    line_start, line_end, line_row = runs(data != 10, offsets)
    lines = np.bincount(line_row, minlength=rows)
    line_length = np.bincount(line_row, line_end - line_start, rows) / np.maximum(lines, 1)
    closed = np.bincount(line_row, (CLASS[data[line_end - 1]] == 6) if len(line_start) else None, rows)
    text_size = np.maximum(size, 1)
    out = np.stack([
        np.log1p(size), np.log1p(words), mean_length, np.sqrt(np.maximum(per_word(length**2) - mean_length**2, 0)),
        *(kinds[:, k] / text_size for k in range(8)), per_word(again), distinct / np.maximum(words, 1),
        per_word(first == 2), per_word((last == 0).astype(float)), per_word((length >= 20).astype(float)),
        np.log1p(line_length), closed / np.maximum(lines, 1), per_word((length == 1) & (first == 0)),
    ], 1)
    return out


def described(df: DataFrame, key: str, text: str) -> DataFrame:
    """(id, stats) of every row, staged: the texts are read once."""
    def run(batches):
        for batch, data, offsets in text_slices(batches):
            found = statistics(data, offsets).astype(np.float32)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), STATISTICS).cast(pa.list_(pa.float32())),
            ], ["id", "stats"])

    kind = df.schema[key].dataType.simpleString()
    return staged(
        df.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, stats array<float>"), "stats"
    )


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, STATISTICS).astype(float)


class Model:
    """Standardisation, random features, ridge weights and the isotonic curve."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        self.turn = rng.normal(size=(STATISTICS, FOURIER)) * WIDTH
        self.phase = rng.uniform(0, 2 * np.pi, FOURIER)
        self.weights = np.zeros(FOURIER + 1)
        self.at, self.level = np.array([0.0]), np.array([0.0])

    def fourier(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.spread, -8, 8)
        out = np.ones((len(z), FOURIER + 1))
        out[:, :-1] = np.cos(z @ self.turn + self.phase) * np.sqrt(2 / FOURIER)
        return out

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.fourier(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """The isotonic level, joined by lines, with a trace of the raw score so that ranks within a level stay."""
        raw = self.raw(stats)
        level = np.interp(raw, self.at, self.level)
        return np.clip(0.999 * level + 0.001 * np.clip((raw + 0.5) / 2, 0, 1), 0, 1)


def isotonic(x: np.ndarray, good: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators over bins in order of x: places and levels of the curve."""
    blocks: list[list[float]] = []
    for place, g, n in zip(x, good, total):
        blocks.append([place * n, g, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            a, b = blocks.pop(), blocks.pop()
            blocks.append([u + v for u, v in zip(a, b)])
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def train(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality"):
    """The model learned from `labels` (key, label) cut by the caller to the rows to learn from; or their base rate."""
    rows = staged(
        labels.where(F.col(label).isin(0, 1)).select(
            F.col(key).alias("id"), F.col(label).cast("double").alias("label"),
            (F.pmod(F.crc32(F.concat(F.lit("fold"), F.col(key).cast("string"))), F.lit(4)) == 0).alias("curve"),
        ).join(stats, "id"), "training"
    )
    columns = [F.col("stats")[i].cast("double") for i in range(STATISTICS)]
    # the built-in deviation merges means of partitions, and so keeps its digits
    seen = rows.agg(
        F.avg("label").alias("base"), *(F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)),
        *(F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)),
    ).first()
    base = seen["base"] or 0.0
    if base in (0.0, 1.0):
        return base
    model = Model(*(np.array([seen[f"{k}{i}"] for i in range(STATISTICS)]) for k in "ms"))

    def normal(batches):
        total = np.zeros((FOURIER + 1, FOURIER + 2))
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                part = batch.slice(first, 4096)
                z = model.fourier(matrix(part.column("stats")))
                y = part.column("label").to_numpy(zero_copy_only=False)
                total += z.T @ np.column_stack([z, y])
        yield pa.RecordBatch.from_arrays([
            pa.array(range(len(total)), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary()),
        ], ["block", "blob"])

    parts = rows.where(~F.col("curve")).mapInArrow(normal, "block int, blob binary")
    sums = np.zeros((FOURIER + 1, FOURIER + 2))
    for block, blob in add_blobs(parts).collect():  # FOURIER + 1 rows
        sums[block] += np.frombuffer(blob)
    count = sums[-1, FOURIER]
    model.weights = np.linalg.solve(sums[:, :-1] + RIDGE * max(count, 1) / FOURIER * np.eye(FOURIER + 1), sums[:, -1])

    def binned(batches):
        good, total = np.zeros(BINS), np.zeros(BINS)
        for batch in batches:
            place = ((np.clip(model.raw(matrix(batch.column("stats"))), -0.5, 1.5) + 0.5) / 2 * (BINS - 1)).astype(int)
            y = batch.column("label").to_numpy(zero_copy_only=False)
            good += np.bincount(place, y, BINS)
            total += np.bincount(place, minlength=BINS)
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([np.stack([good, total]).tobytes()])], ["block", "blob"])

    curve = add_blobs(rows.where("curve").mapInArrow(binned, "block int, blob binary")).collect()
    good, total = np.frombuffer(curve[0][1]).reshape(2, BINS) if curve else np.zeros((2, BINS))
    used = np.flatnonzero(total)
    if len(used):
        model.at, model.level = isotonic((used + 0.5) / (BINS - 1) * 2 - 0.5, good[used], total[used])
    else:
        model.at, model.level = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def score(stats: DataFrame, model, key: str = "doc_id", threshold: float = 0.3) -> DataFrame:
    """(key, score, predicted) of described rows."""
    shared = stats.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                part = batch.slice(first, 4096)
                found = shared.value
                if isinstance(found, Model):
                    found = found.score(matrix(part.column("stats")))
                found = np.broadcast_to(found, part.num_rows).astype(float)
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), pa.array(found), pa.array((found >= threshold).astype(np.int32)),
                ], [key, "score", "predicted"])

    kind = stats.schema["id"].dataType.simpleString()
    return stats.mapInArrow(run, f"{key} {kind}, score double, predicted int")
