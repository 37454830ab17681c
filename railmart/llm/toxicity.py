"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs.

A text's words (runs of letters, A-Z lower-cased) are read in windows of WINDOW words, each half over the next; every
window of the whole text is scored and the highest counts. A word enters with word inputs (a learned weight from a hashed
table and a fixed random one) and character inputs (largest and mean learned weight of its pieces of four and of seven
letters, its length). Both directions' states are pooled by learned attention, and a logistic layer follows. Training
is in numpy: weights of the tables are smoothed log odds of labelled texts; the network learns by back propagation
through time, for a toxic text on its most suspicious window, for a clean one on its most suspicious and on random
ones; a logistic curve then turns a text's highest window into a probability at the base rate of all training labels.

Learning uses at most `toxic_rows` and `clean_rows` labelled texts, the smallest by hash of their id, of at most
`longest` characters; that bounds what the driver holds. Counting labels covers all rows. Scoring covers all.

Null and empty texts and texts without letters hold one empty window, scored like any other. Equal texts have equal
scores. An empty table gives no rows; without labels of both kinds every text scores the base rate (0 without any).
Rows with repeated ids are scored one by one. Columns added replace columns of the same name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railmart.llm.bpe import schema_with, with_columns
from railmart.llm.common import LOWER, STEP, Spans, give_back, mix, runs, text_slices

WINDOW, STRIDE = 16, 8
PIECES = (4, 7)
HIDDEN, INPUTS = 6, 3 + 2 * len(PIECES)
TABLE = 1 << 16
SMOOTH = 3.0
LETTER = np.zeros(256, bool)
LETTER[97:123] = True
LETTER[128:] = True


def word_ids(data: np.ndarray, offsets: np.ndarray):
    """Distinct words of a slice as hashes and first spans, each word's place among them, and the rows' offsets into the words."""
    data = LOWER[data]
    starts, ends, row = runs(LETTER[data], offsets)
    at = np.searchsorted(row, np.arange(len(offsets)))
    if not len(starts):
        return data, np.zeros(0, np.uint64), starts, ends, np.zeros(0, np.int64), at
    hashes, first, place = np.unique(Spans(data).hash(starts, ends), return_index=True, return_inverse=True)
    return data, hashes, starts[first], ends[first], place.reshape(-1), at


def pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Table places of the words' pieces of `size` letters (with one mark before and after), and the words' offsets into them.

    The last pieces of a word are shorter, so every letter begins one.
    """
    code = np.concatenate([[0], np.where(LETTER[data], data, 0), np.zeros(size, int)]).astype(np.uint64)
    lengths = ends - starts
    at = np.concatenate([[0], np.cumsum(lengths)])
    i = np.repeat(starts - at[:-1], lengths) + np.arange(at[-1])
    key, inside = code[i], np.ones(len(i), bool)
    for j in range(1, size):
        inside &= code[i + j] != 0
        key = key << np.uint64(8) | np.where(inside, code[i + j], 0)
    return (mix(key + STEP) % np.uint64(TABLE)).astype(np.int64), at


def features(model: dict, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Inputs of distinct words; the last row stands for no word."""
    out = np.zeros((len(hashes) + 1, INPUTS), np.float32)
    if len(hashes):
        out[:-1, 0] = model["word"][(hashes % np.uint64(TABLE)).astype(np.int64)]
        for column, size in enumerate(PIECES, 1):
            found, at = pieces(data, starts, ends, size)
            weight = model[f"piece{size}"][found]
            out[:-1, column] = np.maximum.reduceat(weight, at[:-1])
            out[:-1, column + len(PIECES)] = np.add.reduceat(weight, at[:-1]) / (ends - starts)
        out[:-1, -2] = np.minimum(ends - starts, 32) / 16
        out[:-1, -1] = (mix(hashes) & np.uint64(0xFFFF)).astype(np.float32) / 65536 - 0.5
    return out


def windows(place: np.ndarray, at: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray]:
    """Word places of all windows, WINDOW in each, filled up with `none`; and the rows' offsets into them."""
    words = np.diff(at)
    count = np.maximum(1, -(-(words - STRIDE) // STRIDE))
    first = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(len(words)), count)
    start = at[:-1][row] + (np.arange(first[-1]) - first[row]) * STRIDE
    index = start[:, None] + np.arange(WINDOW)
    padded = np.append(place, none)
    return np.where(index < at[1:][row][:, None], padded[np.minimum(index, len(place))], none), first


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def start_weights(rng: np.random.Generator) -> dict:
    def around(*shape):
        return (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)

    net = {"out": around(2 * HIDDEN), "bias": np.zeros(1, np.float32), "attend": around(2 * HIDDEN)}
    for side in "fb":
        net |= {f"x{side}": around(INPUTS, 3 * HIDDEN), f"h{side}": around(HIDDEN, 3 * HIDDEN), f"c{side}": np.zeros(3 * HIDDEN, np.float32)}
    return net


def read_windows(net: dict, inputs: np.ndarray, index: np.ndarray, trace: dict | None = None) -> np.ndarray:
    """Logits of windows: both directions, attention, logistic layer. `trace` keeps what the way back needs."""
    n, h = len(index), HIDDEN
    states = np.empty((WINDOW, n, 2 * h), np.float32)
    for side, steps in (("f", range(WINDOW)), ("b", range(WINDOW - 1, -1, -1))):
        given = inputs @ net[f"x{side}"] + net[f"c{side}"]  # once per distinct word
        state = np.zeros((n, h), np.float32)
        cols = slice(0, h) if side == "f" else slice(h, 2 * h)
        for t in steps:
            x = given[index[:, t]]
            rec = state @ net[f"h{side}"]
            gates = sigmoid(x[:, : 2 * h] + rec[:, : 2 * h])
            new = np.tanh(x[:, 2 * h:] + gates[:, h:] * rec[:, 2 * h:])
            if trace is not None:
                trace[side, t] = (state, gates, new, rec[:, 2 * h:])
            state = state + gates[:, :h] * (new - state)
            states[t, :, cols] = state
    used = index.T != len(inputs) - 1
    score = np.where(used, states @ net["attend"], -30.0)
    score = np.exp(score - score.max(0))
    score = score * used / np.maximum((score * used).sum(0), 1e-9)
    pooled = np.einsum("tn,tnh->nh", score, states)
    if trace is not None:
        trace.update(states=states, score=score, pooled=pooled)
    return pooled @ net["out"] + net["bias"][0]


def local(inputs: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The inputs that some windows use, and the windows' places among them; no word stays the last."""
    used, place = np.unique(np.append(index, len(inputs) - 1), return_inverse=True)
    return inputs[used], place.reshape(-1)[:-1].reshape(index.shape)


def gradients(net: dict, inputs: np.ndarray, index: np.ndarray, wanted: np.ndarray) -> tuple[dict, float]:
    trace: dict = {}
    logit = read_windows(net, inputs, index, trace)
    p = sigmoid(logit)
    error = ((p - wanted) / len(index)).astype(np.float32)
    states, score, pooled, h = trace["states"], trace["score"], trace["pooled"], HIDDEN
    grad = {"out": pooled.T @ error, "bias": error.sum(keepdims=True)}
    d_pooled = error[:, None] * net["out"]
    d_score = np.einsum("nh,tnh->tn", d_pooled, states)
    d_raw = score * (d_score - (score * d_score).sum(0))
    grad["attend"] = np.einsum("tn,tnh->h", d_raw, states)
    d_states = score[:, :, None] * d_pooled + d_raw[:, :, None] * net["attend"]
    for side, steps in (("f", range(WINDOW - 1, -1, -1)), ("b", range(WINDOW))):
        cols = slice(0, h) if side == "f" else slice(h, 2 * h)
        gx, gh, gc = (np.zeros_like(net[f"{k}{side}"]) for k in "xhc")
        d = np.zeros((len(index), h), np.float32)
        for t in steps:
            before, gates, new, rec = trace[side, t]
            z, r = gates[:, :h], gates[:, h:]
            d = d + d_states[t][:, cols]
            d_new = d * z * (1 - new * new)
            d_all = np.concatenate([d * (new - before) * z * (1 - z), d_new * rec * r * (1 - r), d_new], 1)
            gx += inputs[index[:, t]].T @ d_all
            gc += d_all.sum(0)
            d_rec = np.concatenate([d_all[:, : 2 * h], d_new * r], 1)
            gh += before.T @ d_rec
            d = d * (1 - z) + d_rec @ net[f"h{side}"].T
        grad |= {f"x{side}": gx, f"h{side}": gh, f"c{side}": gc}
    return grad, float(np.mean(np.logaddexp(0, np.where(wanted > 0, -logit, logit))))


def fit(texts: list[str | None], labels: np.ndarray, base: float, rounds: int = 300, batch: int = 512, seed: int = 7) -> dict:
    """The model from a bounded list of texts and their labels (0 or 1)."""
    rng = np.random.default_rng(seed)
    labels = np.asarray(labels, float)
    if not len(texts) or labels.min() == labels.max():
        return {"base": base}
    column = pa.array([t or "" for t in texts], pa.string())
    slices, rows, words = [], 0, 0  # (first row, first word, what word_ids gives) of slices of the texts
    for part, data, offsets in text_slices([pa.record_batch([column], ["text"])]):
        found = word_ids(data, offsets)
        slices.append((rows, words, found))
        rows, words = rows + part.num_rows, words + len(found[1])

    def log_odds(size: int) -> np.ndarray:
        """Log of the toxic texts that hold a table place against as many as chance would give, smoothed.

        Places of words, or of pieces of `size` letters; each counts once per text.
        """
        toxic, clean = np.zeros(TABLE), np.zeros(TABLE)
        for row, _, (data, hashes, starts, ends, place, at) in slices:
            held = np.unique(np.repeat(np.arange(len(at) - 1), np.diff(at)) * (len(hashes) + 1) + place)
            of_row, word = np.divmod(held, len(hashes) + 1)
            if size:
                bucket, first = pieces(data, starts, ends, size)
                count = np.diff(first)[word]
                total = np.concatenate([[0], np.cumsum(count)])
                bucket = bucket[np.repeat(first[:-1][word] - total[:-1], count) + np.arange(total[-1])]
                of_row = np.repeat(of_row, count)
            else:
                bucket = (hashes % np.uint64(TABLE)).astype(np.int64)[word]
            of_row, bucket = np.divmod(np.unique(of_row * TABLE + bucket), TABLE)
            label = labels[row + of_row]
            toxic += np.bincount(bucket, label, TABLE)
            clean += np.bincount(bucket, 1 - label, TABLE)
        share = labels.sum() / (len(labels) - labels.sum())
        return np.clip(np.log((toxic + SMOOTH) / (clean * share + SMOOTH)), -4, 4).astype(np.float32)

    model = {"word": log_odds(0), "base": base} | {f"piece{size}": log_odds(size) for size in PIECES}
    inputs = np.concatenate([features(model, *f[:4])[:-1] for _, _, f in slices] + [np.zeros((1, INPUTS), np.float32)])
    parts = [windows(f[4] + word, f[5], len(inputs) - 1) for _, word, f in slices]
    index = np.concatenate([i for i, _ in parts]).astype(np.int32)
    first = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(f) for _, f in parts]))])
    of_window = np.repeat(np.arange(len(texts)), np.diff(first))

    def logits() -> np.ndarray:
        return np.concatenate([read_windows(net, *local(inputs, index[i:i + 4096])) for i in range(0, len(index), 4096)])

    suspicion = inputs[:, :1 + len(PIECES)].sum(1)[index].max(1)

    def highest(score: np.ndarray) -> np.ndarray:
        order = np.lexsort((score, of_window))
        return order[first[1:] - 1]

    net = start_weights(rng)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.items()}
    clean = np.flatnonzero(labels[of_window] == 0)
    for step in range(1, rounds + 1):
        if step % 100 == 1:
            top = highest(suspicion if step == 1 else logits())
            toxic, hard = top[labels == 1], top[labels == 0]
        chosen = np.concatenate([rng.choice(toxic, batch // 2), rng.choice(hard, batch // 4), rng.choice(clean, batch // 4)])
        grad, _ = gradients(net, *local(inputs, index[chosen]), labels[of_window[chosen]].astype(np.float32))
        for k, g in grad.items():
            m, v = moments[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            net[k] = (net[k] - 0.02 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    model |= net

    # a logistic curve over each text's highest window, each class weighted to its share of all labels
    x = np.maximum.reduceat(logits(), first[:-1]).astype(float)
    weight = np.where(labels == 1, base / labels.mean(), (1 - base) / (1 - labels.mean()))
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(slope * x + shift)
        g = np.array([(weight * (p - labels) * x).sum() + 1e-2 * slope, (weight * (p - labels)).sum()])
        s = weight * p * (1 - p) + 1e-6
        hess = np.array([[(s * x * x).sum() + 1e-2, (s * x).sum()], [(s * x).sum(), s.sum()]])
        move = np.linalg.solve(hess, g)
        slope, shift = slope - np.clip(move[0], -1, 1), shift - np.clip(move[1], -2, 2)
    return model | {"slope": max(slope, 0.0), "shift": shift}


def learned(model: dict) -> bool:
    """False for a model of labels of one kind, which knows a base rate only."""
    return "slope" in model


def score_slice(model: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    if not learned(model):
        return np.full(len(offsets) - 1, model["base"])
    data, hashes, starts, ends, place, at = word_ids(data, offsets)
    inputs = features(model, data, hashes, starts, ends)
    index, first = windows(place, at, len(hashes))
    logit = np.concatenate([read_windows(model, inputs, index[i:i + 4096]) for i in range(0, len(index), 4096)])
    return sigmoid(model["slope"] * np.maximum.reduceat(logit, first[:-1]).astype(float) + model["shift"])


def held_out(key: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    return F.pmod(F.crc32(F.col(key).cast("string")), F.lit(parts)) == part


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    toxic_rows: int = 1500, clean_rows: int = 2500, longest: int = 20_000,
) -> dict:
    """The model learned from `labels` (key, label), which the caller has cut to the rows it may learn from."""
    rows = labels.where(F.col(label).isin(0, 1)).select(F.col(key).alias("_id"), F.col(label).cast("int").alias("_label"))
    counted = {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    base = counted.get(1, 0) / max(1, sum(counted.values()))
    bounded = [
        rows.where(F.col("_label") == wanted).orderBy(F.xxhash64("_id"), "_id").limit(most)
        for wanted, most in ((1, toxic_rows), (0, clean_rows))
    ]
    sample = (
        docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
        .join(F.broadcast(bounded[0].unionByName(bounded[1])), "_id")  # at most toxic_rows + clean_rows rows
        .where(F.length("_text") <= longest).collect()
    )
    sample.sort(key=lambda r: (r["_id"], r["_text"]))
    model = fit([r["_text"] for r in sample], np.array([r["_label"] for r in sample]), base)
    del sample
    give_back()
    return model


def score(df: DataFrame, model: dict, text: str = "text", threshold: float = 0.3) -> DataFrame:
    """`df` with score (0 to 1) and predicted (1 if score >= threshold)."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # two tables of fixed size and some weights

    def run(batches):
        for batch, data, offsets in text_slices(batches, text):
            found = score_slice(shared.value, data, offsets)
            yield with_columns(batch, {
                "score": pa.array(found, pa.float64()), "predicted": pa.array((found >= threshold).astype(np.int32)),
            })

    return df.mapInArrow(run, schema_with(df, [
        T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()),
    ]))
