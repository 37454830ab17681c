"""Toxicity and quality: gradients, held-out accuracy, calibration, and edges."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from railmart.llm import quality, toxicity
from railmart.llm.common import text_slices

SF = "/root/testdata/sf0.1"


def slices(texts, limit=1 << 20):
    return [(d, o) for _, d, o in text_slices([pa.record_batch([pa.array(texts, pa.string())], ["text"])], limit=limit)]


def test_gradients_are_those_of_finite_differences():
    rng = np.random.default_rng(0)
    net = {k: v.astype(float) for k, v in toxicity.start_weights(rng).items()}
    inputs = rng.normal(size=(30, toxicity.INPUTS))
    inputs[-1] = 0
    index = rng.integers(0, 30, (5, toxicity.WINDOW))
    index[2, 3:] = 29
    index[3] = 29
    wanted = np.array([1, 0, 1, 0, 1], float)
    grad, _ = toxicity.gradients(net, inputs, index, wanted)
    for name, values in net.items():
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in values.shape)
            old, change = values[at], 1e-2
            values[at] = old + change
            up = toxicity.gradients(net, inputs, index, wanted)[1]
            values[at] = old - change
            down = toxicity.gradients(net, inputs, index, wanted)[1]
            values[at] = old
            assert abs((up - down) / 2 / change - grad[name][at]) < 2e-3, name


def test_windows_cover_every_word_and_overlap():
    for words in [0, 1, 7, 8, 9, 16, 17, 24, 25, 100, 333]:
        place, at = np.arange(words) + 5, np.array([0, 0, words])
        index, first = toxicity.windows(place, at, 1000)
        own = index[first[1]:first[2]]
        assert first[1] == 1 and (index[0] == 1000).all()
        assert set(own[own != 1000]) == set(place)
        for a, b in zip(own, own[1:]):
            assert (a[toxicity.STRIDE:] == b[: toxicity.WINDOW - toxicity.STRIDE]).all()


def test_words_are_runs_of_letters():
    text = ["Ab1 cd-EF é_x", "", "x" * 5000 + " y"]
    data, offsets = slices(text, 1 << 30)[0]
    data, hashes, starts, ends, place, at = toxicity.word_ids(data, offsets)
    words = [bytes(data[starts[p]:ends[p]]).decode() for p in place]
    want = [re.findall(r"[^\W\d_]+", t.lower()) for t in text]
    assert [words[a:b] for a, b in zip(at, at[1:])] == want and len(set(hashes)) == len({w for x in want for w in x})


def made_up(n, seed):
    rng = random.Random(seed)
    common = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(200)]
    rows = []
    for k in range(n):
        words = [rng.choice(common) for _ in range(rng.randint(3, 150))]
        toxic = rng.random() < 0.2
        if toxic:
            words.insert(rng.randint(0, len(words)), rng.choice(["zzscum", "zzvile" + rng.choice("aeiou"), "zzrotten"]))
        rows.append((k, " ".join(words), int(toxic)))
    return rows


def test_toxicity_finds_planted_words(spark, texts):
    rows = made_up(700, 3)
    docs = texts([(k, t) for k, t, _ in rows])
    labels = spark.createDataFrame([(k, y) for k, _, y in rows if k < 500] + [(1, None), (9999, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    found = toxicity.score(docs, model).collect()
    held = [(r["predicted"], rows[r["doc_id"]][2]) for r in found if r["doc_id"] >= 500]
    assert len(found) == 700 and sum(p == y for p, y in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["note"] == "left alone" for r in found)


@pytest.mark.parametrize("labels,score", [([], 0.0), ([(1, 1), (2, 1)], 1.0), ([(1, 0)], 0.0)])
def test_without_both_labels_all_score_the_base_rate(spark, texts, labels, score):
    docs = texts([(1, "a b"), (2, None), (2, None), (3, "")])
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, table)
    assert [r["score"] for r in toxicity.score(docs, model).collect()] == [score] * 4
    stats = quality.described(docs, "doc_id", "text")
    model = quality.train(stats, table, label="toxic")
    assert [r["score"] for r in quality.score(stats, model).collect()] == [score] * 4


def test_scores_of_odd_texts(texts):
    rows = [(1, None), (2, ""), (3, "!!! 123"), (4, "word " * 60_000), (5, "word"), (5, "word")]
    model = toxicity.fit([t for _, t, _ in made_up(120, 1)], np.array([y for *_, y in made_up(120, 1)]), 0.2)
    found = sorted((r["doc_id"], r["score"]) for r in toxicity.score(texts(rows), model).collect())
    assert len(found) == 6 and found[0][1] == found[1][1] == found[2][1] and found[4] == found[5]
    assert toxicity.score(texts([]), model).count() == 0


def slow_statistics(text):
    data, words = text.encode(), re.findall(rb"[^\x20\x09-\x0d]+", text.encode())
    kind = [0] * 8
    for b in data:
        kind[quality.CLASS[b]] += 1
    n, w = max(1, len(data)), max(1, len(words))
    lines = [x for x in data.split(b"\n") if x]
    length = [len(x) for x in words]
    mean = sum(length) / w
    low = [bytes(b + 32 if 65 <= b <= 90 else b for b in x) for x in words]
    return [
        np.log1p(len(data)), np.log1p(len(words)), mean, np.sqrt(max(0, sum(x * x for x in length) / w - mean**2)),
        *(k / n for k in kind), sum(a == b for a, b in zip(low, low[1:])) / w, len(set(low)) / w,
        sum(quality.CLASS[x[0]] == 2 for x in words) / w, sum(quality.CLASS[x[-1]] == 0 for x in words) / w,
        sum(x >= 20 for x in length) / w, np.log1p(sum(map(len, lines)) / max(1, len(lines))),
        sum(quality.CLASS[x[-1]] == 6 for x in lines) / max(1, len(lines)),
        sum(len(x) == 1 and quality.CLASS[x[0]] == 0 for x in words) / w,
    ]


def test_statistics_against_a_slow_count():
    texts = ["", " ", "One two, two TWO.\nThree | 4 €\n\n" + "x" * 30, "é\n", "a" * 3000, "\n\n", "Tab\tand\x0bmore?"]
    (data, offsets), = slices(texts)
    assert np.allclose(quality.statistics(data, offsets), [slow_statistics(t) for t in texts])
    again = np.concatenate([quality.statistics(d, o) for d, o in slices(texts, 1)])
    assert np.allclose(again, [slow_statistics(t) for t in texts])


def test_isotonic_is_the_best_rising_curve():
    rng = np.random.default_rng(2)
    for _ in range(50):
        total = rng.integers(1, 5, 8).astype(float)
        good = np.floor(rng.random(8) * (total + 1))
        at, level = quality.isotonic(np.arange(8.0), good, total)
        assert (np.diff(level) > 0).all() and (np.diff(at) > 0).all()
        share = good / total
        best = [  # the max-min formula
            max(min((good[a:b + 1].sum() / total[a:b + 1].sum()) for b in range(i, 8)) for a in range(i + 1)) for i in range(8)
        ]
        assert np.allclose(sorted(set(np.round(best, 9))), np.round(level, 9)) and share.shape == (8,)


@pytest.mark.parametrize("name,column,good", [("op1_toxicity", "toxic", 0.97), ("op5_quality", "quality", 0.97)])
def test_held_out_accuracy(spark, name, column, good):
    from railmart.llm.queries import QUERIES

    found = QUERIES[name](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").toPandas()
    hit = (found["predicted"] == found[column]).mean()
    order = found["score"].rank()
    ones = found[column] == 1
    area = (order[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())
    assert hit >= good - 0.02 and area >= 0.9 and len(found) > 300
