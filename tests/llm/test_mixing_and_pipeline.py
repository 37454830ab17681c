"""Mixing against a plain computation, every query against its SQL, and the pipeline's stages against brute force."""

import importlib
import math
import random
import re
from collections import Counter

import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import check_queries
import corpus_pipeline
from railmart.llm import bpe, mixing
from railmart.llm.queries import QUERIES, SQL
from tests.llm.test_exact_and_ngrams import linked

SMALL = "/root/testdata/sf0.001"


def corpus(n=400, seed=4):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        source = rng.choice(["big"] * 12 + ["mid"] * 4 + ["small", None])
        rows.append((k, " ".join("w" * rng.randint(1, 5) for _ in range(rng.randint(0, 60))), source))
    return rows + [(n, None, "big"), (n + 1, "", "empty"), (n + 2, "a b", "small"), (n + 2, "c", "small")]


def table(spark, rows):
    return spark.createDataFrame([(*r, 1.5) for r in rows], "doc_id long, text string, source string, epoch double")


def totals(rows):
    out = Counter()
    for _, t, s in rows:
        out[s or ""] += len((t or "").split())
    return {s: n for s, n in out.items() if n}


def weights(total, x):
    everything = sum(total.values())
    power = {s: (n / everything) ** x for s, n in total.items()}
    return {s: p / sum(power.values()) for s, p in power.items()}


def bisect(total, fits):
    low, high = 0.0, 1.0
    for _ in range(mixing.STEPS):
        middle = (low + high) / 2
        low, high = (low, middle) if fits(weights(total, middle)) else (middle, high)
    return high


@pytest.mark.parametrize("how", [{"repeats": 1.5}, {"repeats": 4.0}, {"entropy": 1.0}, {"entropy": 5.0}, {"repeats": 3.0, "budget": 2000}])
def test_mixing_meets_its_target(spark, how):
    rows = corpus()
    total = totals(rows)
    budget = how.get("budget", sum(total.values()))
    if "repeats" in how:
        want = bisect(total, lambda w: all(budget * w[s] / total[s] <= how["repeats"] for s in w))
    else:
        want = bisect(total, lambda w: -sum(p * math.log(p) for p in w.values()) <= how["entropy"])
    w = weights(total, want)
    drawn = mixing.draw(table(spark, rows), block_tokens=500, **how).collect()
    got, size = Counter(), {}
    for k, t, s in rows:
        size[k] = size.get(k, 0) + len((t or "").split())
    for r in drawn:
        assert r["n_tokens"] == size[r["doc_id"]]
        got[r["source"]] += r["n_tokens"]
    for s, n in total.items():
        quota = round(budget * w[s])
        assert quota - max(size.values()) <= got[s] <= quota
    times = Counter((r["source"], r["epoch"], r["doc_id"]) for r in drawn)
    assert set(times.values()) == {1}  # no document twice in an epoch
    for s, n in total.items():
        whole = round(budget * w[s]) // n
        ids = {k for k, _, x in rows if (x or "") == s}
        for epoch in range(whole):
            assert {r["doc_id"] for r in drawn if r["source"] == s and r["epoch"] == epoch} == ids
    places = Counter((r["source"], r["epoch"], r["block_rank"], r["place"]) for r in drawn)
    assert set(places.values()) == {1}


def test_epochs_are_permuted_anew(spark):
    drawn = mixing.draw(table(spark, corpus()), block_tokens=500, repeats=6.0).where("source = 'small'").collect()
    order = {
        e: [r["doc_id"] for r in sorted(drawn, key=lambda r: (r["block_rank"], r["place"])) if r["epoch"] == e] for e in (0, 1)
    }
    assert sorted(order[0]) == sorted(order[1]) and order[0] != order[1]


def test_realise_repeats_rows_whole(spark):
    rows = corpus()
    docs = table(spark, rows)
    drawn = Counter(r["doc_id"] for r in mixing.draw(docs, repeats=1.5).collect())
    found = mixing.realise(docs, repeats=1.5)
    assert found.columns == docs.columns
    of_id = Counter(k for k, *_ in rows)
    assert Counter(r["doc_id"] for r in found.collect()) == Counter({k: n * of_id[k] for k, n in drawn.items()})


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "", "a"), (2, " ", "b")]])
def test_mixing_of_nothing(spark, rows):
    assert mixing.draw(table(spark, rows), repeats=2.0).count() == 0


def test_mixing_wants_one_target(spark):
    with pytest.raises(ValueError):
        mixing.draw(table(spark, corpus(5)))


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_against_their_sql(spark, name):
    assert check_queries.compare(spark, SMALL, name, SQL[name]).startswith("ok")


def test_each_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 11))
    assert QUERIES.keys() | {"pipeline"} <= entry_points.queries().keys()


@pytest.mark.parametrize("name", ["op4_line_dedup", "op7_exact_dedup", "op8_mixing"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / name))
        seen[name] = (docs.collect(), (docs := spark.read.parquet(str(tmp_path / name))).collect())
    before, after = seen["toxicity"]
    assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before} and len(after) > 0.8 * len(before)
    before, after = seen["line dedup"]
    text = {r["doc_id"]: r["text"].split("\n") for r in before}
    assert all(set(r["text"].split("\n")) <= set(text[r["doc_id"]]) and r["n_chars"] == len(r["text"]) for r in after)
    before, after = seen["n-gram Jaccard join"]
    _, least = linked([(r["doc_id"], r["text"]) for r in before])
    assert sorted(r["doc_id"] for r in after) == sorted(set(least.values()))
    before, after = seen["mixing"]
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}
    before, after = seen["bpe"]
    library = Tokenizer.from_file(bpe.default_vocabulary())
    ids = {r["doc_id"]: library.encode(r["text"]).ids for r in before}
    assert len(after) == len(before) and all(r["ids"] == ids[r["doc_id"]] and r["exact"] for r in after)


def test_pipeline_of_odd_rows(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "one two", "en", "a", 7), (3, "one two", "en", "a", 7)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    spark.createDataFrame([(3, 0), (8, 1)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in found} <= {1, 2, 3} and any(r["doc_id"] == 3 and r["exact"] for r in found)


def test_entry_works_without_the_text_operators(monkeypatch):
    import sys

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    try:
        module = importlib.reload(entry_points)
        assert "pipeline" not in module.queries() and "fact_corridor" in module.queries()
    finally:
        monkeypatch.undo()
        importlib.reload(entry_points)
