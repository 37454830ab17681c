"""Decontamination against windows compared one by one, and against its SQL."""

import random
import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from railmart.llm import contamination, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(docs, items, width=10):
    """(id, n_words, n_hit, items, hit substrings) of every document, by comparing every window with every place."""
    wanted = []
    for item, text in items:
        words = WORD.findall((text or "").translate(LOW))
        wanted += [(item, words[k:k + width]) for k in range(max(1, len(words) - width + 1)) if words]
    out = []
    for key, text in docs:
        spots = [(m.start(), m.end()) for m in WORD.finditer((text or "").translate(LOW))]
        words = [(text or "").translate(LOW)[a:b] for a, b in spots]
        hit, found = set(), set()
        for item, window in wanted:
            for k in range(len(words) - len(window) + 1):
                if words[k:k + len(window)] == window:
                    hit |= set(range(k, k + len(window)))
                    found |= {item} - {None}
        spans, last = [], None
        for k in sorted(hit):
            if last == k - 1:
                spans[-1] = (spans[-1][0], spots[k][1])
            else:
                spans.append(spots[k])
            last = k
        out.append((key, len(words), len(hit), sorted(map(str, found)), spans))
    return sorted(out, key=repr)


def ours(spark, texts, docs, items, **given):
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = contamination.mark(texts(docs), bench, **given).collect()
    assert all(r["note"] == "left alone" for r in rows)
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], [tuple(s) for s in r.spans]) for r in rows), key=repr)


LONG = "Q" * 70
ITEMS = [
    (1, "One two three four five six seven eight nine ten eleven twelve"), (2, "short Item"), (3, None), (4, " .,;"),
    (5, "three four five six seven eight nine ten ELEVEN twelve thirteen"), (5, "also five"), (None, "nameless words"),
    (2, "short item"), (11, f"{LONG} é漢 x"), (30, "b"), (4, "two three four five six seven eight nine ten eleven"),
]
DOCS = [
    (1, "ONE, two; three-four five\nsix seven eight nine ten eleven, thirteen"), (2, None), (2, ""), (3, "..."),
    (4, "one two three four five six seven eight nine"), (5, "a short\titem; Short item short"), (5, "a short\titem; Short item short"),
    (6, "nameless words here"), (7, f"é {LONG.lower()} é漢 X {LONG}"), (8, "bb b aab"), (None, "also FIVE and b"),
    (9, "😀 also five 😀"), (10, "w " * 30000 + "one two three four five six seven eight nine ten eleven twelve thirteen"),
    (11, "short"), (12, "item short item"),
]


@pytest.mark.parametrize("shard_bytes", [contamination.SHARD_BYTES, 200])
def test_against_windows(spark, texts, shard_bytes):
    assert ours(spark, texts, DOCS, ITEMS, shard_bytes=shard_bytes) == plain(DOCS, ITEMS)


def test_texts_do_not_run_together(spark, texts):
    items = [(1, "a b c"), (2, "c a")]
    docs = [(k, t) for k, t in enumerate(["a b", "c", "", "a b c a", None, "c", "a"] * 20)]
    assert ours(spark, texts, docs, items, width=2) == plain(docs, items, 2)


def test_empty_tables(spark, texts):
    assert ours(spark, texts, [], ITEMS) == []
    assert ours(spark, texts, DOCS, []) == plain(DOCS, [])
    assert ours(spark, texts, DOCS, [(1, None), (2, "?")]) == plain(DOCS, [])


def test_random_words(spark, texts):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice(["a", "B", "é", "cd"]) + rng.choice([" ", ", ", "\n"]) for _ in range(n))
    docs = [(k, text(rng.randint(0, 60))) for k in range(120)]
    items = [(k % 25, text(rng.randint(0, 9))) for k in range(40)]
    for shard_bytes in (contamination.SHARD_BYTES, 400):
        assert ours(spark, texts, docs, items, width=4, shard_bytes=shard_bytes) == plain(docs, items, 4)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aZ é0.\x00漢😀\x7f-", max_size=30), max_size=5))
def test_normalised_words(found):
    import numpy as np

    raw = [t.encode() for t in found]
    texts = contamination.Normalised(
        np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]).astype(np.int64)
    )
    shown = texts.string.encode("latin-1").decode()
    assert shown == "".join("\n" + "".join(f" {w}" for w in WORD.findall(t.translate(LOW))) + " " for t in found)


def test_clashing_columns_are_kept(spark):
    docs = spark.createDataFrame([(1, "a b", 1, 2, 3)], "doc_id long, text string, items_0 int, item int, window int")
    bench = spark.createDataFrame([(1, "a"), (2, "b")], "item_id long, text string")
    row = contamination.mark(docs, bench, shard_bytes=5).first()
    assert (row.items_0, row.item, row.window, row["items"], row.n_hit) == (1, 2, 3, ["1", "2"], 2)


def test_query_against_its_sql(spark, tmp_path):
    spark.createDataFrame([d for d in DOCS if len(d[1] or "") < 1000], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([i for i in ITEMS if i[0]], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = queries.op12_decontamination(spark, str(tmp_path))
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = duck.execute(queries.SQL["op12_decontamination"])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(found.columns)
    assert sorted(map(repr, want.fetchall())) == sorted(repr(tuple(r[n] for n in names)) for r in found.collect())
