"""Exact dedup, n-gram join and their components against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from railmart.llm import exact, ngram_join
from railmart.llm.common import components


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def grouped(pairs, nodes):
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(least[a], least[b])
            if least[a] != m or least[b] != m:
                least[a] = least[b] = m
                changed = True
    return least


EDGES = [
    [], [(1, 1)], [(1, 2), (2, 1), (1, 2)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 51)],
    [(random.Random(5).randint(0, 60), random.Random(i).randint(0, 60)) for i in range(45)],
]


@pytest.mark.parametrize("edges", EDGES)
def test_components(spark, edges):
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    assert found == grouped([(a, b) for a, b in edges if a != b], nodes)


COPIES = [(1, "Aa b"), (2, "aA B"), (3, "Äa"), (4, "äa"), (5, None), (6, ""), (7, "aa b"), (7, "aa b"), (9, "x" * 70_000)]


@pytest.mark.parametrize("digest", [exact.sha256, lambda text: F.lit("one"), lambda text: F.length(text).cast("string")])
def test_exact_dedup_compares_texts_not_digests(texts, digest):
    found = exact.dedup(texts(COPIES), digest=digest).collect()
    want = {}
    for k, t in COPIES:
        want.setdefault(lower(t), []).append(k)
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in found) == sorted(
        (k, max(want[lower(t)]), len(want[lower(t)]), k == max(want[lower(t)])) for k, t in COPIES
    )
    assert all(r["note"] == "left alone" for r in found)


def test_exact_dedup_of_nothing(texts):
    assert exact.dedup(texts([])).count() == 0


def shingle_set(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def linked(rows, percent=80):
    sets = {}
    for k, t in rows:
        sets.setdefault(k, set()).add(shingle_set(t))
    pairs = [
        (a, b) for a in sets for b in sets if a < b
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b])
    ]
    return {k: max(map(len, s)) for k, s in sets.items()}, grouped(pairs, sets)


def edited(rng, words, share):
    return [rng.choice("qrstuvw") + str(rng.randint(0, 999)) if rng.random() < share else w for w in words]


def near_copies():
    rng = random.Random(2)
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one two"), (4, "ONE  two"), (5, "two one"), (6, "Ärger über alles hier und da")]
    passage = [f"p{i}" for i in range(40)]
    k = 10
    for group in range(12):
        base = [f"w{rng.randint(0, 300)}" for _ in range(rng.choice([5, 6, 8, 30, 90, 200]))]
        for _ in range(rng.randint(1, 9)):
            words = edited(rng, base, rng.choice([0, 0.005, 0.02, 0.05]))
            if rng.random() < 0.4:
                words = words + passage
            if rng.random() < 0.3:
                words = words[: int(len(words) * rng.uniform(0.75, 1))]
            rows.append((k, rng.choice([" ", "\n"]).join(words)))
            k += 1
    chain = [f"c{i}" for i in range(60)]
    for step in range(25):  # each links with the next, far ones do not
        rows.append((k, " ".join(chain)))
        chain[2 * step] = f"d{step}"
        k += 1
    rows.append((k - 1, rows[-1][1]))  # a repeated row
    rows.append((k, " ".join(passage) + " x" * 3000))
    return rows


@pytest.mark.parametrize("percent", [80, 60])
def test_ngram_join_finds_all_links(texts, percent):
    rows = near_copies()
    found = ngram_join.link(texts(rows), percent=percent).collect()
    sizes, least = linked(rows, percent)
    assert len(found) == len(rows)
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in found} == {(k, sizes[k], least[k]) for k, _ in rows}


def test_ngram_join_of_nothing(texts):
    assert ngram_join.link(texts([])).count() == 0
    assert [r["component_id"] for r in ngram_join.link(texts([(4, None)])).collect()] == [4]
    assert [r["component_id"] for r in ngram_join.link(texts([(4, "a b"), (3, "A b"), (3, "a")])).collect()] == [3, 3, 3]


def test_t_occurrence_against_counting():
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(200):
        query = np.unique(rng.integers(0, 80, rng.integers(1, 40)).astype(np.uint64))
        sets = []
        for _ in range(rng.integers(1, 12)):
            kept = query[rng.random(len(query)) < rng.uniform(0.6, 1)]
            extra = rng.integers(0, 200, rng.integers(1, 6)).astype(np.uint64)
            sets.append(np.unique(np.concatenate([kept, extra])))
        want = [
            i for i, s in enumerate(sets)
            if 100 * len(np.intersect1d(query, s)) >= 80 * len(np.union1d(query, s))
        ]
        assert sorted(ngram_join.t_occurrence(query, sets, 80)) == want


def test_near_copies_of_one_text_cost_few_searches(texts, monkeypatch):
    """Edits that leave some copies linked with the text, and others with nothing: no search of all pairs."""
    rng = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    rows = [(k, " ".join(edited(rng, base, rng.choice([0.007, 0.015, 0.03])))) for k in range(1, 160)] + [(500, " ".join(base))]
    searched, plain = [], ngram_join.search

    def search(pairs, *rest):
        searched.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(ngram_join, "search", search)
    found = {r["doc_id"]: r["component_id"] for r in ngram_join.link(texts(rows)).collect()}
    assert found == linked(rows)[1] and 60 < max(list(found.values()).count(c) for c in found.values()) < 150
    assert sum(searched) < 3 * len(rows)


def test_a_common_shingle_stands_out_of_full_counters():
    import numpy as np

    counters = np.random.default_rng(2).poisson(2000, 1 << 14)
    counters[[5, 700]] += [400, 100_000]
    level = ngram_join.rarity(counters)
    assert 0 < level[5] < level[700] and (level > 0).sum() < 20
