"""Spelling variants against all pairs of words."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from railmart.llm import queries, spelling

RUN = re.compile(r"[A-Za-zÀ-ÿ]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def counted(docs, slips=97, letters=5, count=3):
    found = Counter()
    for key, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(LOW)
            h = crc32(f"{'' if key is None else key}:{run}".encode())
            if slips and h % slips == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= letters:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= 2 * counts[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted(
        (w, counts[w], len(near[w]), form[w] or "", root(w), counts[form[w]] if form[w] else -1) for w in counts
    )


def ours(df):
    return sorted((r.word, r.n, r.n_near, r.form or "", r.root, -1 if r.form_n is None else r.form_n) for r in df.collect())


@settings(max_examples=300, deadline=None)
@given(st.sets(st.text(alphabet="abc", min_size=3, max_size=3), min_size=1), st.sets(st.text(alphabet="abc", min_size=4, max_size=4)), st.booleans())
def test_composition(short, long, at_end):
    found = list(spelling.pairs({w: (w, 1) for w in short}, {w: (w, 1) for w in long}, at_end))
    assert len(found) == len(set(found))
    want = {frozenset((a, b)) for a in short for b in short | long if a != b and one_edit(a, b)}
    if not at_end:
        want = {p for p in want if not any(b.startswith(a) for a in p for b in p if len(b) > len(a))}
    assert {frozenset((a[0], b[0])) for a, b in found} == want


@settings(max_examples=100, deadline=None)
@given(st.sets(st.text(alphabet="abc", min_size=5, max_size=5), min_size=1))
def test_acceptors_are_minimal(words):
    arcs, below, first = spelling.acceptor(sorted(words))
    starts = {w[:k] for w in words for k in range(6)}
    ends = {frozenset(w[len(x):] for w in words if w.startswith(x)) for x in starts}
    assert below[first] == len(words) and len(arcs) == len(ends)  # one state for each set of endings


def words_of(rng, many, size, letters="abé"):
    return {"".join(rng.choice(letters) for _ in range(rng.randint(5, size))) for _ in range(many)}


@pytest.mark.parametrize("limit", [spelling.LIMIT, 3])
def test_near_words_against_all_pairs(spark, limit):
    rng = random.Random(8)
    counts = {w: rng.choice([3, 4, 6, 9, 20, 50]) for w in words_of(rng, 250, 8)}
    counts |= {"q" * 40 + w: 3 + k for k, w in enumerate(sorted(words_of(rng, 60, 6)))}  # one long shared start
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert ours(spelling.grouped(words, limit=limit)) == plain(counts)


def test_partitions_stay_small(spark):
    rng = random.Random(9)
    words = spark.createDataFrame([("start" * 5 + w, 3) for w in sorted(words_of(rng, 600, 9, "abcdef"))], "word string, n long")
    sizes = spelling.partitioned(words, 5, 20).groupBy("s", "low", "high", "around").count()
    assert sizes.where("count > 20 AND high - low > 1").isEmpty()


def test_chains_of_forms(spark):
    counts = {"aaaaa" + "b" * k: 3 << k for k in range(20)}  # every word is the form of the one before
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = ours(spelling.grouped(words))
    assert found == plain(counts) and {r[4] for r in found} == {"aaaaa" + "b" * 19}


DOCS = [
    (1, "Hello hello HELLO hallo, hallo; hallö hallo"), (2, None), (2, ""), (3, "hello " * 400 + "hallo"), (3, "hello " * 400 + "hallo"),
    (None, "hello hellos hellos hellos ÀÉÎÕü ÀÉÎÕü àÉÎÕü ÀÉÎÕü 漢 abcd abcd abcd abcd"), (4, "x" * 30000), (4, "x" * 30000),
    (5, "x" * 30000 + " " + "x" * 30001), (6, ("x" * 30001 + " ") * 3),
]


def test_vocabulary_of_documents(spark, texts):
    for slips in (97, None, 3):
        want = counted(DOCS, slips)
        assert {r.word: r.n for r in spelling.vocabulary(texts(DOCS), slips=slips).collect()} == want
    assert spelling.vocabulary(texts([])).count() == 0
    assert spelling.grouped(spelling.vocabulary(texts([]))).count() == 0


def test_query(spark, tmp_path):
    rng = random.Random(10)
    kinds = sorted(words_of(rng, 120, 7))
    docs = DOCS + [(k, " ".join(rng.choice(kinds).title() for _ in range(60))) for k in range(10, 60)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op13_spelling(spark, str(tmp_path))
    assert found.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    assert ours(found) == plain(counted(docs))
