"""Rows that share an id, rows without id and columns called like helpers, in chunk, line and suffix dedup."""

import random

from pyspark.sql import functions as F

from railmart.llm import chunks, lines, suffixes


def words(seed, n):
    rng = random.Random(seed)
    return "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))


A, B, C = words(1, 1500), words(2, 1500), words(3, 1500)
HELPERS = ["id", "row", "_id", "_row", "spans", "dropped", "gone", "key", "start"]


def with_helpers(df):
    return df.withColumns({name: F.lit(f"own {name}") for name in HELPERS})


def test_chunks_of_rows_that_share_an_id(texts):
    rows = [(1, A), (5, A), (5, B), (None, A), (None, C)]
    found = chunks.dedup(with_helpers(texts(rows)), tails=True).collect()
    got = {(r["doc_id"], r["text"]): (r["kept_text"], r["n_removed"], r["first_id"]) for r in found}
    assert got == {
        (1, A): (A, 0, None), (5, A): ("", 1500, 1), (5, B): (B, 0, None), (None, A): ("", 1500, 1), (None, C): (C, 0, None),
    }
    assert all(r[name] == f"own {name}" for r in found for name in HELPERS)


def test_chunks_of_one_row_stay_when_all_have_one_id(texts):
    rows = [(7, A + B), (7, A + C), (None, B + A)]
    found = chunks.dedup(texts(rows)).collect()
    kept = sum(len(r["kept_text"]) for r in found)
    assert 4500 <= kept < 7000 and sum(r["n_removed"] for r in found) == 9000 - kept
    assert {r["first_id"] for r in found if r["n_removed"]} == {7}


def test_suffixes_of_rows_that_share_an_id(texts):
    rows = [(1, A), (1, B), (2, A), (None, C + A[:500]), (None, None), (3, C[:300])]
    found = suffixes.dedup(with_helpers(texts(rows)), length=400).collect()
    got = {(r["doc_id"], r["text"]): (bytes(r["kept"]).decode(), r["n_removed"], r["n_spans"]) for r in found}
    assert got == {
        (1, A): ("", 1500, 1), (1, B): (B, 0, 0), (2, A): ("", 1500, 1), (None, C + A[:500]): (C, 500, 1),
        (None, None): ("", 0, 0), (3, C[:300]): (C[:300], 0, 0),
    }
    assert all(r[name] == f"own {name}" for r in found for name in HELPERS)


def test_equal_rows_repeat_each_other_in_suffixes(texts):
    found = suffixes.dedup(texts([(1, A), (1, A), (None, B), (None, B)]), length=400).collect()
    assert [r["n_removed"] for r in found] == [1500] * 4


def test_lines_of_rows_that_share_an_id(texts):
    one, other, own = words(4, 60), words(5, 60), words(6, 60)
    rows = [(1, one), (2, one), (2, f"{other}\n{own}"), (None, f"{one}\nnobody else"), (None, None), (3, other)]
    found = lines.dedup(with_helpers(texts(rows)), distance=None).collect()
    got = {(r["doc_id"], r["text"]): (r["kept_text"], r["n_dropped"]) for r in found}
    assert got == {
        (1, one): (one, 0), (2, one): ("", 1), (2, f"{other}\n{own}"): (f"{other}\n{own}", 0),
        (None, f"{one}\nnobody else"): ("nobody else", 1), (None, None): (None, 0), (3, other): ("", 1),
    }
    assert all(r[name] == f"own {name}" for r in found for name in HELPERS)
