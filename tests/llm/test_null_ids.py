"""Null ids, and ids whose rows hold different texts, in the n-gram join and the mix."""

from railmart.llm import mixing, ngram_join

A = " ".join(f"a{i}" for i in range(60))
B = " ".join(f"b{i}" for i in range(60))
C = " ".join(f"c{i}" for i in range(60))


def test_null_ids_and_ids_of_several_texts(texts):
    rows = [
        (None, A), (None, None), (None, "alone here"), (8, A + " end"),
        (1, C), (5, B), (5, C), (6, B), (7, B + " end"), (9, None), (9, ""),
    ]
    found = ngram_join.link(texts(rows)).collect()
    got = sorted((repr(r["doc_id"]), r["text"] or "", r["component_id"], r["n_shingles"]) for r in found)
    want = [
        (None, A, 8, 56), (None, "", None, 0), (None, "alone here", None, 1), (8, A + " end", 8, 57),
        (1, C, 1, 56), (5, B, 1, 56), (5, C, 1, 56), (6, B, 1, 56), (7, B + " end", 1, 57), (9, "", 9, 0), (9, "", 9, 0),
    ]
    assert got == sorted((repr(k), *rest) for k, *rest in want)


def test_the_mix_never_draws_a_null_id(spark):
    docs = spark.createDataFrame([(None, "a b", "s"), (1, "c d", "s"), (2, "e", "s")], "doc_id long, text string, source string")
    found = mixing.draw(docs, repeats=1.0).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in found) == [(1, 2), (2, 1)]
