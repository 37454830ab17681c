"""Chunk dedup takes a copy's short last chunk too."""

import random

from railmart.llm import chunks, queries


def test_exact_copies_lose_all_their_bytes(spark, tmp_path):
    rng = random.Random(2)
    long = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randint(1, 900))) for _ in range(60)]
    base = dict(enumerate([*long, "kurz", "x", "other"]))
    rows = [*base.items(), *((100 + k, t) for k, t in base.items()), (300, None), (301, "")]
    tailed = [t for t in long if len(t.encode()) > 40 for e in [chunks_of(t)] if e[-1] - ([0] + e)[-2] < chunks.LEAST]
    assert len(tailed) > 5
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = {r["doc_id"]: r for r in queries.op6_chunk_dedup(spark, str(tmp_path)).collect()}
    assert len(found) == len(rows)
    for k, t in base.items():
        assert found[100 + k]["n_removed"] == len(t.encode()) and found[100 + k]["n_shared"] > 0
        assert found[100 + k]["first_id"] == k and found[k]["n_removed"] == 0


def chunks_of(text):
    import numpy as np

    data = np.frombuffer(text.encode(), np.uint8)
    return chunks.cuts(data, np.array([0, len(data)]))[0]


def test_texts_that_only_end_alike_keep_their_ends(texts):
    rng = random.Random(4)
    own = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(100, 500))) + "." for _ in range(80)]
    found = chunks.dedup(texts(list(enumerate(own))), tails=True).collect()
    assert all(r["kept_text"] == own[r["doc_id"]] and r["n_shared"] == 0 for r in found)
