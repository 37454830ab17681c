"""Memory of the driver after a training."""

import re
from pathlib import Path

import pytest

from railmart.llm import toxicity
from railmart.llm.common import give_back

ROLLUP = Path("/proc/self/smaps_rollup")


def held():
    return int(re.search(r"\nPss_Anon:\s+(\d+)", ROLLUP.read_text())[1]) // 1024


@pytest.mark.skipif(not ROLLUP.exists(), reason="reads Linux's account of memory")
def test_what_was_freed_goes_back_to_the_system():
    parts = [bytes(bytearray(1 << 16)) for _ in range(3200)]  # 200 MB in parts below the size that is mapped by itself
    last, full = parts.pop(), held()
    del parts
    give_back()
    assert held() < full - 100 and len(last) == 1 << 16


def test_a_training_gives_its_memory_back(spark, monkeypatch):
    called = []
    monkeypatch.setattr(toxicity, "give_back", lambda: called.append(1))
    docs = spark.createDataFrame([(1, "plain words"), (2, "bad words")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, toxic int")
    assert toxicity.learned(toxicity.train(docs, labels)) and called
