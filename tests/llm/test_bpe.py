"""BPE against the tokenizers library, and exact round trips."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from railmart.llm import bpe

LIBRARY = Tokenizer.from_file(bpe.default_vocabulary())
with open(bpe.default_vocabulary(), encoding="utf-8") as file:
    WORDS = bpe.Vocabulary(file.read())


def same(text):
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert WORDS.encode(text) == want
    assert WORDS.decode(want) == LIBRARY.decode(want, skip_special_tokens=False) == text


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_any_text(text):
    same(text)


@pytest.mark.parametrize("text", [
    "", " ", "\n\n  \t", "don't we'll I'M 'S ''s", "a<|endoftext|> b<|endoftext|>", "<|endoftext|", "x" * 500, "é" * 300,
    "ab" * 5000, "٣٤٥ 漢字かな 😀😀 \u0085 ﻿", " the  the   the", "\x1c\x1d a\x00b",
])
def test_edges(text):
    same(text)


def test_both_ways_to_merge_agree():
    rng = random.Random(4)
    for _ in range(200):
        data = "".join(rng.choice("thanderiso é") for _ in range(rng.randint(1, 120))).encode()
        assert WORDS.by_scan(data) == WORDS.by_heap(data)


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 4)
    with open(bpe.default_vocabulary(), encoding="utf-8") as file:
        few = bpe.Vocabulary(file.read())
    for text in ["one two three four five six seven", "six seven eight one two nine ten", "eleven two six ten"]:
        assert few.encode(text) == LIBRARY.encode(text).ids


ROWS = [(1, "Hello there"), (1, "Hello there"), (2, None), (3, ""), (4, "tok " * 9000)]


def test_columns_and_rows_stay(texts):
    encoded = bpe.encode(texts(ROWS))
    found = bpe.decode(encoded).collect()
    assert len(found) == len(ROWS) and all(r["note"] == "left alone" for r in found)
    for r in found:
        want = LIBRARY.encode(r["text"] or "").ids
        assert r["ids"] == want and r["n_tokens"] == len(want) and r["decoded"] == (r["text"] or "")
    assert bpe.encode(texts([])).count() == 0 and bpe.round_trip(texts([])).count() == 0


def test_round_trip_digests(texts):
    from hashlib import sha256

    for r in bpe.round_trip(texts(ROWS)).collect():
        text = dict(ROWS)[r["doc_id"]] or ""
        ids = LIBRARY.encode(text).ids
        assert r["ids_sha256"] == sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == sha256(text.encode()).hexdigest() and r["n_tokens"] == len(ids)
