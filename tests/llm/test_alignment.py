"""Alignment of tokenizers against a plain count over all token pairs."""

import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from railmart.llm import alignment, queries

with open(alignment.default_vocabulary(), encoding="utf-8") as a, open(alignment.default_pieces(), "rb") as b:
    BOTH = alignment.Tokenizers(a.read(), b.read())
LIBRARY = Tokenizer.from_file(alignment.default_vocabulary())
LIBRARY.encode_special_tokens = True


def byte_of(c):
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return ord(c) if ord(c) in plain else [n for n in range(256) if n not in plain][ord(c) - 256]


def tokens(text):
    """Ids and bytes of both sides, or nothing."""
    a = LIBRARY.encode(" " + text, add_special_tokens=False)
    b = BOTH.b.encode(text)
    a_bytes = [bytes(map(byte_of, t)) for t in a.tokens]
    b_bytes = [
        bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()
        for p in map(BOTH.b.IdToPiece, b)
    ]
    want = (" " + text).encode()
    if not text or b"".join(a_bytes) != want or b"".join(b_bytes) != want:
        return None
    return list(zip(a.ids, a_bytes)), list(zip(b, b_bytes))


def plain(docs):
    parts, held = [], Counter()
    for key, text in docs:
        found = tokens(text or "")
        if found is None:
            parts.append((key, None))
            continue
        spans = []
        for side in found:
            at, out = 0, []
            for i, data in side:
                out.append((i, at, at + len(data)))
                at += len(data)
            spans.append(out)
        links = Counter()
        for i, s, e in spans[0]:
            for j, t, f in spans[1]:
                if s < f and t < e:
                    links[i, j] += 1
        cut = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups = [[[], []] for _ in cut]
        for side in (0, 1):
            for i, _, e in spans[side]:
                groups[next(k for k, c in enumerate(cut) if e <= c)][side].append(str(i))
        line = ";".join("|".join(",".join(x) for x in g) for g in groups)
        parts.append((key, (len(found[0]), len(found[1]), len(cut), links, line)))
        held.update(links.keys())
    top = defaultdict(int)
    for (i, _), n in held.items():
        top[i] = max(top[i], n)
    out = []
    for key, part in parts:
        if part is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, cuts, links, line = part
        out.append((
            key, n_a, n_b, cuts, sum(links.values()), sum(m for p, m in links.items() if held[p] == top[p[0]]),
            sum(m * held[p] for p, m in links.items()), sha256(line.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def ours(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=repr)


DOCS = [
    (1, "Hello there, tokenizers"), (1, "Hello there, tokenizers"), (1, "another text of one id"), (2, None), (3, ""), (4, " "),
    (5, "  two  blanks\n\tand\ttabs "), (6, "漢字かな 😀😀 naïve über"), (7, "a<|endoftext|>b <s> </s> <unk> <0x41>"), (8, "piece ▁ mark"),
    (None, "no id at all"), (None, None), (9, "the the the the the the the the the " * 40), (10, "a\x00b"), (11, " x　y"), (12, "x" * 300),
]


@pytest.mark.parametrize("block_bytes", [alignment.BLOCK_BYTES, 60])
def test_against_all_pairs(spark, texts, block_bytes):
    assert ours(alignment.align(texts(DOCS).repartition(3), block_bytes=block_bytes)) == plain(DOCS)


def test_many_texts_in_blocks_that_do_not_matter(spark, texts):
    rng = random.Random(3)
    words = ["the", "theme", "tokens", "çalış", "漢字", "running", "12345", "\n\n", "unbelievable", "."]
    docs = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 25)))) for k in range(300)]
    want = plain(docs)
    assert ours(alignment.align(texts(docs))) == want
    assert ours(alignment.align(texts(docs), block_bytes=900)) == want
    assert alignment.align(texts([])).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_slices_keep_texts_apart(found):
    both = alignment.Aligned(BOTH, found)
    a, b, groups = both.numbers()
    digests = both.digests(BOTH.decimal)
    for k, text in enumerate(found):
        (_, n_a, n_b, n_groups, _, _, _, digest), = plain([(0, text)])
        assert (a[k], b[k], groups[k], digests[k]) == (n_a, n_b, n_groups, digest)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 90), st.lists(st.sets(st.integers(0, 89)), max_size=6))
def test_bitmaps_round_trip(texts, sets):
    sets = [sorted(x for x in s if x < texts) for s in sets]
    slot = np.array([k for k, s in enumerate(sets) for _ in s], np.int64)
    text = np.array([x for s in sets for x in s], np.int64)
    slots, sizes, sparse, bits = alignment.compressed(texts, slot, text)
    found = defaultdict(list)
    for x, k in zip(*alignment.members(texts, sizes, sparse, bits)):
        found[slots[k]].append(x)
    assert {k: sorted(v) for k, v in found.items()} == {k: s for k, s in enumerate(sets) if s}


def test_clashing_columns_and_query(spark, tmp_path):
    docs = spark.createDataFrame([(*d, 1, 2, 3) for d in DOCS], "doc_id long, text string, block int, pairs int, n int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert ours(alignment.align(docs)) == ours(queries.op11_alignment(spark, str(tmp_path))) == plain(DOCS)
