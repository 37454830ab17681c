"""Chunk, line and suffix dedup and phrase fingerprints against brute force."""

import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
import xxhash

from railmart.llm import chunks, lines, phrases, suffixes


def plain_chunks(data, least, most):
    """A rolling gear hash, byte by byte."""
    gear, h, last, out = chunks.GEAR.tolist(), 0, 0, []
    for i, byte in enumerate(data):
        h = (2 * h + gear[byte]) & 0xFFFF
        size, inside = i + 1 - last, i + 1 < len(data) and data[i + 1] & 0xC0 == 0x80
        if not inside and (h >> 10 == 0 and size >= least or size >= most):
            out.append((last, i + 1))
            last = i + 1
    return out + [(last, len(data))] if last < len(data) else out


def passages(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéß ") for _ in range(rng.randint(2, 9)))
    shared = [" ".join(word() for _ in range(120)) for _ in range(3)]
    rows = [(0, None), (1, ""), (2, "kurz"), (3, "é" * 2000), (4, "ab" * 700), (5, "\x00" * 1000)]
    for k in range(6, 60):
        own = [" ".join(word() for _ in range(rng.randint(0, 90))) for _ in range(2)]
        middle = rng.choice(shared) if rng.random() < 0.6 else ""
        cut = rng.randint(0, 200)
        rows.append((k, own[0] + middle[cut:] + own[1]))
    return rows + [(60, rows[20][1]), (61, rows[20][1]), (61, rows[20][1])]


def test_chunks_against_a_rolling_hash(texts):
    rows = passages(1)
    by_digest, cut = defaultdict(set), {}
    for k, t in rows:
        data = (t or "").encode()
        cut[k] = (data, plain_chunks(data, chunks.LEAST, chunks.MOST))
        for a, b in cut[k][1]:
            if b - a >= chunks.LEAST:
                by_digest[data[a:b]].add((k, a))
    found = chunks.dedup(texts(rows)).collect()
    assert len(found) == len(rows)
    lost = 0
    for r in found:
        data, parts = cut[r["doc_id"]]
        stays = [(a, b) for a, b in parts if b - a < chunks.LEAST or min(by_digest[data[a:b]]) == (r["doc_id"], a)]
        left = b"".join(data[a:b] for a, b in stays)
        assert r["kept_text"] == left.decode() and r["n_bytes"] == len(data) and r["n_removed"] == len(data) - len(left)
        assert r["n_repeated"] == len(parts) - len(stays)
        assert r["n_shared"] == sum(
            b - a >= chunks.LEAST and len({k for k, _ in by_digest[data[a:b]]}) > 1 for a, b in parts
        )
        lost += r["n_repeated"]
    assert lost > 20 and chunks.dedup(texts([])).count() == 0


def removed_bytes(rows, length):
    data = {k: (t or "").encode() for k, t in rows}
    seen = Counter(d[i:i + length] for k, t in rows for d in [(t or "").encode()] for i in range(len(d) - length + 1))
    gone = {k: np.zeros(len(d) + 1, bool) for k, d in data.items()}
    for k, d in data.items():
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[k][i:i + length] = True
    return data, gone


@pytest.mark.parametrize("shard_bytes", [3000, 1 << 21])
def test_suffixes_against_counting(texts, shard_bytes):
    rows, length = passages(2), 60
    data, gone = removed_bytes(rows, length)
    found = suffixes.dedup(texts(rows), length=length, shard_bytes=shard_bytes).collect()
    assert len(found) == len(rows)
    for r in found:
        d, g = data[r["doc_id"]], gone[r["doc_id"]]
        assert bytes(r["kept"]) == bytes(b for b, x in zip(d, g) if not x)
        assert (r["n_bytes"], r["n_removed"]) == (len(d), int(g.sum()))
        assert r["n_spans"] == int((g[:-1] & ~np.append(False, g[:-1])[: len(d)]).sum())
    assert suffixes.dedup(texts([])).count() == 0


def test_suffix_array_and_common_prefixes():
    rng = random.Random(0)
    for _ in range(300):
        text = bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randint(1, 90)))
        array = np.frombuffer(text, np.uint8)
        sa = suffixes.suffix_array(array)
        assert sa.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        for r, shared in enumerate(suffixes.common_prefixes(array, sa)):
            a, b = (text[sa[r - 1]:], text[sa[r]:]) if r else (b"", b"")
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared == n


def simhash(line):
    votes, words = [0] * 64, line.split(" ")
    for a, b in zip(words, [*words[1:], None]):
        h = xxhash.xxh64_intdigest(a.encode(), 42)
        h = h if b is None else xxhash.xxh64_intdigest(b.encode(), h)
        for i in range(64):
            votes[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * votes[i] > len(words))


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def line_rows():
    rng = random.Random(8)
    base = [" ".join(f"{rng.choice('abcdefgh')}{rng.randint(0, 99)}" for _ in range(rng.randint(1, 60))) for _ in range(25)]
    rows = [(0, None), (1, ""), (2, "\n \n"), (3, "  Once \n\nonce\nTWICE")]
    for k in range(4, 60):
        out = []
        for _ in range(rng.randint(1, 6)):
            words = rng.choice(base).split(" ")
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                words[rng.randrange(len(words))] += rng.choice("xyz")
            out.append(rng.choice(["", "  "]) + " ".join(words))
        rows.append((k, "\n".join(out)))
    return rows


def test_lines_against_all_pairs(texts):
    rows = line_rows()
    clean = lambda x: x.strip(" \t\r\x0b\x0c").lower()
    distinct = sorted({clean(x) for _, t in rows for x in (t or "").split("\n") if clean(x)})
    hashes = [simhash(x) for x in distinct]
    group = list(range(len(distinct)))
    for i in range(len(distinct)):
        for j in range(i):
            a, b = distinct[i], distinct[j]
            if (hashes[i] ^ hashes[j]).bit_count() <= 3 and edits(a, b) <= int(max(len(a), len(b)) * 0.2):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    assert len(set(group)) < len(distinct)
    met, want = set(), {}
    for k, t in sorted(rows, key=lambda r: r[0]):
        kept = []
        for x in (t or "").split("\n"):
            g = group[distinct.index(clean(x))] if clean(x) else None
            if g is None or g not in met:
                kept.append(x)
            met.add(g)
        want[k] = "\n".join(kept) if t is not None else None
    found = lines.dedup(texts(rows)).collect()
    assert {r["doc_id"]: r["kept_text"] for r in found} == want
    assert all(r["n_lines"] == len((t or "").split("\n")) * (t is not None) for r in found for t in [dict(rows)[r["doc_id"]]])
    assert lines.dedup(texts([])).count() == 0


def test_long_lines_and_hot_lines(texts):
    rng = random.Random(3)
    long = [f"w{rng.randint(0, 5000)}" for _ in range(9000)]
    other = long.copy()
    other[4000] = "changed"
    rows = [(0, " ".join(long)), (1, " ".join(other))] + [(k, "the same\nown " + str(k)) for k in range(2, 80)]
    found = {r["doc_id"]: r["n_dropped"] for r in lines.dedup(texts(rows)).collect()}
    assert found[0] == 0 and found[1] == 1 and found[2] == 0 and all(found[k] >= 1 for k in range(3, 80))


def test_line_dedup_runs_no_python(texts):
    plan = lines.dedup(texts([(1, "a b\na b")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def phrase_set(data):
    known, word = set(), b""
    for i in range(len(data)):
        word += data[i:i + 1]
        if word not in known:
            known.add(word)
            word = b""
    return known


def test_phrases_are_those_of_a_plain_parser():
    rng = random.Random(6)
    for _ in range(60):
        text = "".join(rng.choice("ab é") for _ in range(rng.randint(0, 200)))
        data, ends, start = text.encode(), [], 0
        node = phrases.parse(data, {}, 0, ends, 0)
        found = set()
        for end in ends:
            found.add(data[start:end])
            start = end
        assert found == phrase_set(data) and (node == 0) == (start == len(data))
        assert phrases.Parsed(text).signature.tolist() == phrases.signature(data, ends).tolist()


@pytest.mark.parametrize("rows", [
    [], [(5, "alone")], [(1, None), (2, ""), (2, ""), (9, "x é" * 500), (None, "no id"), (4, "😀😀😀ab")],
    [(k, f"text {k % 7} " * (k % 5)) for k in range(300)],
])
def test_neighbours(texts, rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is not None, r[1] or ""))
    want = []
    for i, (k, t) in enumerate(order):
        t, following = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[:len(t) - half] + following[:half]
        own, next_one, edit = (phrases.fingerprint(x) for x in (t, following, edited))
        want.append((
            str(k), len(t), sha256(edited.encode()).hexdigest(), own, edit,
            phrases.likeness_of(own, edit), phrases.likeness_of(own, next_one),
        ))
    found = phrases.neighbours(texts(rows)).collect()
    assert sorted((str(r[0]), *r[1:]) for r in found) == sorted(want)


def test_likeness_follows_what_texts_share():
    rng = random.Random(1)
    a = "".join(rng.choice("abcdefghij ") for _ in range(4000))
    b = "".join(rng.choice("abcdefghij ") for _ in range(4000))
    like = [phrases.likeness_of(phrases.fingerprint(a), phrases.fingerprint(x)) for x in (a, a[:3900] + b[:100], a[:2000] + b[:2000], b)]
    assert like[0] == 1 and like[0] > like[1] > like[2] > like[3]
