import hashlib
import random

import numpy as np
import pytest

from stockflow.llm.suffix_dedup import common_prefixes, remove_repeats, segments, suffix_array


def brute(rows, length):
    seen = {}
    for i, t in rows:
        key = 1 << 70 if i is None else i
        for a in range(len(t) - length + 1):
            s = t[a:a + length]
            seen[s] = min(seen.get(s, (key, a)), (key, a))
    out = []
    for i, t in rows:
        key = 1 << 70 if i is None else i
        gone = bytearray(len(t))
        for a in range(len(t) - length + 1):
            if seen[t[a:a + length]] < (key, a):
                gone[a:a + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randrange(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, other = text(60), text(35)
    rows = [(i, text(rng.randrange(1, 60)) + (passage if i % 3 == 0 else "") + text(rng.randrange(20))
             + (other * (i % 3) if i % 4 == 0 else "")) for i in range(40)]
    rows += [(100 + i, rows[7][1][:-i or None]) for i in range(6)]
    rows += [(200, None), (201, ""), (202, "short"), (203, "=" * 500), (204, "x" + "=" * 300), (205, "ab" * 400),
             (206, "\0" * 250), (207, "\0\0a" * 90), (50, passage), (None, passage + "tail"), (None, passage + "tail"),
             (7, rows[7][1]), (9, rows[9][1]), (300, "z" * 99), (301, "z" * 99), (302, "z" * 100), (303, "z" * 100)]
    return rows


@pytest.mark.parametrize("kinds", [20_000, 2])
def test_removal_by_brute_force(make_docs, kinds):
    rows = corpus(1)
    got = remove_repeats(make_docs(rows), group_kinds=kinds)
    want = brute([(i, (t or "").encode()) for i, t in rows], 100)
    assert sorted((tuple(r) for r in got.drop("kept").collect()), key=str) == want
    for r in got.collect():
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256
    assert remove_repeats(make_docs([])).count() == 0
    assert remove_repeats(make_docs([(1, "tiny")])).first().n_removed == 0


def test_suffix_array_in_two_stages():
    rng = np.random.default_rng(0)
    for letters in (1, 2, 5, 200):
        parts = [rng.integers(1, letters + 1, rng.integers(12, 40)).astype(np.uint16) for _ in range(30)]
        text = np.concatenate([np.append(p, 0) for p in parts]).astype(np.uint16)
        first = np.cumsum([len(p) + 1 for p in parts]) - [len(p) + 1 for p in parts]
        wanted = np.concatenate([f + np.arange(len(p) - 9) for f, p in zip(first, parts)])
        sa = suffix_array(text, wanted, 10)
        keys = [text[i:i + 10].tolist() for i in sa]
        assert sorted(sa.tolist()) == wanted.tolist() and keys == sorted(keys)
        lcp = common_prefixes(text, sa, 10)
        for a in range(1, len(sa)):
            n = next((k for k in range(10) if keys[a][k] != keys[a - 1][k]), 10)
            assert lcp[a] == n


def test_segments_part_all_starts():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab ") for _ in range(n)).encode() for n in (0, 99, 100, 101, 400, 5, 1000)]
    got = {(int(d), s) for doc, lo, n, _, _ in segments(texts, 100) for d, a, k in zip(doc, lo, n) for s in range(a, a + k)}
    assert got == {(d, s) for d, t in enumerate(texts) for s in range(len(t) - 99)}


@pytest.mark.parametrize("kinds", [20_000, 2])
def test_different_texts_under_null_and_repeated_ids(make_docs, kinds):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, head, own = text(150), text(260), text(400)
    rows = [(None, text(300) + passage + text(200)), (None, own + text(300)), (None, text(700)), (None, own + text(300)),
            (4, passage + text(300)), (4, text(50) + passage + text(300)), (4, text(600)), (6, head + text(200)), (6, head + text(250)),
            (6, head[:180] + text(300)), (5, text(30) + head[60:200] + text(90)), (6, text(800)), (None, None), (None, "")]
    rows += [rows[0]] * 3 + [rows[7]] * 2
    got = remove_repeats(make_docs(rows), group_kinds=kinds)
    assert sorted((tuple(r) for r in got.drop("kept").collect()), key=str) == brute([(i, (t or "").encode()) for i, t in rows], 100)
