"""Operator 13 against a brute-force version, for samples that propose everything, little or nothing."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from stockflow.llm import collocations as co

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute(rows, at_least, top, scale=2_000_000, covered=80):
    f, n = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            c = f.setdefault(lang, Counter())
            for k in range(1, 5):
                for i in range(len(ws) - k + 1):
                    c[tuple(ws[i:i + k])] += 1
    out = []
    for lang, c in f.items():
        some = {g: a for g, a in c.items() if a >= at_least}
        longest = Counter()
        for g, a in some.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    longest[g[i:i + k]] = max(longest[g[i:i + k]], a)
        rank = []
        for g, a in some.items():
            if len(g) > 1 and not (longest[g] and 100 * longest[g] >= covered * a):
                s, k = min((scale * a // (c[g[:k]] + c[g[k:]]), k) for k in range(1, len(g)))
                rank.append((-s, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        for i, (s, a, p, l, r) in enumerate(sorted(rank)[:top], 1):
            out.append((lang, i, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def sample(n=240, seed=6):
    rnd = random.Random(seed)
    vocab = [f"w{k}" for k in range(60)] + ["É", "größe", " x", "日本"]
    fixed = ["alpha beta gamma delta epsilon", "New York City", "w1 w2 w3", "a a a a a a", "beta Gamma"]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rnd.randint(0, 60)):
            words.append(rnd.choice(fixed) if rnd.random() < 0.2 else vocab[min(int(rnd.expovariate(0.1)), len(vocab) - 1)])
            words.append(rnd.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\r\n", "!? "]))
        rows.append((i, "".join(words), rnd.choice(["en", "en", "de", None, "und", ""])))
    rows += [(i, "the same copied document of some words " * 3, "en") for i in range(300, 420)]    # a third of all rows
    rows += [(7, "again", "en"), (None, None, "en"), (None, "", None), (500, "k " * 30_000, "fr"), (501, ".,;", "xx"), (None, "a b " * 40, "de")]
    return rows


@pytest.fixture(scope="module")
def docs(llm_spark):
    def make(rows):
        df = llm_spark.createDataFrame(rows, "doc_id long, text string, lang string")
        return df.selectExpr("*", "1 AS n", "2 AS w1", "3 AS word", "4 AS rank", "5 AS score", "6 AS cid")
    return make


@pytest.mark.parametrize("one_in", [1, 8, 10 ** 9])
def test_brute_force_whatever_the_sample(docs, one_in):
    rows = sample()
    got = co.mine_collocations(docs(rows), at_least=6, top=25, one_in=one_in).collect()
    assert sorted(map(tuple, got)) == brute(rows, 6, 25)


def test_every_key_heavy(docs, monkeypatch):
    monkeypatch.setattr(co, "HEAVY_PARTS", 10 ** 9)
    monkeypatch.setattr(co, "GATHER", 500)
    monkeypatch.setattr(co, "BUFFER", 300)
    monkeypatch.setattr(co, "TOP_PARTS", 2)
    rows = sample(60)
    assert sorted(map(tuple, co.mine_collocations(docs(rows), at_least=3, top=400).collect())) == brute(rows, 3, 400)


def test_a_full_filter_changes_no_count(docs, monkeypatch):
    """All bits set: every phrase is on the border and counted; the result stays."""
    monkeypatch.setattr(co, "bit_filter", lambda hashes: co.BitFilter(1 << 16, np.full(1 << 13, 255, np.uint8)))
    rows = sample(60)
    assert sorted(map(tuple, co.mine_collocations(docs(rows), at_least=5, top=50).collect())) == brute(rows, 5, 50)


def poor_hash():
    """The hash, but with ``beta`` and ``gamma`` alike under the first seed."""
    real, base = co.WordHash.__call__, co.WordHash(0).base

    def call(self, buf, starts, ends, salt):
        h = real(self, buf, starts, ends, salt)
        if self.base == base:
            h[[i for i, (a, b) in enumerate(zip(starts, ends)) if bytes(buf[a:b]) in (b"beta", b"gamma")]] = 5
        return h
    return call


@pytest.mark.parametrize("texts", [["alpha beta gamma"] * 9, ["alpha beta"] * 9 + ["gamma alpha"] * 9])
def test_colliding_hashes_take_another_seed(docs, monkeypatch, texts):
    """Words that share a hash are noticed (mine gives None), in one task or two, and the corpus is
    counted with another seed."""
    seeds = []
    monkeypatch.setattr(co.WordHash, "__call__", poor_hash())
    real = co.mine

    def mine(docs_, at_least, proposed, seed):
        seeds.append(seed)
        return real(docs_, at_least, proposed, seed)
    monkeypatch.setattr(co, "mine", mine)
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    assert sorted(map(tuple, co.mine_collocations(docs(rows), at_least=3, top=50).collect())) == brute(rows, 3, 50)
    assert seeds == [0, 1]


def test_words_of_a_buffer():
    text = "One two,three\tFOUR  five.\n\nÉtude.".encode() + b"\n"
    folded = text.translate(co.FOLD)
    starts, ends, is_word = co.word_bounds(np.frombuffer(folded, np.uint8))
    assert [folded[a:b].decode() for a, b in zip(starts, ends)] == ["one", "two", "three", "four", "five", "Étude"]
    assert is_word.tolist() == [True, True, False, True, True, True, False, False, False, True, False, False]
    hashes = co.WordHash(3)
    words = [f"w{k}".encode() for k in range(20_000)] * 2
    buf = np.frombuffer(b" ".join(words), np.uint8)
    starts, ends, _ = co.word_bounds(buf)
    ends = np.append(ends, len(buf))
    h = hashes(buf, starts, ends, 7)
    assert (h[:20_000] == h[20_000:]).all() and len(np.unique(h)) == 20_000
    assert (hashes(buf, starts, ends, 8) != h).all()


def test_places_around_failures():
    """An expansion counts the phrases that hold a failure and were not on the border, no others."""
    def held(*phrases):
        p = co.BitFilter(1 << 20)
        for x in phrases:
            h = co._hashes(pa.RecordBatch.from_pydict({w: pa.array([v], pa.int64()) for w, v in zip(co.W, [*x, 0, 0, 0, 0])}))
            at = int(h[0]) & (p.bits - 1)
            p.cells[at >> 3] |= 1 << (at & 7)
        return p
    h = np.array([10, 11, 12, 13, 1, 11, 14], np.uint64)
    words = [(10,), (11,), (12,), (13,)]

    def around(*frequent):
        got = co.beyond_border(h, held(*words), held((11, 12)), held(*words, *frequent))
        return [[tuple(map(int, h[i:i + n])) for i in np.flatnonzero(ok)] for n, (_, ok) in enumerate(got, 1)]
    # 11 12 itself was on the border, its extensions were not
    assert around((10, 11), (11, 12), (12, 13)) == [[], [], [(10, 11, 12), (11, 12, 13)], [(10, 11, 12, 13)]]
    # 12 13 was counted and is not frequent: nothing that holds it can be
    assert around((10, 11), (11, 12)) == [[], [], [(10, 11, 12)], []]


def test_empty_table(docs):
    assert co.mine_collocations(docs([])).count() == 0
