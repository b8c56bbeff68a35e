import random
import zlib

import numpy as np
import pytest

from stockflow.llm import toxicity
from stockflow.llm.toxicity import WINDOW, ToxicNet, Words, _counts, score_toxicity, window_starts, windows


def test_windows_cover_whole_texts():
    for n in (0, 1, 31, 32, 33, 48, 49, 500):
        s = window_starts(n)
        covered = set().union(*(range(a, a + WINDOW) for a in s))
        assert set(range(n)) <= covered and (n <= WINDOW or s[-1] < n)
    idx, doc = windows([np.array([1, 2]), np.zeros(0, np.int64)])
    assert idx.shape == (2, WINDOW) and doc.tolist() == [0, 1] and idx[0, :3].tolist() == [1, 2, 0]


def test_gradients_by_differences():
    w = Words([b"some toxic words here abcdef", b"other clean text and more of it"])
    rng = np.random.default_rng(0)
    net = ToxicNet(rng.normal(size=1 << 17).astype(np.float32), rng.normal(size=1 << 17).astype(np.float32))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    idx, _ = windows(w.docs)
    y = np.array([1.0, 0.0])

    def loss():
        z = net.logits(w, idx)
        return float(np.mean(np.logaddexp(0, z) - y * z))
    g = net.step(w, net.inputs(w), idx, y)
    for k in ("wf", "ub", "cf", "a", "o", "s", "uf"):
        at = tuple(rng.integers(0, n) for n in net.p[k].shape)
        old = net.p[k][at]
        net.p[k][at] = old + 1e-2
        up = loss()
        net.p[k][at] = old - 1e-2
        down = loss()
        net.p[k][at] = old
        assert g[k][at] == pytest.approx((up - down) / 2e-2, abs=3e-4)


def test_held_out_accuracy_and_odd_rows(make_docs, llm_spark):
    rng = random.Random(2)
    vocab = [f"{rng.choice('abcdef')}{rng.choice('ghij')}w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(500):
        words = [rng.choice(vocab) for _ in range(rng.randrange(20, 120))]
        toxic = int(i % 4 == 0)
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(["nasty", "vileword", f"badd{i % 7}"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    rows += [(900, None), (901, ""), (902, "word " * 30000), (None, "no id nasty"), (5, rows[5][1])]
    labels += [(None, 1, 1), (3, None, None), (5, 1, 0)]
    lab = llm_spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = make_docs(rows)
    out = score_toxicity(docs, lab).collect()
    assert len(out) == len(rows)
    truth = {i: t for i, _, t in labels if i is not None and t is not None}
    for r in out:
        assert r.held_out == (zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(truth[r.doc_id], r.predicted) for r in out if r.held_out and r.doc_id in truth]
    assert np.mean([a == b for a, b in held]) > 0.9
    assert score_toxicity(docs, lab.limit(0)).filter("score = 0").count() == len(rows)
    assert score_toxicity(make_docs([]), lab).count() == 0


def grams_of(word):
    """Buckets of the 5-grams of a word with a mark on either side, byte by byte."""
    b = b"\n" + word + b"\n"
    out = []
    for i in range(len(b) - 4):
        key = int.from_bytes(b[i:i + 5], "big")
        out.append((key * 0x9E3779B97F4A7C15 % 2 ** 64) >> (64 - 17))
    return out


def test_odds_by_brute_force(llm_spark):
    rng = random.Random(5)
    vocab = ["a", "be", "cat", "dogs", "eagle", "falcon", "nasty", "vileword"]
    rows = [(" ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 12))).encode(), i % 3 == 0) for i in range(80)]
    got = _counts(llm_spark.createDataFrame([(t, int(y)) for t, y in rows], "text binary, y int"))
    toxic = sum(y for _, y in rows)
    clean, share = len(rows) - toxic, (toxic + 1) / (len(rows) + 2)
    seen = [{}, {}]
    for t, y in rows:
        words = set(t.lower().split())
        for kind, buckets in ((0, {zlib.crc32(w) % (1 << 17) for w in words}), (1, {g for w in words for g in grams_of(w)})):
            for k in buckets:
                seen[kind].setdefault(k, [0, 0])[int(y)] += 1
    for kind in (0, 1):
        want = np.zeros(1 << 17)
        for k, (c, t) in seen[kind].items():
            o = np.log((t + 20 * share) / (toxic + 20 * share)) - np.log((c + 20 * (1 - share)) / (clean + 20 * (1 - share)))
            want[k] = min(max(o / 2, -2), 3)
        assert np.abs(got[kind] - want).max() < 1e-5 and len(seen[kind]) > 5


def test_forward_pass_by_brute_force():
    """Scores of all windows from scalars and loops: inputs, both recurrences, attention."""
    rng = np.random.default_rng(1)
    net = ToxicNet(rng.normal(size=1 << 17).astype(np.float32), rng.normal(size=1 << 17).astype(np.float32))
    texts = [b"some toxic words here abcdef", b"", b" ".join(b"w%d" % (i % 13) for i in range(70))]
    p, n = {k: v.astype(float) for k, v in net.p.items()}, 8

    def sig(x):
        return 1 / (1 + np.exp(-x))

    def vector(word):
        if not word:
            return np.zeros(18)
        gs = grams_of(word)
        odds = max((net.gram_odds[g] for g in gs), default=0.0)
        chars = sum((p["ec"][g] for g in gs), np.zeros(8)) / max(1, len(gs))
        k = zlib.crc32(word) % (1 << 17)
        return np.concatenate([[net.word_odds[k], odds], p["ew"][k], chars])

    def states(xs, k):
        h, out = np.zeros(n), []
        for x in xs:
            g = x @ p["w" + k] + p["c" + k]
            z, r = sig(g[:n] + h @ p["u" + k][:, :n]), sig(g[n:2 * n] + h @ p["u" + k][:, n:2 * n])
            c = np.tanh(g[2 * n:] + (r * h) @ p["u" + k][:, 2 * n:])
            h = (1 - z) * h + z * c
            out.append(h)
        return out

    want = []
    for t in texts:
        words = t.split()
        for s in window_starts(len(words)):
            xs = [vector(w) for w in (words[s:s + WINDOW] + [b""] * WINDOW)[:WINDOW]]
            hs = [np.concatenate(x) for x in zip(states(xs, "f"), states(xs[::-1], "b")[::-1])]
            e = np.array([h @ p["a"] for h in hs])
            e = np.exp(e - e.max()) / np.exp(e - e.max()).sum()
            want.append(sum(w * (h @ p["o"]) for w, h in zip(e, hs)) + p["s"][0])
    w = Words(texts)
    idx, doc = windows(w.docs)
    assert np.abs(net.logits(w, idx) - np.array(want)).max() < 1e-4 and len(want) == len(doc) >= 6


def test_sample_is_bounded_in_rows(make_docs, llm_spark):
    """A third of the rows share one labelled id: the sample still holds fit_rows texts at most."""
    rows = [(i, f"text {i} of words") for i in range(60)] + [(3, f"another text {i}") for i in range(30)]
    lab = llm_spark.createDataFrame([(i, 1, i % 2) for i in range(60)], "doc_id long, quality int, toxic int")
    seen = []
    old = toxicity._counts
    toxicity._counts = lambda sample: seen.append(sample.count()) or old(sample)
    try:
        toxicity.fit(make_docs(rows), lab, "doc_id", "text", "toxic", 8)
        toxicity.fit(make_docs(rows), lab, "doc_id", "text", "toxic", 10_000)
    finally:
        toxicity._counts = old
    assert seen[0] <= 8 and 40 < seen[1] <= 90
