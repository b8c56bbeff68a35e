import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from stockflow.llm import ppm
from stockflow.llm.ppm import score_texts


def corpus():
    rng = random.Random(4)
    words = ["the", "cat", "sat", "on", "Mat", "é", "dog's"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 30)))) for i in range(60)]
    return rows + [(100, None), (101, ""), (102, "zzz qqq \x00\xff new"), (103, "the " * 3000), (3, rows[3][1]),
                   (3, rows[3][1]), (None, "the cat")]


def fold(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 5


def brute_model(texts):
    seen = defaultdict(Counter)
    for t in texts:
        p = b"\0" * 4 + t
        for i in range(4, len(p)):
            for j in range(5):
                seen[p[i - j:i]][p[i]] += 1
    return seen


def brute_score(seen, text):
    p, total = b"\0" * 4 + text, 0.0
    for i in range(4, len(p)):
        gone = set()
        for j in range(4, -1, -1):
            here = {s: n for s, n in seen.get(p[i - j:i], {}).items()}
            if not here:
                continue
            left = {s: n for s, n in here.items() if s not in gone}
            t, d = sum(left.values()), len(left)
            if p[i] in left:
                total += math.log10(left[p[i]] / (t + d))
                break
            if d:
                total += math.log10(d / (t + d))
            gone |= set(here)
        else:
            total += -math.log10(max(1, 256 - len(gone)))
    return total


@pytest.mark.parametrize("share, contexts", [(2.0 ** -20, 1 << 17), (0.05, 1 << 17), (2.0 ** -20, 0), (0.05, 7)])
def test_scores_by_brute_force(make_docs, share, contexts, monkeypatch):
    """The same scores, whether contexts travel with the scorers or not."""
    monkeypatch.setattr(ppm, "SHARD_GRAMS", 300)
    rows = corpus()
    train = [(t or "").encode() for i, t in rows if fold(i) != 1]
    seen = brute_model(train)
    c = Counter(w for t in train for w in t.lower().split())
    c["end"] = 0
    n, v = sum(c.values()) + len(train), len([w for w in c if c[w]]) + 1
    want = []
    for i, t in rows:
        b = (t or "").encode()
        counts = [c[w] for w in b.lower().split()] + [len(train)]
        base = sum(math.log10((k + 0.5) / (n + 0.5 * (v + 1))) for k in counts)
        want.append((i, fold(i) == 1, len(counts), sum(k > 0 for k in counts), n, round(base, 6),
                     round(brute_score(seen, b), 3)))
    got = [(*tuple(r)[:5], round(r.base_score, 6), round(r.score, 3)) for r in
           score_texts(make_docs(rows), common_share=share, contexts=contexts).collect()]
    for a, b in zip(sorted(got, key=str), sorted(want, key=str)):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-4, abs=2e-3)
    assert len(got) == len(want)


def test_empty_and_untrained(make_docs):
    assert score_texts(make_docs([])).count() == 0
    only = score_texts(make_docs([(i, "ab") for i in range(30) if fold(i) == 1])).first()
    assert only.score == pytest.approx(-2 * math.log10(256)) and only.base_score == 0
