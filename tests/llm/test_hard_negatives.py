"""Operator 12 against a brute-force version in Python's integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockflow.llm import hard_negatives as hn

NAN, INF = float("nan"), float("inf")


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for c in ("id", "dim", "q", "lo", "block", "score", "rank", "anchor"):
        df = df.withColumn(c, F.lit(3))
    return df


def sample(n=420, d=12, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 0.3, (n, d)).astype(np.float32)
    x[n // 3: 2 * n // 3] = x[5]                               # a third of the rows alike
    label = rng.integers(0, 4, n)
    label[::2] = 1                                             # a hot label
    rows = [(int(i), [float(c) for c in v], int(k)) for i, (v, k) in enumerate(zip(x, label))]
    v = rows[0][1]
    return rows + [(500, None, 1), (600, [0.0] * d, 1), (700, v, None), (800, [NAN] + v[1:], 1), (801, [INF] + v[1:], 1),
                   (802, [None] + v[1:], 1), (900, [], 1), (901, [], 2), (1000, v[:3], 1), (1001, v[1:4], 1), (1002, v[:3], 2),
                   (None, v, 1), (200, rows[9][1], 0), (31, rows[31][1], 3), (31, rows[31][1], 3), (1100, [3e38] * d, 1),
                   (1200, [c * 2.0 ** 21 for c in v], 1), (1201, [c * 2.0 ** 20 for c in v], 2), (1203, [c * 2.0 ** 21 for c in v], 1)]


def brute(rows, every=100, positives=5, negatives=10):
    ok = []
    for i, v, k in rows:
        if i is None or v is None or k is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        if sum((c * 256.0) ** 2 for c in v) < 2 ** 60:
            ok.append((i, k, tuple(math.floor(c * 256) for c in v)))
    anchors = {}
    for i, k, q in ok:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (k, q)), (k, q), key=lambda x: (x[0], hn.pack_code(x[1])))
    out = []
    for a, (k, q) in anchors.items():
        other = sorted((-sum(x * y for x, y in zip(q, p)), i, l) for i, l, p in ok if i != a and len(p) == len(q))
        for s, p, _ in [x for x in other if x[2] == k][:positives]:
            hits = [x for x in other if x[2] != k and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives]
            out += [(a, p, r, i, -s, -t) for r, (t, i, _) in enumerate(hits, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [16384, 50])
def test_brute_force(llm_spark, block):
    rows = sample()
    got = hn.mine_hard_negatives(table(llm_spark, rows), block_rows=block, anchor_rows=3).collect()
    want = brute(rows)
    assert sorted(map(tuple, got)) == want and len(want) > 100
    assert any(abs(r.positive_score) > 2 ** 53 for r in got)


def test_empty_table(llm_spark):
    assert hn.mine_hard_negatives(table(llm_spark, [])).count() == 0
    assert hn.mine_hard_negatives(table(llm_spark, [(100, [1.0], 1), (1, [1.0], 1)])).count() == 0


def test_first_of_rows_breaks_ties_to_the_left():
    s = np.array([[5, 9, 5, 5, 1], [1, 1, 1, 1, 1]])
    ok = np.array([[True, True, True, True, True], [False, True, True, False, True]])
    assert hn.first_of_rows(s, ok, 3).tolist() == [[True, True, True, False, False], [False, True, True, False, True]]


def test_windows_are_exact_beyond_64_bits():
    for p in (2 ** 61 - 1, -7, 0, 13):
        lo, hi = hn.window_of(p, 30, 90)
        for s in (lo - 1, lo, hi, hi + 1):
            assert (30 * p <= 100 * s <= 90 * p) == (lo <= s <= hi)
