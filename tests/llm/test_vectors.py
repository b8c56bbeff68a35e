import numpy as np
import pytest
from pyspark.sql import functions as F

from stockflow.llm.int8_join import near_vectors, quantise, tile_links
from stockflow.llm.one_bit import nearest
from stockflow.llm.vectors import unit

NAN, INF = float("nan"), float("inf")


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for c in ("v", "dim", "node", "rep", "n_links", "score"):
        df = df.withColumn(c, F.lit(3))
    return df


def sample(n=260, d=16, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).astype(np.float32)
    for i in range(0, n, 4):
        x[i] = x[(i + 7) % n] + rng.normal(0, 0.12, d)
    x[40:70] = x[5]                                   # a hot vector
    rows = [(i, [float(c) for c in v], 0) for i, v in enumerate(x)]
    return rows + [(900, None, 1), (950, [0.0] * d, 1), (901, [NAN] + [1.0] * (d - 1), 1), (902, [INF] * d, 1),
                   (903, [None] + [1.0] * (d - 1), 1), (904, [], 1), (1000, [1.0, 2.0], 1), (905, [2.0, 4.0], 1),
                   (None, rows[3][1], 1), (50, rows[9][1], 1), (7, rows[7][1], 1)]


def good(rows):
    out = []
    for i, v, _ in rows:
        if i is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v):
            out.append((i, np.array(v, np.float64)))
    return out


def cos(a, b):
    return float(a @ b / np.sqrt((a @ a) * (b @ b))) if len(a) == len(b) else -9.0


@pytest.mark.parametrize("tile", [2048, 30])
def test_links_by_brute_force(llm_spark, tile):
    rows = sample()
    ok = good(rows)
    n = len(ok)
    hit = [[i != j and cos(ok[i][1], ok[j][1]) >= 0.9 for j in range(n)] for i in range(n)]
    lab = [i for i, _ in ok]
    while True:
        new = [min([lab[i]] + [lab[j] for j in range(n) if hit[i][j]]) for i in range(n)]
        if new == lab:
            break
        lab = new
    want = [(ok[i][0], sum(hit[i]), lab[i], ok[i][0] == lab[i]) for i in range(n)]
    left = [r[0] for r in rows]
    for i, _ in ok:
        left.remove(i)
    want += [(i, 0, i, True) for i in left]
    got = near_vectors(table(llm_spark, rows), tile_rows=tile).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert near_vectors(table(llm_spark, [])).count() == 0


@pytest.mark.parametrize("d", [1, 24, 2000])
def test_bounds_are_rigorous(d):
    rng = np.random.default_rng(0)
    x = unit(rng.normal(size=(300, d)))
    y = unit(x[:, ::1] + rng.normal(0, 0.2, x.shape))
    for t in (0.0, 0.5, 0.9):
        got = tile_links(*quantise(x), x, *quantise(y), y, t)
        assert (got == (x @ y.T >= t)).all()


@pytest.mark.parametrize("block", [1024, 40])
def test_nearest_recall_and_exact_scores(llm_spark, block):
    rows = sample(600, 32)
    ok = good(rows)
    got = nearest(table(llm_spark, rows), every=50, k=5, block_rows=block, query_rows=5).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    asks = {i for i, _ in ok if i % 50 == 0}
    want, found = 0, 0
    for q in asks:
        v = min((tuple(x) for i, x in ok if i == q))
        ref = sorted(((-cos(np.array(v), x), i) for i, x in ok if i != q and len(x) == len(v)))[:5]
        mine = sorted(by.get(q, []))
        assert [r for r, _, _ in mine] == list(range(1, len(ref) + 1))
        for (_, i, s), (t, _) in zip(mine, ref):
            assert s <= -t + 1e-9
        want += len(ref)
        found += len({i for _, i in ref} & {i for _, i, _ in mine})
    assert found >= 0.9 * want
    assert nearest(table(llm_spark, [])).count() == 0
