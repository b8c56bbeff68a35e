"""Operator 3: nearest neighbours from randomly rotated one-bit codes.

Every vector is rotated by one random orthogonal matrix and kept as the signs of its components
(packed bits) with one correction scalar, the inner product of the rotated unit vector and its
code. A query's inner product with a code, divided by that scalar, estimates its cosine; the
error stays below a bound known per vector. Per block of candidates the best estimates are
computed exactly to get a floor for the fifth place, and every candidate whose estimate plus bound
reaches the floor is reranked by its exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm.vectors import cosines, matrix, unit, usable_rows
from stockflow.session import cut_lineage

#: Mean rows of a candidate block and of a query block.
BLOCK_ROWS, QUERY_ROWS = 8192, 4096
#: The bound's width: the chance of a larger error is below 2 exp(-WIDTH ** 2 / 2).
WIDTH = 4.0

CODED = "vec_id long, dim int, v array<double>, bits binary, fix double"


def rotation(dim: int, seed: int = 11) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def encode(x: np.ndarray, rot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs and correction scalar of unit rows."""
    r = x @ rot.T
    return np.packbits(r >= 0, axis=1), np.abs(r).sum(1) / np.sqrt(x.shape[1])


def estimate(queries: np.ndarray, rot: np.ndarray, bits: np.ndarray, fix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines (queries x codes) and the error bound of each code."""
    d = queries.shape[1]
    signs = np.unpackbits(bits, axis=1, count=d).astype(np.float32) * 2 - 1
    r = (queries @ rot.T).astype(np.float32)
    inner = (r @ signs.T).astype(np.float64) / np.sqrt(d)
    bound = np.sqrt(np.maximum(0, 1 - fix ** 2)) / fix * WIDTH / np.sqrt(max(1, d - 1)) + 1e-5
    return inner / fix[None], bound


def block_best(qid, q, cid, c, bits, fix, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` nearest of a block for each query: query number, candidate number, cosine."""
    rot = rotation(q.shape[1])
    out = []
    for at in range(0, len(q), 128):
        qs, ids = q[at:at + 128], qid[at:at + 128]
        est, bound = estimate(qs, rot, bits, fix)
        own = ids[:, None] == cid[None]
        est[own] = -np.inf
        m = min(k, len(cid))
        first = np.argpartition(-est, m - 1, axis=1)[:, :m]
        rows = np.repeat(np.arange(len(qs)), m)
        exact = cosines(qs, c, rows, first.ravel()).reshape(-1, m)
        exact[np.take_along_axis(own, first, 1)] = -np.inf
        floor = exact.min(1)
        i, j = np.nonzero((est + bound[None] >= floor[:, None]) & ~own)
        score = cosines(qs, c, i, j)
        order = np.lexsort((cid[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        keep = place < k
        out.append((i[keep] + at, j[keep], score[keep]))
    return tuple(np.concatenate(x) for x in zip(*out))


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50,
            k: int = 5, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """The ``k`` nearest rows (largest cosine) of every row whose id is divisible by ``every``.

    Returns ``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (exact cosine in double
    precision); ties go to the smaller id. Every usable row is indexed.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows
    of a null id; vectors of other lengths are no candidates. Rows that share the query's id are
    its own. Of query rows that repeat an id one (the smallest vector) asks. Other columns are
    ignored; an empty table gives no rows.
    """
    rows = usable_rows(vectors, id_col, vector_col)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(2).to_numpy()
            for d in np.unique(dims):
                part = b.filter(pa.array(dims == d))
                bits, fix = encode(unit(matrix(part.column(1))), rotation(int(d)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), part.column(1),
                     pa.array([r.tobytes() for r in bits], pa.binary()), pa.array(fix)],
                    names=["vec_id", "dim", "v", "bits", "fix"])

    coded = cut_lineage(rows.select("vec_id", "v", "dim").mapInArrow(code, CODED))
    n = coded.count()
    c_blocks, q_blocks = max(1, -(-n // block_rows)), max(1, -(-n // (every * query_rows)))
    asks = (coded.filter(F.col("vec_id") % every == 0).groupBy("vec_id", "dim").agg(F.min("v").alias("v"))
            .withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(q_blocks)).cast("int"))
            .withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))))
            .select("dim", "qb", "cb", F.lit(1).alias("ask"), "vec_id", "v", F.lit(b"").alias("bits"), F.lit(0.0).alias("fix")))
    # the row number of the checkpoint spreads rows alike in id and vector over the blocks
    gives = (coded.withColumn("cb", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(c_blocks)).cast("int"))
             .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
             .select("dim", "qb", "cb", F.lit(0).alias("ask"), "vec_id", "v", "bits", "fix"))

    def best(key: tuple[pa.Scalar, ...], g: pa.Table) -> pa.Table:
        ask = g["ask"].to_numpy() == 1
        ids = g["vec_id"].to_numpy()
        none = pa.table({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        if not ask.any() or ask.all():
            return none
        x = unit(matrix(g["v"]))
        give = ~ask
        bits = np.frombuffer(b"".join(g["bits"].to_pylist()), np.uint8).reshape(int(give.sum()), -1)
        i, j, score = block_best(ids[ask], x[ask], ids[give], x[give], bits, g["fix"].to_numpy()[give], k)
        return pa.table({"query_id": ids[ask][i], "vec_id": ids[give][j], "score": score})

    found = asks.unionByName(gives).groupBy("dim", "qb", "cb").applyInArrow(
        best, "query_id long, vec_id long, score double")
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
