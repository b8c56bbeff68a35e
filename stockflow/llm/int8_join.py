"""Operator 7: embedding near-duplicates by int8 tile products with rigorous error bounds.

Equal vectors are one node. The nodes are dealt into tiles, every pair of tiles is one group, and
a group multiplies the int8 codes of its two tiles. With ``u = s q + e`` the true cosine lies
within ``|e_u| |s_v q_v| + |e_v|`` of the product of the codes, so a pair is linked or dropped at
once unless the threshold lies inside that range. Only codes cross the grid of tile pairs. A group
names the nodes of its undecided pairs, and in a second pass these nodes alone meet there with
their vectors, where the undecided pairs are computed in full precision. A group returns counts of
links per node and links that span its groups, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import local_components
from stockflow.llm.components import components
from stockflow.llm.vectors import cosines, matrix, unit, usable_rows
from stockflow.session import cut_lineage

#: Mean number of distinct vectors in a tile, and rows of a tile multiplied at once.
TILE_ROWS, STEP = 4096, 256
#: Of rounding in double precision, added to every bound; of rounding in single precision, for each
#: component of vectors of length one.
SLACK, ROUNDING = 1e-9, 1.3e-7

CODED = "node long, copies long, dim int, code binary, scale double, err double"
FOUND = "kind int, u long, v long, n long, a int, b int"
COUNT, LINK, UNSURE = 0, 1, 2


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes in -127..127, scale and length of the rounding error of each unit row."""
    scale = np.abs(x).max(1) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    err = np.sqrt(((x - q * scale[:, None]) ** 2).sum(1))
    return q, scale, err


def code_products(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, step: int = 100_000) -> np.ndarray:
    """Exact integer products of the code rows ``a[i]`` and ``b[j]``, pair by pair."""
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), step):
        out[at:at + step] = np.einsum("ij,ij->i", a[i[at:at + step]], b[j[at:at + step]], dtype=np.int64)
    return out


def judge_pairs(qa, sa, ea, qb, sb, eb, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers of the pairs that may reach the threshold, and which of them surely do.

    A product in single precision, with the largest bound of the rows and all that it can round off,
    leaves few pairs; these are judged from the exact product of their codes and their own bounds.
    """
    length = np.sqrt((qb.astype(np.float64) ** 2).sum(1)) * sb
    if len(qa) == 0 or len(qb) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    rough = (qa * sa[:, None]).astype(np.float32) @ (qb * sb[:, None]).astype(np.float32).T
    most = ea.max() * length.max() + eb.max() + SLACK + ROUNDING * (qa.shape[1] + 8)
    i, j = np.nonzero(rough >= np.float32(threshold - most) - np.float32(1e-6))
    est = code_products(qa, qb, i, j) * sa[i] * sb[j]
    bound = ea[i] * length[j] + eb[j] + SLACK
    may = est + bound >= threshold
    return i[may], j[may], est[may] - bound[may] >= threshold


def tile_links(qa, sa, ea, xa, qb, sb, eb, xb, threshold: float) -> np.ndarray:
    """Boolean matrix of the pairs with cosine at or above the threshold; the undecided ones are
    computed from the unit vectors ``xa`` and ``xb``."""
    i, j, sure = judge_pairs(qa, sa, ea, qb, sb, eb, threshold)
    sure[~sure] = cosines(xa, xb, i[~sure], j[~sure]) >= threshold
    out = np.zeros((len(qa), len(qb)), bool)
    out[i[sure], j[sure]] = True
    return out


def _coded(nodes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(2).to_numpy()
            for d in np.unique(dims):
                part = b.filter(pa.array(dims == d))
                q, scale, err = quantise(unit(matrix(part.column(3))))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array([r.tobytes() for r in q], pa.binary()), pa.array(scale), pa.array(err)],
                    names=["node", "copies", "dim", "code", "scale", "err"])

    return nodes.select("node", "copies", "dim", "v").mapInArrow(run, CODED)


class Links:
    """Links of a group, gathered as counts per node and a spanning star of each linked set."""

    def __init__(self, node: np.ndarray, copies: np.ndarray):
        self.node, self.copies = node, copies
        self.count = np.zeros(len(node), np.int64)
        self.us, self.vs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def add(self, i: np.ndarray, j: np.ndarray, both: bool) -> None:
        """Linked pairs ``i``, ``j`` (row numbers); ``both`` counts them for ``j`` too."""
        if len(i) == 0:
            return
        np.add.at(self.count, i, self.copies[j])
        if both:
            np.add.at(self.count, j, self.copies[i])
        root = local_components(len(self.node), i, j)
        far = np.flatnonzero(root != np.arange(len(root)))
        self.us.append(far)
        self.vs.append(root[far])

    def table(self, unsure: np.ndarray, a: int, b: int) -> pa.Table:
        root = local_components(len(self.node), np.concatenate(self.us), np.concatenate(self.vs))
        far, some, open_ = np.flatnonzero(root != np.arange(len(root))), np.flatnonzero(self.count), np.flatnonzero(unsure)
        kinds = np.repeat(np.array([LINK, COUNT, UNSURE], np.int32), [len(far), len(some), len(open_)])
        u = self.node[np.concatenate([far, some, open_])]
        v = np.concatenate([self.node[root[far]], self.node[some], self.node[open_]])
        n = np.concatenate([np.zeros(len(far), np.int64), self.count[some], np.zeros(len(open_), np.int64)])
        return pa.table({"kind": kinds, "u": u, "v": v, "n": n, "a": np.full(len(u), a, np.int32), "b": np.full(len(u), b, np.int32)})


def _sides(t: np.ndarray, a: int, b: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of the first tile, some at a time, with those of the second."""
    left, right = np.flatnonzero(t == a), np.flatnonzero(t == b)
    for at in range(0, len(left), STEP):
        yield left[at:at + STEP], right


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 threshold: float = 0.9, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links and components of all vectors whose cosine is at least ``threshold``.

    Returns one row per input row: ``vec_id``, ``n_links`` (other rows linked directly),
    ``component_id`` (smallest id reachable), ``kept`` (whether the row's id is that id).

    Vectors that are null, zero, or hold null or non-finite components link with nothing, nor do
    rows of a null id (their ``component_id`` is null and they are kept); vectors of different
    lengths do not compare. Repeated rows are vectors of their own that link with each other.
    Other columns are ignored; an empty table gives no rows.
    """
    rows = usable_rows(vectors, id_col, vector_col)
    nodes = rows.groupBy("dim", "v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    # numbered in the checkpoint: two different vectors are two nodes, whatever their hashes
    nodes = cut_lineage(nodes.withColumn("node", F.monotonically_increasing_id()))
    tiles = max(1, -(-nodes.count() // tile_rows))
    tile = F.pmod(F.xxhash64("node"), F.lit(tiles)).cast("int").alias("t")
    dealt = (_coded(nodes).withColumn("t", tile).withColumn("o", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
             .withColumn("a", F.least("t", "o")).withColumn("b", F.greatest("t", "o")).drop("o"))

    def by_codes(key: tuple[pa.Scalar, ...], g: pa.Table) -> pa.Table:
        d, a, b = (k.as_py() for k in key)
        node, t = g["node"].to_numpy(), g["t"].to_numpy()
        q = np.frombuffer(b"".join(g["code"].to_pylist()), np.int8).reshape(-1, d)
        s, e = g["scale"].to_numpy(), g["err"].to_numpy()
        links, unsure = Links(node, g["copies"].to_numpy()), np.zeros(len(node), bool)
        for i, j in _sides(t, a, b):
            u, v, sure = judge_pairs(q[i], s[i], e[i], q[j], s[j], e[j], threshold)
            u, v = i[u], j[v]
            if a == b:
                u, v, sure = (x[u != v] for x in (u, v, sure))
            links.add(u[sure], v[sure], a != b)
            unsure[u[~sure]] = unsure[v[~sure]] = True
        return links.table(unsure, a, b)

    def by_vectors(key: tuple[pa.Scalar, ...], g: pa.Table) -> pa.Table:
        d, a, b = (k.as_py() for k in key)
        x = unit(matrix(g["v"]))
        q, s, e = quantise(x)
        links = Links(g["node"].to_numpy(), g["copies"].to_numpy())
        for i, j in _sides(g["t"].to_numpy(), a, b):
            u, v, sure = judge_pairs(q[i], s[i], e[i], q[j], s[j], e[j], threshold)
            u, v = i[u[~sure]], j[v[~sure]]
            if a == b:
                u, v = u[u != v], v[u != v]
            hit = cosines(x, x, u, v) >= threshold
            links.add(u[hit], v[hit], a != b)
        return links.table(np.zeros(len(x), bool), a, b)

    first = cut_lineage(dealt.groupBy("dim", "a", "b").applyInArrow(by_codes, FOUND))
    asked = first.filter(F.col("kind") == UNSURE).select(F.col("u").alias("node"), "a", "b")
    second = cut_lineage(asked.join(nodes.select("node", "copies", "dim", "v", tile), "node")
                         .select("node", "copies", "dim", "v", "t", "a", "b")
                         .groupBy("dim", "a", "b").applyInArrow(by_vectors, FOUND))
    found = first.unionByName(second)
    counts = found.filter(F.col("kind") == COUNT).groupBy("u").agg(F.sum("n").alias("n"))
    roots = components(found.filter(F.col("kind") == LINK).select("u", "v"))
    named = (nodes.select("node", "dim", "v", "rep", "copies")
             .join(counts, F.col("node") == F.col("u"), "left").drop("u")
             .join(roots.select(F.col("node").alias("_m"), "root"), F.col("node") == F.col("_m"), "left").drop("_m")
             .withColumn("root", F.coalesce("root", "node")))
    lows = named.groupBy("root").agg(F.min("rep").alias("low"))
    named = named.join(lows, "root").select(
        F.col("v").alias("_v"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "low")
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                         F.when(F.col(id_col).isNotNull(), F.col(vector_col).cast("array<double>")).alias("_own"))
    return (own.join(named, F.col("_own") == F.col("_v"), "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("low", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))


SQL = """
with recursive v as (
  select vec_id, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (
  select a.vec_id as u, b.vec_id as v from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e) * list_inner_product(b.e, b.e)) >= 0.9),
reach as (
  select vec_id, vec_id as r from v
  union
  select reach.vec_id, l.v from reach join l on l.u = reach.r),
c as (select vec_id, min(r) as component_id from reach group by vec_id),
n as (select u as vec_id, count(*) as n_links from l group by u)
select e.vec_id, cast(coalesce(n.n_links, 0) as bigint) as n_links, coalesce(c.component_id, e.vec_id) as component_id,
       coalesce(c.component_id, e.vec_id) is not distinct from e.vec_id as kept
from embeddings e left join c on c.vec_id = e.vec_id left join n on n.vec_id = e.vec_id
"""
