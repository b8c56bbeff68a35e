"""Operator 12: hard negatives, mined from a stream of scores in descending order.

Scores of anchors with all other rows are computed in blocks and packed into keys (anchor,
descending score, id). Anchors are dealt to partitions, each sorted by that key (repartition and
sort within partitions), and one iterator reads a partition: it opens a window at each positive and
hands out the negatives that fall into open windows. It holds the open windows of one anchor,
never the anchor's rows.

Two passes over the blocks keep the sorted stream small without losing a row of the result: the
first sends on the best positives of each block, the second, which then knows every window, the
first negatives of each window and block. What a block holds back cannot be among the first of all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.session import cut_lineage

#: Mean rows of a block of anchors and of a block of candidates.
ANCHOR_ROWS, BLOCK_ROWS = 8192, 16384
#: Rows whose scaled squared length reaches this take no part: any two others have a score that fits a long.
MAX_NORM = float(2 ** 60)
#: Below this, products are exact in double precision.
EXACT_NORM = float(2 ** 52)

POSITIVE, NEGATIVE = 0, 1
NO_SCORE = np.iinfo(np.int64).min


def first_of_rows(score: np.ndarray, usable: np.ndarray, k: int) -> np.ndarray:
    """Boolean matrix of each row's ``k`` largest usable scores, ties to the left column."""
    if score.shape[1] <= k:
        return usable
    masked = np.where(usable, score, NO_SCORE)
    floor = np.partition(masked, masked.shape[1] - k, axis=1)[:, masked.shape[1] - k][:, None]
    above = masked > floor
    level = (masked == floor) & usable
    room = k - above.sum(1)[:, None]
    return above | (level & (np.cumsum(level, axis=1) <= room))


def scores(a: np.ndarray, b: np.ndarray, rows: int = 128) -> Iterator[tuple[slice, np.ndarray]]:
    """Exact integer products of the code rows of ``a`` with all of ``b``, some rows at a time."""
    big = max(np.einsum("ij,ij->i", x.astype(float), x.astype(float)).max(initial=0.0) for x in (a, b))
    kind = float if big < EXACT_NORM else np.int64
    turned = b.astype(kind).T
    for at in range(0, len(a), rows):
        part = slice(at, at + rows)
        yield part, (a[part].astype(kind) @ turned).astype(np.int64)


def window_of(positive: int, low: int, high: int) -> tuple[int, int]:
    """Smallest and largest negative score with low * p <= 100 * s <= high * p."""
    return -((-low * positive) // 100), (high * positive) // 100


def pack_code(q: list[int]) -> bytes:
    """Codes in 16 bits where they fit, as they do for vectors of about unit length."""
    x = np.asarray(q, np.int64)
    return x.astype(np.int16).tobytes() if len(x) and np.abs(x).max() < 2 ** 15 else x.tobytes()


def codes(column, dim: int) -> np.ndarray:
    """Packed codes of one length as a matrix."""
    out = np.zeros((len(column), dim), np.int64)
    cells = column.to_pylist()
    short = np.array([len(c) == 2 * dim for c in cells], bool) & (dim > 0)
    for mask, kind in ((short, np.int16), (~short, np.int64)):
        at = np.flatnonzero(mask)
        if len(at):
            out[at] = np.frombuffer(b"".join(cells[i] for i in at), kind).reshape(len(at), dim)
    return out


def usable_codes(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, label: F.Column | None) -> DataFrame:
    """``id``, ``label``, ``dim``, ``q`` (integer codes) of the rows that take part."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = (vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & v.isNotNull()
                           & F.coalesce(finite, F.lit(False)))
            .select(F.col(id_col).cast("long").alias("id"),
                    (label if label is not None else F.col(label_col)).cast("long").alias("label"),
                    F.transform(v, lambda x: x.cast("double") * 256).alias("x")))
    norm = F.aggregate("x", F.lit(0.0), lambda t, x: t + x * x)
    return (rows.filter(norm < F.lit(MAX_NORM))
            .select("id", "label", F.size("x").alias("dim"), F.transform("x", lambda x: F.floor(x)).alias("q")))


def mine_hard_negatives(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                        label_col: str = "label", label: F.Column | None = None, every: int = 100,
                        positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                        anchor_rows: int = ANCHOR_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """For each anchor and each of its first positives, its first negatives.

    Anchors are rows whose id is divisible by ``every``; components become ``floor(256 x)`` and a
    row's score is its integer inner product with the anchor. Higher scores come first, ties by
    smaller id. Positives are the first ``positives`` other rows of the anchor's label; negatives the
    first ``negatives`` rows of another label with ``low * p <= 100 * s <= high * p``. ``label`` may
    replace the label column by an expression.

    Returns ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``,
    ``negative_score``, all exact.

    Rows with a null id, label or vector, or with a null or non-finite component take no part, nor
    do rows whose scaled squared length reaches 2^60 (their scores might not fit a long). Vectors of
    different lengths do not meet. Rows that share the anchor's id are its own; of anchor rows that
    repeat an id the one of the smallest label and vector asks. Repeated candidates count each.
    Other columns are ignored; an empty table gives no rows.
    """
    packed = usable_codes(vectors, id_col, vector_col, label_col, label)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array([pack_code(x) for x in b.column(3).to_pylist()], pa.binary())],
                names=["id", "label", "dim", "q"])

    rows = cut_lineage(packed.mapInArrow(pack, "id long, label long, dim int, q binary"))
    n = rows.count()
    n_blocks, n_asks = max(1, -(-n // block_rows)), max(1, -(-n // (every * anchor_rows)))
    # the row number of the written table spreads rows alike in all columns over the blocks
    placed = rows.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n_blocks)).cast("int"))
    anchors = (rows.filter(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("label", "q", "dim")).alias("m"))
               .select("id", F.col("m.label").alias("label"), F.col("m.dim").alias("dim"), F.col("m.q").alias("q"))
               .withColumn("ask", F.pmod(F.xxhash64("id"), F.lit(n_asks)).cast("int")))
    none = F.lit(None).cast("array<long>")
    to_blocks = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))
    to_asks = F.explode(F.sequence(F.lit(0), F.lit(n_asks - 1)))
    gives = placed.select("id", "label", "dim", "q", none.alias("lo"), none.alias("hi"), F.lit(False).alias("asks"),
                          "block", to_asks.alias("ask"))

    def best_positives(asks: dict, has: dict) -> Iterator[tuple]:
        for part, s in scores(asks["q"], has["q"]):
            ok = has["id"][None] != asks["id"][part][:, None]
            i, j = np.nonzero(first_of_rows(s, ok, positives))
            yield asks["id"][part][i], has["id"][j], s[i, j]

    def best_negatives(asks: dict, has: dict) -> Iterator[tuple]:
        for part, s in scores(asks["q"], has["q"]):
            ok = (has["id"][None] != asks["id"][part][:, None]) & (has["label"][None] != asks["label"][part][:, None])
            take = np.zeros(s.shape, bool)
            for w in range(positives):
                lo, hi = (np.array([x[w] if w < len(x) else end for x in asks[c][part]], np.int64)[:, None]
                          for c, end in (("lo", 1), ("hi", 0)))
                take |= first_of_rows(s, ok & (s >= lo) & (s <= hi), negatives)
            i, j = np.nonzero(take)
            yield asks["id"][part][i], has["id"][j], s[i, j]

    # rows meet anchors of their own label only, in blocks, however many rows a label holds
    same = (anchors.select("id", "label", "dim", "q", none.alias("lo"), none.alias("hi"), F.lit(True).alias("asks"),
                           to_blocks.alias("block"), "ask")
            .unionByName(gives).groupBy("label", "dim", "block", "ask").applyInArrow(_meet(best_positives, POSITIVE), PAIRS))
    firsts = cut_lineage(_sorted_stream(same).mapInArrow(_first_positives(positives, low, high), PAIRS + ", lo long, hi long"))
    windows = firsts.groupBy("anchor").agg(F.collect_list(F.struct("lo", "hi")).alias("w"))
    asking = (anchors.join(windows, F.col("id") == F.col("anchor"))
              .select("id", "label", "dim", "q", F.transform("w", lambda x: x["lo"]).alias("lo"),
                      F.transform("w", lambda x: x["hi"]).alias("hi"), F.lit(True).alias("asks"),
                      to_blocks.alias("block"), "ask"))
    other = asking.unionByName(gives).groupBy("dim", "block", "ask").applyInArrow(_meet(best_negatives, NEGATIVE), PAIRS)
    return _sorted_stream(firsts.drop("lo", "hi").unionByName(other)).mapInArrow(
        _open_windows(negatives, low, high), "anchor_id long, positive_id long, rank int, negative_id long, "
        "positive_score long, negative_score long")


PAIRS = "anchor long, score long, kind int, id long"


def _pairs(found: list[tuple], kind: int) -> pa.Table:
    anchor, other, score = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*found) if found else ((), (), ())))
    return pa.table({"anchor": anchor, "score": score, "kind": np.full(len(anchor), kind, np.int32), "id": other})


def _meet(f, kind: int):
    """A group of anchors and candidates (by ascending id) through ``f``; groups of one side are empty."""
    def side(g: pa.Table) -> dict:
        t = g.sort_by("id")
        return {"id": t["id"].to_numpy(), "label": t["label"].to_numpy(),
                "q": codes(t["q"], t["dim"][0].as_py()), "lo": t["lo"].to_pylist(), "hi": t["hi"].to_pylist()}

    def run(key: tuple[pa.Scalar, ...], g: pa.Table) -> pa.Table:
        asks = g["asks"].to_numpy(zero_copy_only=False)
        if not asks.any() or asks.all():
            return _pairs([], kind)
        return _pairs(list(f(side(g.filter(pa.array(asks))), side(g.filter(pa.array(~asks))))), kind)
    return run


def _sorted_stream(pairs: DataFrame) -> DataFrame:
    """Secondary sort: anchors dealt to partitions, rows in the order of the packed key."""
    return pairs.repartition("anchor").sortWithinPartitions("anchor", F.desc("score"), "kind", "id")


def _first_positives(positives: int, low: int, high: int):
    """The first positives of each anchor, with the windows they open."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, seen = None, 0
        for b in batches:
            keep = []
            for r, a in enumerate(b.column(0).to_pylist()):
                if a != anchor:
                    anchor, seen = a, 0
                if seen < positives:
                    keep.append(r)
                seen += 1
            first = b.take(pa.array(keep, pa.int64()))
            w = [window_of(p, low, high) for p in first.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*first.columns, *(pa.array([x[k] for x in w], pa.int64()) for k in (0, 1))],
                names=["anchor", "score", "kind", "id", "lo", "hi"])
    return run


def _open_windows(negatives: int, low: int, high: int):
    """The iterator over the sorted stream: positives open windows, negatives go to those they hit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, windows = None, []
        for b in batches:
            out = []
            for a, score, kind, other in zip(*[c.to_pylist() for c in b.columns]):
                if a != anchor:
                    anchor, windows = a, []
                if kind == POSITIVE:
                    windows.append([other, score, *window_of(score, low, high), 0])
                    continue
                for w in windows:
                    if w[4] < negatives and w[2] <= score <= w[3]:
                        w[4] += 1
                        out.append((a, w[0], w[4], other, w[1], score))
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if k == 2 else pa.int64()) for k, c in enumerate(cols)],
                names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])
    return run


SQL = """
with e as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (
  select a.vec_id as a, a.label = b.label as same, b.vec_id as b, cast(list_inner_product(a.q, b.q) as bigint) as s
  from e a join e b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
pos as (
  select a, b, s from p where same qualify row_number() over (partition by a order by s desc, b) <= 5),
neg as (
  select pos.a, pos.b as pb, pos.s as ps, p.b as nb, p.s as ns,
         row_number() over (partition by pos.a, pos.b order by p.s desc, p.b) as rank
  from pos join p on p.a = pos.a and not p.same and 30 * pos.s <= 100 * p.s and 100 * p.s <= 90 * pos.s)
select a as anchor_id, pb as positive_id, cast(rank as integer) as rank, nb as negative_id,
       ps as positive_score, ns as negative_score
from neg where rank <= 10
"""
