"""Ordered sequences over many keys, cut into chunks of a set number of rows.

A per-key window sends every row of a key to one task; a key that holds half of the ledger would
run as one task. Here the whole table is range-sorted by (key, order) and cut into chunks of about
``CHUNK_ROWS`` rows, whatever the keys: a chunk holds many small keys, or a piece of a large one,
even when all its rows carry the same time. Everything that follows the order is computed in two
levels, in one plan for every key:

1. inside each (chunk, key) segment, many tasks of bounded size;
2. over the summaries of a key's segments, one row each. Only the first key of a chunk can go on from
   the chunk before, so the results of this level that matter (the carries) are at most one a
   chunk: a proven bound, and they are broadcast back to the rows.

The chunk number is fixed in the checkpoint, so a lost executor cannot change the cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.session import cut_lineage

CHUNK = "_chunk"
CHUNK_ROWS = 1_000_000                 # rows of a chunk, the most a task meets of one key
CHUNK_CONF = "stockflow.chunkRows"     # session setting overriding CHUNK_ROWS


def cut_into_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk_rows: int | None = None) -> DataFrame:
    """``df`` range-sorted by keys and order, with its chunk number in ``_chunk``.

    ``order`` must be a total order inside a key. Chunk numbers ascend along (keys, order). The cut
    holds for one job: checkpoint what is derived from it before it is read twice. Counting and
    sampling read ``df`` too, so a long pipeline should end in a checkpoint before.
    """
    return df.repartitionByRange(_chunks(df, chunk_rows), *keys, *order).withColumn(CHUNK, F.spark_partition_id())


def _chunks(df: DataFrame, chunk_rows: int | None = None) -> int:
    """The number of chunks that the rows of ``df`` need."""
    conf = df.sparkSession.conf
    if chunk_rows is None:
        chunk_rows = int(conf.get(CHUNK_CONF, str(CHUNK_ROWS)))
    return max(int(conf.get("spark.sql.shuffle.partitions")), -(-df.count() // chunk_rows))


def chunked(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk_rows: int | None = None) -> DataFrame:
    """``cut_into_chunks``, checkpointed."""
    return cut_lineage(cut_into_chunks(df, keys, order, chunk_rows))


def segment_window(keys: Sequence[str], order: Sequence[str]):
    """Running window inside a (chunk, key) segment."""
    return (Window.partitionBy(CHUNK, *keys).orderBy(*[F.col(c) for c in order])
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))


def earlier_segments(keys: Sequence[str]):
    """Window over the segments of a key before the current one."""
    return Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)


def with_carries(rows: DataFrame, carries: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with the carry columns of their segment; NULL where a key starts in the segment.

    ``carries`` holds at most one row a chunk (see the module text), so it is broadcast.
    """
    on = [CHUNK, *keys]
    right = carries.select(*[F.col(c).alias(f"_c_{c}") for c in on], *[c for c in carries.columns if c not in on])
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_c_{c}"))
    return rows.join(F.broadcast(right), cond, "left").drop(*[f"_c_{c}" for c in on])


def running_sums(rows: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """Add inclusive running sums ``out = sum(expr)`` per ``keys`` in ``order`` to rows that went
    through ``chunked`` (and perhaps lost some since: segments stay in order)."""
    keys = list(keys)
    w = segment_window(keys, order)
    local = rows.select("*", *[F.sum(e).over(w).alias(f"_loc_{o}") for o, e in values.items()])
    totals = rows.groupBy(CHUNK, *keys).agg(*[F.sum(e).alias(f"_tot_{o}") for o, e in values.items()])
    ahead = earlier_segments(keys)
    carries = (totals.select(CHUNK, *keys, F.count(F.lit(1)).over(ahead).alias("_before"),
                             *[F.sum(f"_tot_{o}").over(ahead).alias(f"_off_{o}") for o in values])
               .filter(F.col("_before") > 0).drop("_before"))
    joined = with_carries(local, carries, keys)
    zero = F.lit(0)
    return joined.select(*rows.columns, *[
        (F.coalesce(F.col(f"_off_{o}"), zero) + F.coalesce(F.col(f"_loc_{o}"), zero)).cast("long").alias(o) for o in values])


def dense_ids(df: DataFrame, order: Sequence[str], name: str, start: int = 1) -> DataFrame:
    """Number the rows ``start``, ``start + 1``, ... in ``order`` (a total order), without a window
    over all rows: range sort, rows per partition, and the sum of the partitions before. A partition
    holds about ``CHUNK_ROWS`` rows and is sorted where the range sort puts it.

    Numbers depend on the rows and their order alone, never on partitions or reruns.
    """
    cols = [F.col(c) for c in order]
    at = F.monotonically_increasing_id()                   # partition, then 33 bits of the row inside it
    ranged = cut_lineage(df.repartitionByRange(_chunks(df), *cols).sortWithinPartitions(*cols).withColumn("_row", at))
    ranged = ranged.select(*df.columns, F.shiftright("_row", 33).cast("int").alias(CHUNK),
                           (F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("_at"))
    sizes = ranged.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("_n"))
    ahead = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)       # one row a partition
    starts = sizes.select(CHUNK, F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    return (ranged.join(F.broadcast(starts), CHUNK)
            .withColumn(name, (F.col("_ahead") + F.col("_at") + F.lit(start - 1)).cast("long"))
            .drop("_ahead", "_at", CHUNK))
