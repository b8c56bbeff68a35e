"""Block admission (C1): order requests, receipts, restocks and scans in one sequence per key.

An order is admitted when the stock left by the earlier *admitted* movements of its key covers it,
and a rejected order consumes nothing, so the balance is not a cumulative sum. The sequence is cut
into chunks of a set number of rows (``functions.running``), and each (chunk, key) segment is
summarised by the sum of its movements and the lowest prefix of that sum. The summaries scan to

* the unconstrained balance ``U`` (admit everything) and its minimum so far,
* the reflected balance ``L = U - min(0, min U)``, a lower bound of the true balance ``B`` that a
  refill lifts again: ``B - L`` never exceeds the largest demand seen.

A segment whose incoming ``L`` covers its lowest prefix admits all its rows, whatever was rejected
before: its balances are sums. Only rows from the dip on in the other (tight) segments are folded one
by one, each segment on its own, from its incoming balance. Where a key has several tight segments,
each first becomes a function from incoming to outgoing balance (``transfer``), computed for all
segments at once; a walk over these functions, one row a segment, gives every incoming balance.
So no task meets more rows of a key than a chunk holds, even if all of a key's segments are tight.
"""

from __future__ import annotations

import pickle
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.functions.exprs import insufficient_message
from stockflow.functions.running import CHUNK, cut_into_chunks, earlier_segments, segment_window, with_carries
from stockflow.session import cut_lineage

KEY = ["product_id", "warehouse_id"]
SEGMENT = [CHUNK, *KEY]
ORDER_COLS = ["_is_req", "request_time", "request_id"]   # opening pseudo-row first, then arrival

# Reject reasons (the source raises an error in each case and leaves no trace).
NO_STOCK_ROW = "NO_STOCK_ROW"
INSUFFICIENT_STOCK = "INSUFFICIENT_STOCK"
INVALID_QTY = "INVALID_QTY"
NEGATIVE_STOCK = "NEGATIVE_STOCK"     # a receipt that would leave negative stock (CHECK >= 0)

SCAN = "SCAN"                         # a reorder scan looks at the stock at this point and moves nothing
PIECES = 64                           # cuts of a transfer function before its pieces are merged


class Transfer:
    """Outgoing balance of a run of movements as a function of the incoming one.

    Incoming balances lie in ``low .. low + width - 1``. Pieces ``[start, length, value]`` map start + x
    to value + x. Cutting a piece wherever its balances part would let pieces pile up although
    balances that have met stay together; so after some cuts the reached balances, merged, become
    the domain of a next stage, and the function is the chain of its stages.
    """

    def __init__(self, low: int, width: int):
        self.stages: list[list[list[int]]] = []
        self.pieces = [[low, width, low]]
        self.shift = 0                     # added to all values
        self.least, self.most = low, low + width - 1
        self.limit = PIECES

    def move(self, delta: int) -> None:
        """A supply (>= 0), or a demand that is met only by balances that cover it."""
        if delta >= 0 or self.least + delta >= 0:
            self.shift += delta
            self.least += delta
            self.most += delta
        elif self.most + delta >= 0:
            self._part(-delta)

    def _part(self, demand: int) -> None:
        at, out = demand - self.shift, []
        for start, length, value in self.pieces:
            if value >= at:
                out.append([start, length, value - demand])
            elif value + length <= at:
                out.append([start, length, value])
            else:
                k = at - value
                out.append([start, k, value])
                out.append([start + k, length - k, at - demand])
        self.pieces = out
        self.least = min(p[2] for p in out) + self.shift
        self.most = max(p[1] + p[2] for p in out) - 1 + self.shift
        if len(out) > self.limit:
            self._freeze()

    def _freeze(self) -> None:
        done = [[s, n, v + self.shift] for s, n, v in self.pieces]
        self.stages.append(done)
        reached: list[list[int]] = []
        for _, n, v in sorted(done, key=lambda p: p[2]):
            if reached and v <= reached[-1][0] + reached[-1][1]:
                reached[-1][1] = max(reached[-1][1], v + n - reached[-1][0])
            else:
                reached.append([v, n])
        self.pieces = [[v, n, v] for v, n in reached]
        self.shift, self.limit = 0, 2 * len(reached) + PIECES

    def pack(self) -> bytes:
        self._freeze()
        return pickle.dumps(self.stages)


def apply_transfer(packed: bytes, balance: int) -> int:
    for stage in pickle.loads(packed):
        start, _, value = stage[bisect_right(stage, [balance, float("inf")]) - 1]
        balance = value + balance - start
    return balance


def _groups(batches: Iterator[pa.RecordBatch], width: int):
    """Rows of sorted batches as (segment key, row) tuples."""
    for b in batches:
        for row in zip(*[c.to_pylist() for c in b.columns]):
            yield row[:width], row[width:]


def _transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One transfer function per segment from its rows in order (columns: segment, low, width, delta)."""
    cur, t, out = None, None, []

    def ship():
        return pa.RecordBatch.from_arrays(
            [pa.array(c, y) for c, y in zip(zip(*out), (pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
            names=[*SEGMENT, "transfer"])

    for seg, (low, width, delta) in _groups(batches, 3):
        if seg != cur:
            if cur is not None:
                out.append((*cur, t.pack()))
                if len(out) >= 100:
                    yield ship()
                    out = []
            cur, t = seg, Transfer(low, width)
        t.move(delta)
    if cur is not None:
        out.append((*cur, t.pack()))
        yield ship()


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Excess of the true over the reflected balance after each tight segment of a key, in order
    (columns: key, chunk, reflected balance in and out, transfer)."""
    cur, excess, out = None, 0, []
    for key, (chunk, low, low_out, transfer) in _groups(batches, 2):
        if key != cur:
            cur, excess = key, 0
        excess = apply_transfer(transfer, low + excess) - low_out
        out.append((chunk, *key, excess))
    if out:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, y) for c, y in zip(zip(*out), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
            names=[*SEGMENT, "excess_out"])


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Admission row by row inside tight segments (sorted by segment and order). The last columns are
    the row's change and the balance its segment starts from; they become balance before and verdict."""
    cur, bal = None, 0
    for b in batches:
        before, ok = [], []
        for *seg, delta, start in zip(*[b.column(c).to_pylist() for c in (*SEGMENT, "_delta", "_start")]):
            if seg != cur:
                cur, bal = seg, start
            before.append(bal)
            fits = delta >= 0 or bal + delta >= 0
            ok.append(fits)
            if fits:
                bal += delta
        yield pa.RecordBatch.from_arrays(
            [*b.columns[:-2], pa.array(before, pa.int64()), pa.array(ok, pa.bool_())],
            names=[*b.schema.names[:-2], "_before", "_ok"])


def admit_sequence(requests: DataFrame, stock: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    """C1 with the chunk of every row (``_chunk``), for consumers that go on in the same order; the
    columns are those of ``admit_movements``."""
    q = F.col("qty")
    req = requests.select("request_id", "request_time", *KEY, "kind", q.cast("long").alias("qty"), F.lit(1).alias("_is_req"))
    opening = stock.select(F.lit(None).cast("long").alias("request_id"), F.lit(None).cast("timestamp_ntz").alias("request_time"),
                           *KEY, F.lit("OPEN").alias("kind"), F.col("qty_on_hand").cast("long").alias("qty"),
                           F.lit(0).alias("_is_req"))
    kind = F.col("kind")
    invalid = kind.isin("ORDER", "RESTOCK") & (q.isNull() | (q <= 0)) | ((kind == "RECEIPT") & q.isNull())
    # A stock row exists from the opening row or the first receipt on that is not negative.
    births = (kind == "OPEN") | ((kind == "RECEIPT") & (q >= 0))
    change = (F.when(invalid | (kind == SCAN), F.lit(0)).when(kind == "ORDER", -q)
              .otherwise(q).cast("long"))
    seq = cut_into_chunks(req.unionByName(opening), KEY, ORDER_COLS, chunk_rows)

    # Level 1, inside segments: running sums of all changes, and of those since the row exists.
    w = segment_window(KEY, ORDER_COLS)
    rows = seq.select("*", invalid.alias("_invalid"), change.alias("_change"), births.cast("int").alias("_birth"))
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select("*", F.max("_birth").over(w).alias("_born"), F.coalesce(F.max("_birth").over(before), F.lit(0)).alias("_was"))
    rows = rows.withColumn("_live", F.when(F.col("_born") == 1, F.col("_change")).otherwise(0))
    local = rows.select("*", F.sum("_change").over(w).alias("_all"), F.sum("_live").over(w).alias("_part"))
    local = cut_lineage(local.select("*", F.min("_all").over(w).alias("_all_low"), F.min("_part").over(w).alias("_part_low")))

    # Level 2, over segments: existence, unconstrained balance and its minimum before each segment.
    seg = local.groupBy(*SEGMENT).agg(
        F.max("_birth").alias("birth"), F.sum("_change").alias("s_all"), F.sum("_live").alias("s_part"),
        F.min("_all").alias("m_all"), F.min("_part").alias("m_part"),
        F.max(-F.col("_change")).alias("demand"))
    ahead = earlier_segments(KEY)
    seg = (seg.withColumn("had", F.coalesce(F.max("birth").over(ahead), F.lit(0)))
           .withColumn("s", F.when(F.col("had") == 1, F.col("s_all")).otherwise(F.col("s_part")))
           .withColumn("m", F.when(F.col("had") == 1, F.col("m_all")).otherwise(F.col("m_part")))
           .withColumn("n_before", F.count(F.lit(1)).over(ahead))
           .withColumn("n_after", F.count(F.lit(1)).over(Window.partitionBy(*KEY).orderBy(CHUNK).rowsBetween(1, Window.unboundedFollowing)))
           .withColumn("u", F.coalesce(F.sum("s").over(ahead), F.lit(0)))
           .withColumn("top", F.greatest(F.coalesce(F.max("demand").over(ahead), F.lit(0)), F.lit(1))))
    seg = (seg.withColumn("dip", F.least(F.coalesce(F.min(F.col("u") + F.col("m")).over(ahead), F.lit(0)), F.lit(0)))
           .withColumn("low", (F.col("u") - F.col("dip")).cast("long"))
           .withColumn("low_out", (F.col("s") + F.greatest(F.col("low"), -F.col("m"))).cast("long"))
           .withColumn("tight", F.col("low") + F.least(F.lit(0), F.col("m")) < 0))
    # Keys of one segment need no more than their rows; of the others, one row a segment.
    chain = cut_lineage(seg.filter((F.col("n_before") > 0) | (F.col("n_after") > 0))
                        .select(*SEGMENT, "had", "low", "low_out", "tight", "top", "dip", "n_before"))
    entering = _entering(local, chain)
    carries = (chain.filter(F.col("n_before") > 0).join(entering, SEGMENT, "left")
               .select(*SEGMENT, F.col("had").alias("_had"), F.col("low").alias("_low"), F.col("excess").alias("_excess")))

    j = with_carries(local, carries, KEY)
    had = F.coalesce(F.col("_had"), F.lit(0)) == 1
    low = F.coalesce(F.col("_low"), F.lit(0))
    j = j.select("*", (had | (F.col("_was") == 1)).alias("_exists"), (had | (F.col("_born") == 1)).alias("_exists_after"),
                 F.when(had, F.col("_all")).otherwise(F.col("_part")).alias("_loc"),
                 F.when(had, F.col("_all_low")).otherwise(F.col("_part_low")).alias("_loc_low"),
                 F.when(had, F.col("_change")).otherwise(F.col("_live")).cast("long").alias("_delta"),
                 (low + F.coalesce(F.col("_excess"), F.lit(0))).alias("_enter"))
    j = j.filter(F.col("_is_req") == 1)
    dips = low + F.col("_loc_low") < 0
    keep = ["request_id", "request_time", *KEY, "kind", "qty", "_invalid", "_exists", "_exists_after", CHUNK]
    start = (F.col("_enter") + F.col("_loc") - F.col("_delta")).cast("long")
    sums = j.filter(~dips).select(*keep, "_delta", start.alias("_before"), F.lit(True).alias("_ok"))
    tight = j.filter(dips).select(*keep, F.col("_delta").alias("_d"), "_delta", start.alias("_start"))
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sums.select(*keep, "_delta").schema.fields)
    folded = (tight.repartition(*SEGMENT).sortWithinPartitions(*SEGMENT, "request_time", "request_id")
              .mapInArrow(_fold, kept.replace("_delta", "_d") + ", _before long, _ok boolean").withColumnRenamed("_d", "_delta"))
    return _verdicts(sums.unionByName(folded))


def _entering(local: DataFrame, chain: DataFrame) -> DataFrame:
    """``excess`` of the true over the reflected balance at the start of each segment of ``chain``
    (the segments of keys that span chunks; at most two a chunk)."""
    tight = chain.filter("tight")
    asked = F.broadcast(tight.select(*SEGMENT, "had", "low", F.when(F.col("dip") < 0, F.col("top")).otherwise(F.lit(1)).alias("width")))
    rows = (local.join(asked, SEGMENT)
            .select(*SEGMENT, *ORDER_COLS, "low", F.col("width").cast("long").alias("width"),
                    F.when(F.col("had") == 1, F.col("_change")).otherwise(F.col("_live")).cast("long").alias("delta")))
    types = "_chunk int, product_id long, warehouse_id long"
    transfers = (rows.repartition(*SEGMENT).sortWithinPartitions(*SEGMENT, *ORDER_COLS)
                 .select(*SEGMENT, "low", "width", "delta").mapInArrow(_transfers, types + ", transfer binary"))
    outs = (tight.join(transfers, SEGMENT).repartition(*KEY).sortWithinPartitions(*KEY, CHUNK)
            .select(*KEY, CHUNK, "low", "low_out", "transfer").mapInArrow(_walk, types + ", excess_out long"))
    last = F.last("excess_out", ignorenulls=True).over(earlier_segments(KEY))
    return chain.select(*SEGMENT).join(outs, SEGMENT, "left").select(*SEGMENT, F.coalesce(last, F.lit(0)).alias("excess"))


def _verdicts(rows: DataFrame) -> DataFrame:
    """Verdict and balances of every request from its balance before and whether it fits."""
    kind, q, exists = F.col("kind"), F.col("qty"), F.col("_exists")
    missing = (kind == "ORDER") & ~exists
    negative = (kind == "RECEIPT") & ~F.col("_exists_after")
    reason = (F.when(missing, NO_STOCK_ROW).when(F.col("_invalid"), INVALID_QTY).when(negative, NEGATIVE_STOCK)
              .when(~F.col("_ok") & (kind == "ORDER"), INSUFFICIENT_STOCK).when(~F.col("_ok"), NEGATIVE_STOCK))
    available = F.when(exists, F.col("_before"))
    return (rows.select("request_id", "request_time", *KEY, "kind", "qty", reason.isNull().alias("accepted"),
                        reason.alias("reject_reason"), available.cast("long").alias("available"),
                        F.when(F.col("_exists_after"), F.when(F.col("_ok"), F.col("_before") + F.col("_delta")).otherwise(F.col("_before")))
                        .cast("long").alias("qty_after"),
                        (reason.isNull() & exists & (kind != SCAN)).alias("stock_updated"), CHUNK)
            .withColumn("message", F.when(F.col("reject_reason") == INSUFFICIENT_STOCK, insufficient_message("available", "qty"))))


def admit_movements(requests: DataFrame, stock: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    """Apply order requests (and interleaved receipts, restocks and scans) in (request_time,
    request_id) order per (product, warehouse) against the opening ``stock``.

    Output per request: accepted, reject_reason (NO_STOCK_ROW, INSUFFICIENT_STOCK, INVALID_QTY,
    NEGATIVE_STOCK), available (stock before), qty_after, stock_updated (an UPDATE of an existing
    stock row happened - what the alert rules react to) and the rejection message.
    ``chunk_rows`` is the most rows of a key that one task meets (default ``running.CHUNK_ROWS``).
    """
    return admit_sequence(requests, stock, chunk_rows).drop(CHUNK)
