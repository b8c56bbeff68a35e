"""Streaming forms of the day and month aggregates.

The same DataFrame expressions serve a batch frame and a streaming frame; the streaming
functions add the event-time watermark. ``withWatermark`` needs a zoned TIMESTAMP, so the
zone-less clock is read as UTC inside the stream, by its distance from the epoch and not by the
session's zone, and turned back into TIMESTAMP_NTZ the same way at the output. Rows later than the watermark are dropped (our rule: the source
system had no late-data notion).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["product_id", "warehouse_id"]

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def as_instant(ntz: str) -> F.Column:
    """A zone-less time read as UTC, whatever the session's zone."""
    return F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, {_EPOCH}, {ntz}))")


def as_clock(instant: str) -> F.Column:
    """An instant as zone-less UTC time, whatever the session's zone."""
    return F.expr(f"{_EPOCH} + make_dt_interval(0, 0, 0, unix_micros({instant}) / 1000000)")


def daily_issue_frame(ledger: DataFrame, time_col: str = "txn_time") -> DataFrame:
    """Issued units per (product, warehouse, day) as a 1-day tumbling event-time window."""
    w = F.window(F.col(time_col), "1 day")
    g = (ledger.filter(F.col("txn_type") == "ISSUE")
         .groupBy(*KEY, w.alias("_w"))
         .agg(F.sum(F.abs("qty_change")).cast("long").alias("daily_qty")))
    zoned = dict(ledger.dtypes)[time_col] == "timestamp"
    start = as_clock("_w.start") if zoned else F.col("_w.start")
    return g.select(*KEY, start.alias("window_start"), "daily_qty")


def stream_daily_issue(ledger_stream: DataFrame, watermark: str = "1 day") -> DataFrame:
    """Per-day issue quantity on a ledger stream; a day is emitted (append mode) once the
    watermark passes its end, so state is bounded by the days still open."""
    s = (ledger_stream.filter(F.col("txn_type") == "ISSUE")
         .withColumn("_ets", as_instant("txn_time"))
         .withWatermark("_ets", watermark))
    return daily_issue_frame(s, "_ets")


def stream_monthly_consumption(ledger_stream: DataFrame, products: DataFrame,
                               watermark: str = "31 days") -> DataFrame:
    """S3: the monthly consumption report maintained live (update mode).

    The product dimension is joined to the stream first (stream-static join), then units are
    summed per (product, month). The month start is the watermarked event-time column, so a
    month's state is dropped once the watermark has passed it.
    """
    p = products.select("product_id", "sku", "product_name")
    s = (ledger_stream.filter(F.col("txn_type") == "ISSUE")
         .withColumn("_first", F.trunc(F.to_date("txn_time"), "month").cast("timestamp_ntz"))
         .withColumn("_month", as_instant("_first")).drop("_first")
         .withWatermark("_month", watermark)
         .join(p, "product_id", "inner"))
    g = (s.groupBy("sku", "product_name", "_month")
         .agg(F.sum(F.abs("qty_change")).cast("long").alias("units_issued")))
    return g.select("sku", "product_name", F.date_format(as_clock("_month").cast("date"), "yyyy-MM").alias("txn_month"), "units_issued")
