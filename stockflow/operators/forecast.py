"""Demand forecast and reorder suggestions.

The source computes the forecast with one correlated query per (product, warehouse) inside a row
loop. Here the whole ledger is aggregated once (partial aggregation before the shuffle, so a hot
product costs one pre-aggregated row per task and day) and joined to the keys that need it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.functions.exprs import (DEFAULT_LEAD_TIME_DAYS, DEFAULT_LOOKBACK_DAYS, day_weight,
                                       suggested_qty, ts_lit, window_start)

KEY = ["product_id", "warehouse_id"]


def daily_issue_qty(log: DataFrame, as_of: dt.datetime, lookback: int = DEFAULT_LOOKBACK_DAYS) -> DataFrame:
    """B1: issued units per (product, warehouse, calendar day) since ``as_of - lookback`` days.

    The window keeps the time of day and has no upper bound (later rows get weight > lookback).
    """
    start = window_start(as_of, lookback)
    issues = log.filter((F.col("txn_type") == "ISSUE") & (F.col("txn_time") >= ts_lit(start)))
    daily = (issues.groupBy(*KEY, F.to_date("txn_time").alias("txn_day"))
             .agg(F.sum(F.abs("qty_change")).cast("long").alias("daily_qty")))
    return daily.withColumn("weight", day_weight("txn_day", F.to_date(ts_lit(as_of)), lookback))


def weighted_daily_avg(daily: DataFrame) -> DataFrame:
    """B2: linear-weighted average over the days that have issues (idle days count for nothing)."""
    g = daily.groupBy(*KEY).agg(
        F.sum(F.col("daily_qty") * F.col("weight")).cast("long").alias("wsum"),
        F.sum("weight").cast("long").alias("wden"))
    return g.withColumn("weighted_avg", F.coalesce(
        F.col("wsum").cast("double") / F.nullif(F.col("wden"), F.lit(0)).cast("double"),
        F.lit(0.0)))


def product_lead_time(products: DataFrame, suppliers: DataFrame) -> DataFrame:
    """The supplier's lead time per product; no supplier row -> 7 days. Not filtered by activity."""
    p = products.select("product_id", "supplier_id")
    s = suppliers.select("supplier_id", "lead_time_days")
    return (p.join(s, "supplier_id", "left")
            .select("product_id", F.coalesce(F.col("lead_time_days"), F.lit(DEFAULT_LEAD_TIME_DAYS))
                    .cast("int").alias("lead_time_days")))


def forecast_sums(log: DataFrame, as_of: dt.datetime, lookback: int = DEFAULT_LOOKBACK_DAYS) -> DataFrame:
    """B1 + B2 as one two-level aggregate: (product, warehouse) -> wsum, wden."""
    return weighted_daily_avg(daily_issue_qty(log, as_of, lookback)).select(*KEY, "wsum", "wden")


def forecast_reorder_qty(keys: DataFrame, log: DataFrame, products: DataFrame, suppliers: DataFrame,
                         as_of: dt.datetime, lookback: int = DEFAULT_LOOKBACK_DAYS) -> DataFrame:
    """Suggested reorder quantity for every requested (product, warehouse) key.

    Total over the keys: a key without history gets 0. Integer-exact ceiling (see exprs).
    """
    k = keys.select(*KEY).dropDuplicates(KEY)
    sums = forecast_sums(log, as_of, lookback)
    lead = product_lead_time(products, suppliers)
    out = (k.join(sums, KEY, "left").join(lead, "product_id", "left")
           .withColumn("lead_time_days", F.coalesce("lead_time_days", F.lit(DEFAULT_LEAD_TIME_DAYS))))
    return out.select(*KEY, suggested_qty("wsum", "wden", "lead_time_days").alias("suggested_qty"))


def reorder_scan(stock: DataFrame, products: DataFrame, suppliers: DataFrame, log: DataFrame,
                 as_of: dt.datetime, lookback: int = DEFAULT_LOOKBACK_DAYS) -> DataFrame:
    """Every active (product, warehouse) at or below its reorder point becomes an alert with
    ``greatest(forecast, reorder_min)`` units. No dedupe: each scan raises again.
    """
    p = products.filter(F.col("active_flag") == "Y").select("product_id", "reorder_min")
    low = (stock.select(*KEY, "qty_on_hand").join(p, "product_id", "inner")
           .filter(F.col("qty_on_hand") <= F.col("reorder_min")))
    # Aggregate first: the partial aggregate shrinks the ledger to one row per key and day before
    # any shuffle; the low keys then meet one row per key.
    sums = forecast_sums(log, as_of, lookback)
    lead = product_lead_time(products, suppliers)
    out = (low.join(sums, KEY, "left").join(lead, "product_id", "left")
           .withColumn("lead_time_days", F.coalesce("lead_time_days", F.lit(DEFAULT_LEAD_TIME_DAYS))))
    return out.select(*KEY, "qty_on_hand",
                      F.greatest(suggested_qty("wsum", "wden", "lead_time_days"), F.col("reorder_min"))
                      .alias("suggested_qty"))
