"""The four reports (A1-A4) of the source's reporting views, as DataFrame functions.

Aggregates run on ``product_id`` before the product dimension is joined (sku is unique, so
grouping by sku + name equals grouping by product): the join then sees one row per group.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.functions.exprs import DEFAULT_LOOKBACK_DAYS, TOP_K, stock_status, ts_lit, window_start


def stock_health(stock: DataFrame, products: DataFrame, warehouses: DataFrame) -> DataFrame:
    """A1: every stock row with product and warehouse names and its three-way status."""
    p = products.select("product_id", "sku", "product_name", "reorder_min")
    w = warehouses.select("warehouse_id", "warehouse_name")
    j = (stock.select("product_id", "warehouse_id", "qty_on_hand", "last_updated")
         .join(p, "product_id", "inner").join(w, "warehouse_id", "inner"))
    return j.select("sku", "product_name", "warehouse_name", "qty_on_hand", "reorder_min",
                    stock_status("qty_on_hand", "reorder_min").alias("stock_status"), "last_updated")


def open_reorder_alerts(alerts: DataFrame, products: DataFrame, warehouses: DataFrame,
                        suppliers: DataFrame) -> DataFrame:
    """A2: unresolved alerts with product, warehouse and (optional) supplier details."""
    a = alerts.filter(F.col("resolved_flag") == "N").select(
        "alert_id", "product_id", "warehouse_id", "qty_on_hand", "suggested_qty", "raised_on")
    p = products.select("product_id", "sku", "product_name", "supplier_id")
    w = warehouses.select("warehouse_id", "warehouse_name")
    s = suppliers.select("supplier_id", "supplier_name", "lead_time_days")
    j = (a.join(p, "product_id", "inner").join(w, "warehouse_id", "inner")
         .join(s, "supplier_id", "left"))
    return j.select("alert_id", "sku", "product_name", "warehouse_name", "qty_on_hand",
                    "suggested_qty", "supplier_name", "lead_time_days", "raised_on")


def monthly_consumption(log: DataFrame, products: DataFrame) -> DataFrame:
    """A3: issued units per product and calendar month ('yyyy-MM'); orphan ledger rows drop out."""
    g = (log.filter(F.col("txn_type") == "ISSUE")
         .groupBy("product_id", F.date_format("txn_time", "yyyy-MM").alias("txn_month"))
         .agg(F.sum(F.abs("qty_change")).cast("long").alias("units_issued")))
    p = products.select("product_id", "sku", "product_name")
    return g.join(p, "product_id", "inner").select("sku", "product_name", "txn_month", "units_issued")


def top_moving_products(log: DataFrame, products: DataFrame, as_of: dt.datetime,
                        days: int = DEFAULT_LOOKBACK_DAYS, k: int = TOP_K) -> DataFrame:
    """A4: the ``k`` products with most issued units since ``as_of - days`` (no upper bound).

    Ties are broken by sku ascending. ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject:
    each task keeps its own top k, so only k rows per task reach the final merge.
    """
    g = (log.filter((F.col("txn_type") == "ISSUE") & (F.col("txn_time") >= ts_lit(window_start(as_of, days))))
         .groupBy("product_id").agg(F.sum(F.abs("qty_change")).cast("long").alias("units_issued_30d")))
    p = products.select("product_id", "sku", "product_name")
    return (g.join(p, "product_id", "inner")
            .select("sku", "product_name", "units_issued_30d")
            .orderBy(F.desc("units_issued_30d"), F.asc("sku")).limit(k))
