"""The four reports as named temporary views, for users who query them with SQL.

``register_report_views`` binds the report functions to a set of inventory tables and an
``as_of`` clock; ``spark.sql("SELECT * FROM stock_health ORDER BY sku")`` then plans exactly as
the DataFrame call does (a view is its logical plan).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from stockflow.functions.exprs import DEFAULT_LEAD_TIME_DAYS, DEFAULT_LOOKBACK_DAYS, SAFETY_FACTOR_DEN, SAFETY_FACTOR_NUM
from stockflow.operators import reports as rp

REPORT_VIEWS = ("stock_health", "open_reorder_alerts", "monthly_consumption", "top_moving_products")


def register_report_views(spark: SparkSession, tables: dict[str, DataFrame], as_of: dt.datetime,
                          prefix: str = "") -> list[str]:
    """Register the reports over ``tables`` (keys: products, warehouses, suppliers,
    product_stock, stock_txn_log, low_stock_alerts; missing inputs skip their report)."""
    t = tables
    built = {}
    if {"product_stock", "products", "warehouses"} <= t.keys():
        built["stock_health"] = rp.stock_health(t["product_stock"], t["products"], t["warehouses"])
    if {"low_stock_alerts", "products", "warehouses", "suppliers"} <= t.keys():
        built["open_reorder_alerts"] = rp.open_reorder_alerts(t["low_stock_alerts"], t["products"],
                                                              t["warehouses"], t["suppliers"])
    if {"stock_txn_log", "products"} <= t.keys():
        built["monthly_consumption"] = rp.monthly_consumption(t["stock_txn_log"], t["products"])
        built["top_moving_products"] = rp.top_moving_products(t["stock_txn_log"], t["products"], as_of)
    for name, df in built.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in built]


#: Body of the SQL table function: the forecast of every stocked pair, with exact integer ceiling.
FORECAST_SQL = """
CREATE OR REPLACE TEMPORARY FUNCTION forecast_reorder_qty(lookback_days INT DEFAULT {default_days})
RETURNS TABLE (product_id BIGINT, warehouse_id BIGINT, suggested_qty BIGINT)
RETURN
  WITH days AS (
    SELECT product_id, warehouse_id, CAST(txn_time AS DATE) AS txn_day, sum(abs(qty_change)) AS daily_qty
    FROM {p}stock_txn_log
    WHERE txn_type = 'ISSUE' AND txn_time >= {as_of} - make_dt_interval(forecast_reorder_qty.lookback_days)
    GROUP BY ALL),
  weighed AS (
    SELECT *, CAST(forecast_reorder_qty.lookback_days - datediff(CAST({as_of} AS DATE), txn_day) AS BIGINT) AS weight FROM days),
  sums AS (
    SELECT product_id, warehouse_id, sum(daily_qty * weight) AS wsum, sum(weight) AS wden FROM weighed GROUP BY ALL)
  SELECT k.product_id, k.warehouse_id,
         CASE WHEN coalesce(wden, 0) = 0 THEN 0L
              ELSE (wsum * coalesce(lead_time_days, {lead}) * {num} + wden * {den} - 1) div (wden * {den}) END
  FROM (SELECT DISTINCT product_id, warehouse_id FROM {p}product_stock) k
  LEFT JOIN sums USING (product_id, warehouse_id)
  LEFT JOIN {p}products USING (product_id) LEFT JOIN {p}suppliers USING (supplier_id)
"""


def register_forecast_function(spark: SparkSession, tables: dict[str, DataFrame], as_of: dt.datetime, prefix: str = "fc_") -> None:
    """``SELECT * FROM forecast_reorder_qty([lookback_days])`` over ``product_stock``, ``stock_txn_log``, ``products``
    and ``suppliers``, for SQL users: B4 for every stocked pair as of ``as_of``.

    The tables become temporary views under ``prefix``; the function is temporary too.
    """
    for name in ("product_stock", "stock_txn_log", "products", "suppliers"):
        tables[name].createOrReplaceTempView(prefix + name)
    spark.sql(FORECAST_SQL.format(p=prefix, as_of=f"timestamp_ntz'{as_of.isoformat(sep=' ')}'", default_days=DEFAULT_LOOKBACK_DAYS,
                                  lead=DEFAULT_LEAD_TIME_DAYS, num=SAFETY_FACTOR_NUM, den=SAFETY_FACTOR_DEN))
