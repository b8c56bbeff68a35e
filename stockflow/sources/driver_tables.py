"""Inventory view of the driver's TPC-H-ish tables (deterministic mapping, see FIXTURES.md §2).

Each function reads only the parquet columns it needs (Catalyst prunes the scan) and returns a
DataFrame in the canonical schema of ``schemas.py``. The matching DuckDB text of every view is in
``stockflow.plans.oracle`` - keep the two in step.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.functions.exprs import ts_lit
from stockflow.functions.running import dense_ids

# Fixed parameters of the mapping (FIXTURES.md §2).
EVENTS_AS_OF = dt.datetime(2024, 1, 31, 12, 0, 0)      # as_of for the events ledger
LINEITEM_AS_OF = dt.datetime(2001, 8, 1, 0, 0, 0)      # as_of for the lineitem ledger
STOCK_SNAPSHOT_TIME = dt.datetime(2024, 1, 1, 0, 0, 0)
SCAN_TIMES = (dt.datetime(2024, 1, 12), dt.datetime(2024, 1, 22))   # reorder scans during the movement run
ACTOR = "INVENTORY_APP"
N_REGIONS = 5   # TPC-H defines exactly five regions (keys 0-4) at every scale


# Schemas of the driver tables we read (explicit: no footer sampling, stable types).
DRIVER_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": ("p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
             "p_retailprice DOUBLE"),
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                 "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                 "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
    "events": ("event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
               "props STRING"),
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def suppliers(spark, sf_dir) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").cast("long").alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        (F.lit(1) + F.col("s_suppkey") % 14).cast("int").alias("lead_time_days"),
        F.lit(None).cast("string").alias("contact_email"))


def warehouses(spark, sf_dir) -> DataFrame:
    r = read(spark, sf_dir, "region")
    return r.select(F.col("r_regionkey").cast("long").alias("warehouse_id"),
                    F.col("r_name").alias("warehouse_name"),
                    F.lit(None).cast("string").alias("location"))


def products(spark, sf_dir) -> DataFrame:
    p = read(spark, sf_dir, "part")
    k = F.col("p_partkey").cast("long")
    n = read(spark, sf_dir, "supplier").agg(F.max("s_suppkey").cast("long") + 1).scalar()   # keys run from 0
    return p.select(
        k.alias("product_id"),
        F.concat(F.lit("SKU-"), k.cast("string")).alias("sku"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
        F.when(k % 17 == 0, F.lit(None).cast("long")).otherwise(k % n).alias("supplier_id"),
        F.col("p_size").cast("long").alias("reorder_min"),
        F.when(k % 10 == 3, F.lit("N")).otherwise(F.lit("Y")).alias("active_flag"))


def product_stock(spark, sf_dir) -> DataFrame:
    """One stock row per (part, region): every part is stocked in each of the five regions.

    The fan-out is a fixed 5 per part (not a join), kept only where the region exists.
    """
    p = read(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("product_id"))
    rows = p.select("product_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(N_REGIONS - 1).cast("long")))
                    .alias("warehouse_id"))
    rows = rows.join(warehouses(spark, sf_dir).select("warehouse_id"), "warehouse_id", "left_semi")
    return rows.select(
        "product_id", "warehouse_id",
        ((F.col("product_id") * 7 + F.col("warehouse_id") * 13) % 60).cast("long").alias("qty_on_hand"),
        ts_lit(STOCK_SNAPSHOT_TIME).alias("last_updated"))


def _event_units() -> F.Column:
    return F.greatest(F.lit(1).cast("long"), F.ceil(F.col("value") / 10).cast("long"))


def ledger_events(spark, sf_dir) -> DataFrame:
    """Dense ledger from ``events``: purchase/view/click = ISSUE, signup = RECEIPT, error = ADJUSTMENT."""
    e = read(spark, sf_dir, "events")
    u = _event_units()
    et = F.col("event_type")
    txn_type = (F.when(et.isin("purchase", "view", "click"), F.lit("ISSUE"))
                .when(et == "signup", F.lit("RECEIPT")).when(et == "error", F.lit("ADJUSTMENT")))
    qty = (F.when(txn_type == "ISSUE", -u).when(txn_type == "RECEIPT", 2 * u).otherwise(u))
    return e.select(
        F.col("event_id").cast("long").alias("log_id"),
        F.col("user_id").cast("long").alias("product_id"),
        (F.col("event_id") % 5).cast("long").alias("warehouse_id"),
        txn_type.alias("txn_type"), qty.cast("long").alias("qty_change"),
        F.col("ts").cast("timestamp_ntz").alias("txn_time"),
        F.lit(ACTOR).alias("performed_by"))


def ledger_lineitem(spark, sf_dir) -> DataFrame:
    """Large ledger from ``lineitem``: returned lines (R) are ADJUSTMENT, the rest ISSUE.

    ``log_id`` = l_orderkey * 16 + l_linenumber is not unique (the source repeats that pair);
    the reports that read this ledger never use it.
    """
    li = read(spark, sf_dir, "lineitem")
    is_adj = F.col("l_returnflag") == "R"
    q = F.col("l_quantity").cast("long")
    return li.select(
        (F.col("l_orderkey") * 16 + F.col("l_linenumber")).cast("long").alias("log_id"),
        F.col("l_partkey").cast("long").alias("product_id"),
        (F.col("l_suppkey") % 5).cast("long").alias("warehouse_id"),
        F.when(is_adj, F.lit("ADJUSTMENT")).otherwise(F.lit("ISSUE")).alias("txn_type"),
        F.when(is_adj, q).otherwise(-q).alias("qty_change"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("txn_time"),
        F.lit(ACTOR).alias("performed_by"))


def movements(spark, sf_dir) -> DataFrame:
    """The events ledger read as requests: ISSUE = order, RECEIPT = receipt, ADJUSTMENT = restock.

    Some requests are odd, as a real batch has them: orders of NULL or 0 units, negative receipts.
    """
    e = read(spark, sf_dir, "events")
    u, i = _event_units(), F.col("event_id")
    et = F.col("event_type")
    kind = (F.when(et.isin("purchase", "view", "click"), F.lit("ORDER"))
            .when(et == "signup", F.lit("RECEIPT")).when(et == "error", F.lit("RESTOCK")))
    qty = (F.when(i % 97 == 0, F.lit(None)).when((i % 89 == 0) & (kind != "RECEIPT"), F.lit(0))
           .when((kind == "RECEIPT") & (i % 7 == 0), -2 * u).when(kind == "RECEIPT", 2 * u).otherwise(u))
    return e.select(
        i.cast("long").alias("request_id"),
        F.col("ts").cast("timestamp_ntz").alias("request_time"),
        F.col("user_id").cast("long").alias("product_id"),
        (i % 5).cast("long").alias("warehouse_id"),
        kind.alias("kind"), qty.cast("long").alias("qty"))


def movement_keys(spark, sf_dir) -> DataFrame:
    return movements(spark, sf_dir).select("product_id", "warehouse_id").distinct()


def movement_opening(spark, sf_dir) -> DataFrame:
    """Opening stock of the movement run: 0 to 79 units for the (product, warehouse) pairs it touches;
    one pair in eleven has no stock row yet."""
    p, w = F.col("product_id"), F.col("warehouse_id")
    return movement_keys(spark, sf_dir).filter((p + 2 * w) % 11 != 0).select(
        "product_id", "warehouse_id", ((p * 37 + w * 13) % 80).cast("long").alias("qty_on_hand"),
        ts_lit(STOCK_SNAPSHOT_TIME).alias("last_updated"))


def movement_scans(spark, sf_dir) -> DataFrame:
    """The reorder scans of the movement run, as rows of its sequence: at a scan's time, before the
    movements of that instant, every pair is looked at."""
    return movement_keys(spark, sf_dir).select(
        F.lit(-1).cast("long").alias("request_id"), F.explode(F.array(*[ts_lit(t) for t in SCAN_TIMES])).alias("request_time"),
        "product_id", "warehouse_id", F.lit("SCAN").alias("kind"), F.lit(None).cast("long").alias("qty"))


def receipts(spark, sf_dir) -> DataFrame:
    """The receipts of the events ledger as a batch of their own, with negative quantities, missing
    ones, and products and warehouses that do not exist."""
    lg = ledger_events(spark, sf_dir).filter(F.col("txn_type") == "RECEIPT")
    i, q = F.col("log_id"), F.col("qty_change")
    return lg.select(i.alias("receipt_id"), (F.col("product_id") + F.when(i % 13 == 0, 1_000_000_000).otherwise(0)).alias("product_id"),
                     F.when(i % 17 == 0, F.lit(99)).otherwise(F.col("warehouse_id")).cast("long").alias("warehouse_id"),
                     F.when(i % 11 == 0, F.lit(None)).when(i % 7 == 0, -3 * q).otherwise(q).cast("long").alias("qty"),
                     F.col("txn_time").alias("received_at"))


def orders_after(spark, sf_dir) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    st = F.col("o_orderstatus")
    return o.select(
        F.col("o_orderkey").cast("long").alias("order_id"),
        (F.col("o_custkey") % 5).cast("long").alias("warehouse_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("order_date"),
        F.when(st == "F", "FULFILLED").when(st == "O", "PLACED").when(st == "P", "CANCELLED")
        .alias("status"))


def orders_before(spark, sf_dir) -> DataFrame:
    """Status before the cancellations: a cancelled (P) order was FULFILLED if its key is even."""
    a = orders_after(spark, sf_dir)
    return a.withColumn("status", F.when(
        F.col("status") == "CANCELLED",
        F.when(F.col("order_id") % 2 == 0, F.lit("FULFILLED")).otherwise(F.lit("PLACED")))
        .otherwise(F.col("status")))


#: The order in which order items are numbered: every column that tells two of them apart.
ITEM_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_suppkey", "l_shipdate")


def order_items(spark, sf_dir) -> DataFrame:
    """One item per lineitem, numbered densely in the order of ``ITEM_ORDER`` (the natural pair of
    order and line number repeats in the source, see the duplicate-key check)."""
    li = dense_ids(read(spark, sf_dir, "lineitem").select(*ITEM_ORDER), ITEM_ORDER, "order_item_id")
    return li.select(
        "order_item_id", F.col("l_orderkey").cast("long").alias("order_id"),
        F.col("l_partkey").cast("long").alias("product_id"),
        F.col("l_quantity").cast("long").alias("qty_ordered"))


def unnumbered_items(spark, sf_dir) -> DataFrame:
    """Order items for results that show no item id (the id is NULL, and nothing is sorted)."""
    return order_lines(spark, sf_dir).select(
        F.lit(None).cast("long").alias("order_item_id"), "order_id", "product_id", "qty_ordered")


def order_lines(spark, sf_dir) -> DataFrame:
    """Raw order lines keyed by their natural (order, line number) pair."""
    li = read(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").cast("long").alias("order_id"),
                     F.col("l_linenumber").cast("long").alias("line_number"),
                     F.col("l_partkey").cast("long").alias("product_id"),
                     F.col("l_quantity").cast("long").alias("qty_ordered"))
