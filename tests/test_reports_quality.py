"""A1-A4 report semantics and E1-E5 table-rule checks."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from stockflow.operators import quality as dq
from stockflow.operators import reports as rp
from stockflow.sources import schemas

T = dt.datetime(2024, 1, 31, 12, 0, 0)


def prods(spark, n=12):
    return spark.createDataFrame([(p, f"SKU-{p:02d}", f"p{p}", Decimal("1.00"), None, 5, "N" if p == 3 else "Y")
                                  for p in range(1, n + 1)], schemas.PRODUCTS)


def test_stock_health_status(spark):
    st = spark.createDataFrame([(1, 1, 0, T), (2, 1, 5, T), (3, 1, 6, T), (99, 1, 0, T)], schemas.PRODUCT_STOCK)
    wh = spark.createDataFrame([(1, "W", None)], schemas.WAREHOUSES)
    got = sorted((r.sku, r.stock_status) for r in rp.stock_health(st, prods(spark), wh).collect())
    assert got == [("SKU-01", "OUT OF STOCK"), ("SKU-02", "LOW STOCK"), ("SKU-03", "HEALTHY")]


def test_top_moving_ties_and_orphans(spark):
    rows = [(i, p, 1, "ISSUE", -5, T - dt.timedelta(days=1), "u") for i, p in enumerate(range(1, 12))]
    rows += [(100, 99, 1, "ISSUE", -500, T, "u"),            # unknown product: dropped
             (101, 12, 1, "ISSUE", -500, T - dt.timedelta(days=31), "u"),   # outside the window
             (102, 12, 1, "RECEIPT", 900, T, "u")]
    log = spark.createDataFrame(rows, schemas.STOCK_TXN_LOG)
    got = [r.sku for r in rp.top_moving_products(log, prods(spark), T).collect()]
    assert got == [f"SKU-{p:02d}" for p in range(1, 11)]     # 11 tied: the lowest 10 skus


def test_monthly_consumption(spark):
    log = spark.createDataFrame([(1, 1, 1, "ISSUE", -5, T, "u"), (2, 1, 2, "ISSUE", -6, T, "u"),
                                 (3, 1, 1, "ISSUE", -1, T + dt.timedelta(days=1), "u"),
                                 (4, 1, 1, "ADJUSTMENT", 4, T, "u"), (5, 77, 1, "ISSUE", -3, T, "u")],
                                schemas.STOCK_TXN_LOG)
    got = sorted((r.sku, r.txn_month, r.units_issued) for r in rp.monthly_consumption(log, prods(spark)).collect())
    assert got == [("SKU-01", "2024-01", 11), ("SKU-01", "2024-02", 1)]


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, 1, 5, T), (1, 1, -1, T), (2, 1, None, None)],
                               "product_id long, warehouse_id long, qty_on_hand long, last_updated timestamp_ntz")
    dup = dq.dq_duplicate_keys(df, ["product_id", "warehouse_id"]).collect()
    assert [(r.product_id, r.n) for r in dup] == [(1, 2)]
    chk = dq.dq_check_violations(df, "qty_nonneg", "qty_on_hand >= 0", ["product_id", "warehouse_id"]).collect()
    assert [(r.rule_name, r.row_key) for r in chk] == [("qty_nonneg", "1|1")]   # NULL passes
    miss = dq.dq_missing_required(df, ["product_id", "qty_on_hand"], ["product_id", "warehouse_id"], "t").collect()
    assert [(r.row_key, r.column_name) for r in miss] == [("2|1", "qty_on_hand")]
    child = spark.createDataFrame([(1, 10), (2, None), (3, 11)], "id long, parent_id long")
    parent = spark.createDataFrame([(10,)], "pid long")
    orph = dq.dq_orphans(child, ["parent_id"], parent, ["pid"]).collect()
    assert [r.id for r in orph] == [3]                  # NULL FK is valid


def test_apply_defaults(spark):
    df = spark.createDataFrame([(1, "SKU-1", "a", Decimal("2.50"), None, None)],
                               "product_id long, sku string, product_name string, unit_price decimal(10,2), "
                               "supplier_id long, active_flag string")
    out = dq.apply_defaults(df, "products", T).collect()[0]
    assert (out.reorder_min, out.active_flag) == (10, None)   # omitted -> default; explicit NULL stays
    log = dq.apply_defaults(spark.createDataFrame([(1, 1, 1, "ISSUE", -1)], "log_id long, product_id long, "
                                                  "warehouse_id long, txn_type string, qty_change long"),
                            "stock_txn_log", T, "clerk").collect()[0]
    assert (log.txn_time, log.performed_by) == (T, "clerk")
