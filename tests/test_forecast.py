"""B1-B5 edge cases (FIXTURES §3) and the exact ceiling."""

import datetime as dt
import math
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stockflow.functions.exprs import suggested_qty
from stockflow.operators import forecast as fc
from stockflow.sources import schemas
from decimal import Decimal

D1 = Decimal("1.00")

AS_OF = dt.datetime(2024, 1, 31, 12, 0, 0)
LOG = "log_id long, product_id long, warehouse_id long, txn_type string, qty_change long, txn_time timestamp_ntz, performed_by string"


def log(spark, rows):
    return spark.createDataFrame([(i + 1, p, w, t, q, ts, "u") for i, (p, w, t, q, ts) in enumerate(rows)], LOG)


def dims(spark, supplier_id=1, lead=5):
    prods = spark.createDataFrame([(1, "SKU-1", "p1", D1, supplier_id, 10, "Y")], schemas.PRODUCTS)
    sups = spark.createDataFrame([(1, "s", lead, None)], schemas.SUPPLIERS)
    return prods, sups


def suggest(spark, rows, lead=5, supplier_id=1, as_of=AS_OF):
    prods, sups = dims(spark, supplier_id, lead)
    keys = spark.createDataFrame([(1, 1)], "product_id long, warehouse_id long")
    return fc.forecast_reorder_qty(keys, log(spark, rows), prods, sups, as_of).collect()[0].suggested_qty


def test_no_history_is_zero(spark):
    assert suggest(spark, []) == 0


def test_only_day_30_weight_zero(spark):
    # 30 days before as_of, after the time-of-day cut: weight 0 -> sum of weights 0 -> 0
    assert suggest(spark, [(1, 1, "ISSUE", -50, AS_OF - dt.timedelta(days=30) + dt.timedelta(hours=1))]) == 0


def test_window_boundary(spark):
    cut = AS_OF - dt.timedelta(days=30)
    d = fc.daily_issue_qty(log(spark, [(1, 1, "ISSUE", -3, cut - dt.timedelta(seconds=1)),
                                       (1, 1, "ISSUE", -4, cut)]), AS_OF).collect()
    assert [(r.daily_qty, r.weight) for r in d] == [(4, 0)]


def test_future_rows_count_with_higher_weight(spark):
    d = fc.daily_issue_qty(log(spark, [(1, 1, "ISSUE", -2, AS_OF + dt.timedelta(days=2))]), AS_OF).collect()
    assert [(r.daily_qty, r.weight) for r in d] == [(2, 32)]


def test_idle_days_ignored_and_weights(spark):
    rows = [(1, 1, "ISSUE", -10, AS_OF), (1, 1, "ISSUE", -20, AS_OF - dt.timedelta(days=5))]
    w = fc.weighted_daily_avg(fc.daily_issue_qty(log(spark, rows), AS_OF)).collect()[0]
    assert (w.wsum, w.wden) == (10 * 30 + 20 * 25, 55)
    assert w.weighted_avg == pytest.approx(800 / 55)


def test_receipts_and_adjustments_ignored(spark):
    rows = [(1, 1, "RECEIPT", 10, AS_OF), (1, 1, "ADJUSTMENT", 5, AS_OF)]
    assert fc.daily_issue_qty(log(spark, rows), AS_OF).count() == 0


def test_lead_time_default(spark):
    prods, sups = dims(spark, supplier_id=None)
    prods2, _ = dims(spark, supplier_id=99)
    assert fc.product_lead_time(prods, sups).collect()[0].lead_time_days == 7
    assert fc.product_lead_time(prods2, sups).collect()[0].lead_time_days == 7


@pytest.mark.parametrize("wsum,wden,lead,expected", [(5, 3, 7, 14), (20, 3, 3, 24), (0, 4, 9, 0), (0, 0, 5, 0)])
def test_exact_ceiling(spark, wsum, wden, lead, expected):
    df = spark.createDataFrame([(wsum, wden, lead)], "wsum long, wden long, lead int")
    assert df.select(suggested_qty("wsum", "wden", "lead").alias("s")).collect()[0].s == expected


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10_000), st.integers(1, 400), st.integers(0, 60)), min_size=1, max_size=20))
def test_exact_ceiling_property(spark, cases):
    df = spark.createDataFrame(cases, "wsum long, wden long, lead int")
    got = [r.s for r in df.select(suggested_qty("wsum", "wden", "lead").alias("s")).collect()]
    assert got == [math.ceil(Fraction(a, b) * c * Fraction(6, 5)) for a, b, c in cases]


def test_scan_filters_and_greatest(spark):
    prods = spark.createDataFrame([(1, "SKU-1", "a", D1, 1, 10, "Y"), (2, "SKU-2", "b", D1, 1, 10, "N"),
                                   (3, "SKU-3", "c", D1, 1, 0, None), (4, "SKU-4", "d", D1, 1, 0, "Y")],
                                  schemas.PRODUCTS)
    _, sups = dims(spark)
    stock = spark.createDataFrame([(1, 1, 10, None), (2, 1, 0, None), (3, 1, 0, None), (4, 1, 0, None),
                                   (1, 2, 11, None)], schemas.PRODUCT_STOCK)
    out = fc.reorder_scan(stock, prods, sups, log(spark, []), AS_OF)
    got = sorted((r.product_id, r.warehouse_id, r.qty_on_hand, r.suggested_qty) for r in out.collect())
    # equal to reorder_min raises; inactive and NULL flag excluded; no history -> greatest(0, min)
    assert got == [(1, 1, 10, 10), (4, 1, 0, 0)]
    twice = out.unionByName(fc.reorder_scan(stock, prods, sups, log(spark, []), AS_OF))
    assert twice.count() == 4   # no dedupe between scans
