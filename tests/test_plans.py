"""Physical plan properties the operators rely on at scale (checked on sf0.001)."""

import re

import pytest

import __spark_entry__ as E
from stockflow.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    df = E.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString(), df


def test_time_window_pushed_into_scan(spark):
    p, _ = plan(spark, "top_moving_products")
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(l_shipdate", p)
    assert "TakeOrderedAndProject" in p                 # top-k without a global sort
    p, _ = plan(spark, "daily_issue_qty")
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts", p)


def test_scans_read_only_needed_columns(spark):
    p, _ = plan(spark, "monthly_consumption")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    lineitem = [s for s in schemas if "l_partkey" in s][0]
    assert "l_extendedprice" not in lineitem and "l_comment" not in lineitem and "l_tax" not in lineitem


def test_partial_aggregation_before_shuffle(spark):
    p, _ = plan(spark, "reorder_scan")
    assert "partial_sum" in p or re.search(r"HashAggregate\(keys=.*functions=\[partial_", p)


@pytest.mark.parametrize("name", ["stock_health", "monthly_consumption", "reorder_scan", "forecast_reorder_qty",
                                  "cancel_restock", "dq_duplicate_keys"])
def test_no_python_in_batch_plans(spark, name):
    p, _ = plan(spark, name)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "MapInPandas" not in p


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_python_only_as_the_admission_fold(spark, name):
    p, _ = plan(spark, name)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "MapInPandas" not in p
    python = set(re.findall(r"MapInArrow (\w+)", p))
    assert python <= {"_fold", "_transfers", "_walk"} and p.count("MapInArrow") <= 6


def test_admission_is_one_plan(spark):
    """Sums inside and over chunks are windows; broadcast are the segments of keys that span chunks."""
    from stockflow.operators import movements as mv
    from stockflow.sources import driver_tables as D
    df = mv.admit_movements(D.movements(spark, SF), D.movement_opening(spark, SF))
    p = df._jdf.queryExecution().executedPlan().toString()
    assert p.count("MapInArrow _fold") == 1 and "BatchEvalPython" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_alert_forecast_has_no_explode(spark):
    p, _ = plan(spark, "alert_suggested_qty")
    assert "Generate" not in p


def test_stored_ledger_is_pruned(spark):
    for name in ("daily_issue_qty_stored", "top_moving_products_stored"):
        p, _ = plan(spark, name)
        assert re.search(r"PartitionFilters: \[isnotnull\(txn_date", p) and "txn_date" in p


def test_rules_of_a_table_take_one_scan(spark):
    """All row rules of a table come from one pass; its counts are observed, not computed again."""
    from pyspark.sql import Observation
    from stockflow.operators import quality as dq
    from stockflow.sources import driver_tables as D
    obs = Observation("rules")
    m = D.movements(spark, SF).selectExpr("request_id AS order_item_id", "request_id AS order_id", "product_id", "qty AS qty_ordered")
    df = dq.broken_rules(m, "order_items", dq.row_rules("order_items"), ["order_item_id"], obs)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert p.count("Scan parquet") == 1 and "Exchange" not in p
    rows = df.collect()
    assert obs.get["rows"] == m.count() and len(rows) > 0
    for rule in {r.rule_name for r in rows}:
        assert obs.get[rule] == sum(r.rule_name == rule for r in rows)
    assert {(r.rule_name, r.kind) for r in rows} == {("qty_ordered_positive", "CHECK"), ("qty_ordered_required", "NOT NULL")}
    one = E.queries()["dq_rule_violations"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert one.count("supplier.parquet") <= 3       # its own rules, the highest key for products, the alerts' forecast


def test_length_rules(spark):
    from stockflow.operators import quality as dq
    df = spark.createDataFrame([(1, "x" * 120, 5, None), (2, "x" * 121, 5, "y" * 500), (3, None, None, "")],
                               "supplier_id long, supplier_name string, lead_time_days int, contact_email string")
    got = {(r.row_key, r.rule_name) for r in dq.broken_rules(df, "suppliers", dq.row_rules("suppliers"), ["supplier_id"]).collect()}
    assert got == {("2", "supplier_name_length"), ("2", "contact_email_length"), ("3", "supplier_name_required"), ("3", "lead_time_days_required")}


def test_forecast_function_from_sql(spark):
    """Named views of any tables, default and given lookback, filters from outside."""
    import datetime as dt
    from stockflow.plans.views import register_forecast_function
    from stockflow.sources import seed
    t = seed.seed_tables(spark)
    log = spark.createDataFrame([(1, 1, 1, "ISSUE", -80, seed.DEMO_TIME, "u"), (2, 1, 1, "ISSUE", -10, seed.DEMO_TIME - dt.timedelta(days=9), "u")],
                                "log_id long, product_id long, warehouse_id long, txn_type string, qty_change long, txn_time timestamp_ntz, performed_by string")
    register_forecast_function(spark, dict(t, stock_txn_log=log), seed.DEMO_TIME, prefix="seed_")
    one = spark.sql("SELECT suggested_qty FROM forecast_reorder_qty(7) WHERE product_id = 1 AND warehouse_id = 1").first()[0]
    assert one == 480                                  # 80 x 5 days x 1.2, the older day outside of the week
    both = spark.sql("SELECT suggested_qty FROM forecast_reorder_qty() WHERE product_id = 1").first()[0]
    assert both == -(-(80 * 30 + 10 * 21) * 5 * 6 // ((30 + 21) * 5))
    assert spark.sql("SELECT count(*) FROM forecast_reorder_qty()").first()[0] == t["product_stock"].count()
