"""Golden values of the source module's demo (seed rows, ten orders, scan, receipt), SURVEY §5."""


from pyspark.sql import functions as F

from stockflow.operators import alerts as al
from stockflow.operators import forecast as fc
from stockflow.operators import movements as mv
from stockflow.operators import reports as rp
from stockflow.session import cut_lineage
from stockflow.sources import seed

T0 = seed.DEMO_TIME


def run_demo(spark, qty, reorder_min):
    t = seed.seed_tables(spark, reorder_min_1=reorder_min)
    adm = cut_lineage(mv.admit_movements(seed.demo_orders(spark, qty), t["product_stock"]))
    ledger = mv.movement_ledger(adm)
    stock_after = mv.closing_stock(adm, t["product_stock"])
    raised = cut_lineage(al.alert_timeline(al.updates_from_admission(adm), t["products"]))
    trig = al.alert_suggested_qty(raised, ledger, t["products"], t["suppliers"]).collect()
    scan = fc.reorder_scan(stock_after, t["products"], t["suppliers"], ledger, T0).collect()
    # receipt of 100 units after the scan
    stock_after = cut_lineage(stock_after)
    adm2 = cut_lineage(mv.admit_movements(seed.demo_receipt(spark), stock_after))
    upd2 = al.updates_from_admission(adm2)
    scan_alerts = fc.reorder_scan(stock_after, t["products"], t["suppliers"], ledger, T0) \
        .withColumn("resolved_flag", F.lit("N"))
    resolved_scan = al.resolve_alerts_on_receipt(scan_alerts, upd2, t["products"]).collect()
    trig_alerts = al.alert_suggested_qty(raised, ledger, t["products"], t["suppliers"])
    resolved_trig = al.resolve_alerts_on_receipt(trig_alerts, upd2, t["products"]).collect()
    final = {(r.product_id, r.warehouse_id): r.qty_on_hand for r in mv.closing_stock(adm2, stock_after).collect()}
    keys = spark.createDataFrame([(1, 1)], "product_id long, warehouse_id long")
    fcast = fc.forecast_reorder_qty(keys, ledger, t["products"], t["suppliers"], T0).collect()[0].suggested_qty
    health = {r.sku: (r.qty_on_hand, r.stock_status)
              for r in rp.stock_health(stock_after, t["products"], t["warehouses"]).collect()}
    return dict(adm=sorted(adm.collect(), key=lambda r: r.request_id), trig=trig, scan=scan,
                resolved_scan=resolved_scan, resolved_trig=resolved_trig, final=final, fcast=fcast,
                health=health, ledger=ledger, products=t["products"])


def test_demo_as_seeded(spark):
    r = run_demo(spark, 8, 15)
    assert all(x.accepted for x in r["adm"])
    assert r["health"]["SKU-1001"] == (20, "HEALTHY")
    assert r["health"]["SKU-1002"] == (60, "HEALTHY")
    assert r["trig"] == [] and r["scan"] == []
    assert r["final"][(1, 1)] == 120
    assert r["fcast"] == 480
    a3 = rp.monthly_consumption(r["ledger"], r["products"]).collect()
    assert [(x.sku, x.txn_month, x.units_issued) for x in a3] == [("SKU-1001", "2024-03", 80)]
    a4 = rp.top_moving_products(r["ledger"], r["products"], T0).collect()
    assert [(x.sku, x.units_issued_30d) for x in a4] == [("SKU-1001", 80)]


def test_demo_qty_12(spark):
    r = run_demo(spark, 12, 15)
    acc = [x.accepted for x in r["adm"]]
    assert acc == [True] * 8 + [False, False]
    assert r["adm"][8].reject_reason == "INSUFFICIENT_STOCK"
    assert r["adm"][8].message == "Insufficient stock: available 4, requested 12"
    assert r["health"]["SKU-1001"] == (4, "LOW STOCK")
    assert [(a.alert_id, a.qty_on_hand, a.suggested_qty) for a in r["trig"]] == [(8, 4, 504)]
    assert [(a.qty_on_hand, a.suggested_qty) for a in r["scan"]] == [(4, 576)]
    assert r["final"][(1, 1)] == 104
    assert [a.resolved_flag for a in r["resolved_scan"]] == ["Y"]
    assert [a.resolved_flag for a in r["resolved_trig"]] == ["Y"]
    assert r["fcast"] == 576


def test_demo_min_25(spark):
    r = run_demo(spark, 8, 25)
    assert r["health"]["SKU-1001"] == (20, "LOW STOCK")
    assert [(a.alert_id, a.qty_on_hand, a.suggested_qty) for a in r["trig"]] == [(10, 20, 432)]
    assert [(a.qty_on_hand, a.suggested_qty) for a in r["scan"]] == [(20, 480)]
    assert r["final"][(1, 1)] == 120
    assert [a.resolved_flag for a in r["resolved_scan"]] == ["Y"]
    assert [a.resolved_flag for a in r["resolved_trig"]] == ["Y"]


def test_report_views_with_sql(spark):
    """The demo's closing queries, as SQL over the registered report views."""
    from stockflow.plans.views import register_report_views
    t = seed.seed_tables(spark)
    adm = cut_lineage(mv.admit_movements(seed.demo_orders(spark, 8), t["product_stock"]))
    tables = dict(t, product_stock=mv.closing_stock(adm, t["product_stock"]), stock_txn_log=mv.movement_ledger(adm))
    names = register_report_views(spark, tables, T0, prefix="demo_")
    assert set(names) == {"demo_stock_health", "demo_monthly_consumption", "demo_top_moving_products"}
    health = spark.sql("SELECT sku, qty_on_hand, stock_status FROM demo_stock_health ORDER BY sku").collect()
    assert [tuple(r) for r in health] == [("SKU-1001", 20, "HEALTHY"), ("SKU-1002", 60, "HEALTHY")]
    mc = spark.sql("SELECT * FROM demo_monthly_consumption ORDER BY sku, txn_month").collect()
    assert [(r.sku, r.txn_month, r.units_issued) for r in mc] == [("SKU-1001", "2024-03", 80)]
