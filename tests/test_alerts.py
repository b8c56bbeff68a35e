"""Relational alert rules against a sequential simulation of the row triggers."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockflow.operators import alerts as al
from stockflow.operators import movements as mv
from stockflow.session import cut_lineage
from stockflow.sources import schemas
from tests.model import forecast, simulate
from tests.test_movements import T, mov, random_movements, stock

MINS = {1: 10, 2: 5, 3: 30, 4: 0}
LEADS = {1: 5, 2: 12}


def dims(spark):
    prods = spark.createDataFrame([(p, f"SKU-{p}", f"p{p}", Decimal("1.00"), 1 if p % 2 else 2 if p != 4 else None, m, "Y")
                                   for p, m in MINS.items()], schemas.PRODUCTS)
    sups = spark.createDataFrame([(s, f"s{s}", lt, None) for s, lt in LEADS.items()], schemas.SUPPLIERS)
    return prods, sups


def lead_of(p):
    sup = 1 if p % 2 else 2 if p != 4 else None
    return LEADS.get(sup, 7)


@pytest.mark.parametrize("seed", [11, 12])
@pytest.mark.parametrize("chunk", [1_000_000, 9])
def test_timeline_and_forecast_equal_model(spark, seed, chunk):
    rows = random_movements(seed, n=200)
    # spread over several days so the 30-day forecast window and day weights matter
    rows = [(i, m * 20, p, w, k, q) for i, m, p, w, k, q in rows]
    opening = [(1, 1, 15), (2, 1, 0), (3, 1, 40), (4, 1, 2)]
    prods, sups = dims(spark)
    spark.conf.set("stockflow.chunkRows", str(chunk))
    try:
        # as in a pipeline: the admitted batch and the raised alerts have several consumers, so
        # they are materialised once in the checkpoint folder
        adm = cut_lineage(mv.admit_sequence(mov(spark, rows), stock(spark, opening)))
        raised = cut_lineage(al.alert_timeline(al.updates_from_admission(adm), prods))
        got = {r.alert_id: r for r in al.alert_suggested_qty(raised, mv.movement_ledger(adm), prods, sups).collect()}
        fast = {r.alert_id: r for r in al.alert_suggested_qty(raised, mv.movement_ledger(adm), prods, sups,
                                                              issued=al.ISSUED).collect()}
    finally:
        spark.conf.unset("stockflow.chunkRows")
    assert fast == got
    ms = [dict(request_id=i, request_time=T + dt.timedelta(minutes=m), product_id=p, warehouse_id=w, kind=k, qty=q)
          for i, m, p, w, k, q in rows]
    _, ledger, alerts = simulate(ms, {(p, w): q for p, w, q in opening}, MINS)
    assert len(alerts) > 3
    assert set(got) == {a["alert_id"] for a in alerts}
    for a in alerts:
        g = got[a["alert_id"]]
        assert (g.product_id, g.warehouse_id, g.qty_on_hand, g.raised_on, g.resolved_flag) == \
            (a["product_id"], a["warehouse_id"], a["qty_on_hand"], a["raised_on"], a["resolved_flag"])
        visible = ledger[:a["_ledger_len"]]      # the trigger runs before its own ledger row exists
        exp = forecast(visible, (a["product_id"], a["warehouse_id"]), a["raised_on"], lead=lead_of(a["product_id"]))
        assert g.suggested_qty == exp, a


def test_open_alert_blocks_until_close(spark):
    prods, _ = dims(spark)
    upd = spark.createDataFrame([
        (1, 1, 1, T, 20, 8),                       # low, but a scan alert is open -> nothing
        (2, 1, 1, T + dt.timedelta(minutes=1), 8, 10),  # increase to exactly min: stays open
        (3, 1, 1, T + dt.timedelta(minutes=2), 10, 11), # increase above min: closes
        (4, 1, 1, T + dt.timedelta(minutes=3), 11, 9),  # low again -> new alert
        (5, 2, 1, T, 3, 4),                        # increase that stays at/below min, none open -> alert
    ], "seq long, product_id long, warehouse_id long, txn_time timestamp_ntz, qty_before long, qty_after long")
    open_ = spark.createDataFrame([(1, 1, "N")], "product_id long, warehouse_id long, resolved_flag string")
    got = sorted((r.alert_id, r.qty_on_hand, r.resolved_flag)
                 for r in al.raise_low_stock_alerts(upd, prods, open_).collect())
    assert got == [(4, 9, "N"), (5, 4, "N")]
    existing = spark.createDataFrame([(100, 1, 1, 8, 0, T, "N"), (101, 1, 1, 8, 0, T, "N"), (102, 2, 1, 3, 0, T, "N")],
                                     schemas.LOW_STOCK_ALERTS)
    res = {r.alert_id: r.resolved_flag for r in al.resolve_alerts_on_receipt(existing, upd, prods).collect()}
    assert res == {100: "Y", 101: "Y", 102: "N"}   # all open alerts of the pair, scan duplicates included


def test_open_reorder_alerts_report(spark):
    from stockflow.operators.reports import open_reorder_alerts
    prods, sups = dims(spark)
    wh = spark.createDataFrame([(1, "Main", None)], schemas.WAREHOUSES)
    a = spark.createDataFrame([(7, 4, 1, 0, 9, T, "N"), (8, 1, 1, 2, 3, T, "Y"), (9, 99, 1, 2, 3, T, "N")],
                              schemas.LOW_STOCK_ALERTS)
    got = [(r.alert_id, r.sku, r.supplier_name, r.lead_time_days) for r in open_reorder_alerts(a, prods, wh, sups).collect()]
    assert got == [(7, "SKU-4", None, None)]       # left join to supplier; resolved and orphan rows drop


@pytest.mark.parametrize("seed", [21, 22, 23])
def test_alerts_of_both_paths_equal_model(spark, seed, small_chunks):
    """Scans inside the movement sequence: their alerts always come, occupy the epoch, and are closed
    with the others; the log before the sequence counts for the forecast."""
    rows = [(i, m * 20, p, w, k, q) for i, m, p, w, k, q in random_movements(seed, n=200)]
    rnd = random.Random(seed)
    scans = [(1000 + i, rnd.randint(0, 12000), p, 1, "SCAN", None) for i in range(6) for p in (1, 2, 3, 4)]
    opening = [(1, 1, 15), (2, 1, 0), (3, 1, 40)]
    prods, sups = dims(spark)
    prods = prods.withColumn("active_flag", F.when(F.col("product_id") == 2, "N").when(F.col("product_id") == 4, F.lit(None)).otherwise("Y"))
    old = [dict(log_id=-50 + i, product_id=1 + i % 3, warehouse_id=1, txn_type="ISSUE", qty_change=-(i % 5) - 1,
                txn_time=T - dt.timedelta(hours=7 * i)) for i in range(40)]
    adm = cut_lineage(mv.admit_sequence(mov(spark, rows + scans), stock(spark, opening)))
    history = spark.createDataFrame([(o["log_id"], o["product_id"], 1, "ISSUE", o["qty_change"], o["txn_time"], "u") for o in old],
                                    schemas.STOCK_TXN_LOG)
    log = cut_lineage(mv.movement_ledger(adm).unionByName(history))
    got = al.low_stock_alerts(al.updates_from_admission(adm), prods, sups, log).collect()
    ms = [dict(request_id=i, request_time=T + dt.timedelta(minutes=m), product_id=p, warehouse_id=w, kind=k, qty=q)
          for i, m, p, w, k, q in rows + scans]
    _, ledger, alerts = simulate(ms, {(p, w): q for p, w, q in opening}, MINS, active={1, 3})
    want = []
    for a in alerts:
        f = forecast(old + ledger[:a["_ledger_len"]], (a["product_id"], a["warehouse_id"]), a["raised_on"], lead=lead_of(a["product_id"]))
        if a["_scan"]:
            f = max(f, MINS[a["product_id"]])
        want.append((a["product_id"], a["warehouse_id"], a["qty_on_hand"], f, a["raised_on"], a["resolved_flag"]))
    assert sorted(tuple(r)[1:] for r in got) == sorted(want)
    assert sorted(r.alert_id for r in got) == list(range(1, len(want) + 1))
    assert {a["_scan"] for a in alerts} == {True, False}
