"""Query registry: every operator of the inventory engine bound to the driver's tables.

Each entry is ``(spark, sf_dir) -> DataFrame`` and reads the whole tables (no id subsets, caps
or samples). The DuckDB text of the same result is in ``stockflow.plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.operators import alerts as al
from stockflow.operators import forecast as fc
from stockflow.operators import movements as mv
from stockflow.operators import quality as dq
from stockflow.operators import reports as rp
from stockflow.sources import driver_tables as dt_
from stockflow.functions.exprs import window_start
from stockflow.plans.views import register_forecast_function
from stockflow.session import cut_lineage, ensure_checkpoint_dir
from stockflow.streaming import aggregates as sa
from stockflow.streaming import finite as fs
from stockflow.streaming import stateful as ss
from stockflow.sources.driver_tables import ACTOR, EVENTS_AS_OF, LINEITEM_AS_OF

KEY = ["product_id", "warehouse_id"]


# -- shared pieces --------------------------------------------------------------------------

def _dims(spark, d):
    return dt_.products(spark, d), dt_.suppliers(spark, d), dt_.warehouses(spark, d)


def admitted(spark, d) -> DataFrame:
    """C1 over the events movements with the movement opening stock (one consumer)."""
    return mv.admit_movements(dt_.movements(spark, d), dt_.movement_opening(spark, d))


def sequence(spark, d, scans: bool = False) -> DataFrame:
    """The admitted batch for several consumers (alert rules, ledger, forecasts), with its chunks:
    materialised once in the shared checkpoint folder, so none of them runs the admission again.
    ``scans`` puts the reorder scans of the run into the sequence."""
    m = dt_.movements(spark, d)
    if scans:
        m = m.unionByName(dt_.movement_scans(spark, d))
    return cut_lineage(mv.admit_sequence(m, dt_.movement_opening(spark, d)))


def movement_log(spark, d) -> DataFrame:
    return mv.movement_ledger(admitted(spark, d), ACTOR)


def scan_alerts(spark, d) -> DataFrame:
    """B5 alerts on the stock snapshot, as open alert rows (no id: keyed by pair)."""
    p, s, _ = _dims(spark, d)
    return fc.reorder_scan(dt_.product_stock(spark, d), p, s, dt_.ledger_events(spark, d),
                           EVENTS_AS_OF).withColumn("resolved_flag", F.lit("N"))


def alerts_table(spark, d, seq: DataFrame | None = None) -> DataFrame:
    """``low_stock_alerts`` after the movement run with its scans: alerts of both paths."""
    p, s, _ = _dims(spark, d)
    seq = sequence(spark, d, scans=True) if seq is None else seq
    return al.low_stock_alerts(al.updates_from_admission(seq), p, s, mv.movement_ledger(seq, ACTOR), whole_log=True)


def _restock(spark, d, items: DataFrame) -> tuple:
    return dt_.orders_before(spark, d), dt_.orders_after(spark, d), items


# -- A: reports -----------------------------------------------------------------------------

def q_stock_health(spark, d):
    p, _, w = _dims(spark, d)
    return rp.stock_health(dt_.product_stock(spark, d), p, w)


def q_open_reorder_alerts(spark, d):
    p, s, w = _dims(spark, d)
    return rp.open_reorder_alerts(alerts_table(spark, d), p, w, s)


def q_monthly_consumption(spark, d):
    return rp.monthly_consumption(dt_.ledger_lineitem(spark, d), dt_.products(spark, d))


def q_top_moving_products(spark, d):
    return rp.top_moving_products(dt_.ledger_lineitem(spark, d), dt_.products(spark, d), LINEITEM_AS_OF)


def q_top_moving_products_events(spark, d):
    return rp.top_moving_products(dt_.ledger_events(spark, d), dt_.products(spark, d), EVENTS_AS_OF)


# -- B: forecast ----------------------------------------------------------------------------

def q_daily_issue_qty(spark, d):
    return fc.daily_issue_qty(dt_.ledger_events(spark, d), EVENTS_AS_OF)


def q_weighted_daily_avg(spark, d):
    return fc.weighted_daily_avg(fc.daily_issue_qty(dt_.ledger_events(spark, d), EVENTS_AS_OF))


def q_product_lead_time(spark, d):
    p, s, _ = _dims(spark, d)
    return fc.product_lead_time(p, s)


def q_forecast_reorder_qty(spark, d):
    p, s, _ = _dims(spark, d)
    return fc.forecast_reorder_qty(dt_.product_stock(spark, d), dt_.ledger_events(spark, d), p, s, EVENTS_AS_OF)


def q_reorder_scan(spark, d):
    p, s, _ = _dims(spark, d)
    return fc.reorder_scan(dt_.product_stock(spark, d), p, s, dt_.ledger_events(spark, d), EVENTS_AS_OF)


# -- C: movements ---------------------------------------------------------------------------

def q_order_admission(spark, d):
    return admitted(spark, d)


def q_order_outputs(spark, d):
    return mv.order_outputs(admitted(spark, d), ACTOR)["ledger"]


def q_order_outputs_orders(spark, d):
    return mv.order_outputs(admitted(spark, d), ACTOR)["orders"]


def q_order_outputs_items(spark, d):
    return mv.order_outputs(admitted(spark, d), ACTOR)["order_items"]


def q_closing_stock(spark, d):
    return mv.closing_stock(admitted(spark, d), dt_.movement_opening(spark, d))


def q_receive_stock(spark, d):
    p, _, w = _dims(spark, d)
    return mv.receive_stock(dt_.product_stock(spark, d), dt_.receipts(spark, d), p, w)


def q_receive_stock_ledger(spark, d):
    p, _, w = _dims(spark, d)
    return mv.receipt_ledger(mv.judge_receipts(dt_.product_stock(spark, d), dt_.receipts(spark, d), p, w), ACTOR)


def q_ledger_append(spark, d):
    return mv.ledger_append(None, movement_log(spark, d), EVENTS_AS_OF, ACTOR)


def q_cancel_restock(spark, d):
    return mv.cancel_restock(*_restock(spark, d, dt_.unnumbered_items(spark, d)), dt_.product_stock(spark, d),
                             LINEITEM_AS_OF, ACTOR)["stock"]


def q_cancel_restock_ledger(spark, d):
    return mv.cancel_restock(*_restock(spark, d, dt_.order_items(spark, d)), dt_.product_stock(spark, d),
                             LINEITEM_AS_OF, ACTOR)["ledger"]


def q_cancel_restock_alerts(spark, d):
    """C4 as updates into D1 and D2: the scan's open alerts, and those the restocks raise (pairs the
    scan leaves out), with what the restocks resolve."""
    p, stock = dt_.products(spark, d), dt_.product_stock(spark, d)
    updates = mv.cancel_updates(*_restock(spark, d, dt_.order_items(spark, d)), stock, LINEITEM_AS_OF)
    scanned = scan_alerts(spark, d)
    old = al.resolve_alerts_on_receipt(scanned, updates, p).select(
        F.lit("SCAN").alias("raised_by"), F.lit(None).cast("long").alias("order_item_id"), *KEY, "qty_on_hand", "resolved_flag")
    new = al.raise_low_stock_alerts(updates, p, scanned).select(
        F.lit("RESTOCK").alias("raised_by"), F.col("alert_id").alias("order_item_id"), *KEY, "qty_on_hand", "resolved_flag")
    return old.unionByName(new)


def q_stock_position(spark, d):
    return mv.stock_position(dt_.movement_opening(spark, d), mv.movement_ledger(sequence(spark, d), ACTOR))


# -- D: alerts ------------------------------------------------------------------------------

def q_raise_low_stock_alerts(spark, d):
    p, s, _ = _dims(spark, d)
    seq = sequence(spark, d)
    raised = cut_lineage(al.raise_low_stock_alerts(al.updates_from_admission(seq), p, scan_alerts(spark, d)))
    return al.alert_suggested_qty(raised, mv.movement_ledger(seq, ACTOR), p, s, issued=al.ISSUED)


def q_resolve_alerts_on_receipt(spark, d):
    """D2 on alerts of both paths: what the run left open meets the restocks of the cancelled orders."""
    p = dt_.products(spark, d)
    seq = sequence(spark, d, scans=True)
    closing = mv.closing_stock(seq, dt_.movement_opening(spark, d))
    updates = mv.cancel_updates(*_restock(spark, d, dt_.order_items(spark, d)), closing, LINEITEM_AS_OF)
    return al.resolve_alerts_on_receipt(alerts_table(spark, d, seq), updates, p)


def q_alert_timeline(spark, d):
    p = dt_.products(spark, d)
    seq = sequence(spark, d)
    return al.alert_timeline(al.updates_from_admission(seq), p).drop(al.ISSUED)


def q_alert_suggested_qty(spark, d):
    p, s, _ = _dims(spark, d)
    seq = sequence(spark, d)
    raised = cut_lineage(al.alert_timeline(al.updates_from_admission(seq), p))
    return al.alert_suggested_qty(raised, mv.movement_ledger(seq, ACTOR), p, s, issued=al.ISSUED)


def q_low_stock_alerts(spark, d):
    return alerts_table(spark, d)


# -- E: table rules -------------------------------------------------------------------------

def _tables(spark, d) -> dict[str, DataFrame]:
    p, s, w = _dims(spark, d)
    return {"products": p, "suppliers": s, "warehouses": w, "product_stock": dt_.product_stock(spark, d),
            "orders": dt_.orders_after(spark, d), "order_items": dt_.order_items(spark, d),
            "stock_txn_log": dt_.ledger_events(spark, d), "low_stock_alerts": alerts_table(spark, d)}


def q_dq_duplicate_keys(spark, d):
    return dq.dq_duplicate_keys(dt_.order_lines(spark, d), ["order_id", "line_number"])


def q_dq_declared_keys(spark, d):
    """E1 over every declared key of the eight tables, UNIQUE(sku) included, and over one that the
    source does not declare: a pair with several open alerts (each scan raises again)."""
    t = _tables(spark, d)
    t["open_alerts"] = t["low_stock_alerts"].filter("resolved_flag = 'N'")
    keys = {**dq.DECLARED_KEYS, "low_stock_alerts.open_pair": ("open_alerts", KEY)}
    parts = []
    for name, (tab, cols) in sorted(keys.items()):
        parts.append(dq.dq_duplicate_keys(t[tab], cols).select(
            F.lit(name).alias("key_name"), F.concat_ws("|", *[F.col(c).cast("string") for c in cols]).alias("row_key"), "n"))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def q_dq_inactive_references(spark, d):
    """E2 with the active products as the parent: order items of products no longer active."""
    active = dt_.products(spark, d).filter("active_flag = 'Y'")
    return dq.dq_orphans(dt_.order_items(spark, d), ["product_id"], active, ["product_id"]).select(
        "order_item_id", "order_id", "product_id", "qty_ordered")


def q_dq_missing_supplier(spark, d):
    """E4 with the optional supplier of a product taken as required."""
    return dq.dq_missing_required(dt_.products(spark, d), [*dq.required_columns("products"), "supplier_id"],
                                  ["product_id"], "products")


_TABLE_KEYS = {"products": ["product_id"], "suppliers": ["supplier_id"], "warehouses": ["warehouse_id"],
               "product_stock": KEY, "orders": ["order_id"], "order_items": ["order_item_id"],
               "stock_txn_log": ["log_id"], "low_stock_alerts": ["alert_id"]}


def q_dq_orphans(spark, d):
    t = _tables(spark, d)
    fks = dict(dq.FOREIGN_KEYS)
    # Undeclared references of the ledger and the alerts (no FK in the source) are checked as well.
    for tab in ("stock_txn_log", "low_stock_alerts"):
        fks[f"{tab}.product_id"] = (tab, ["product_id"], "products", ["product_id"])
        fks[f"{tab}.warehouse_id"] = (tab, ["warehouse_id"], "warehouses", ["warehouse_id"])
    parts = []
    for name, (child, fk, parent, pk) in sorted(fks.items()):
        o = dq.dq_orphans(t[child], fk, t[parent], pk)
        parts.append(o.select(F.lit(name).alias("fk_name"),
                              F.concat_ws("|", *[F.col(c).cast("string") for c in _TABLE_KEYS[child]]).alias("row_key")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def q_dq_check_violations(spark, d):
    t = _tables(spark, d)
    parts = [dq.dq_check_violations(t[tab], name, pred, keys)
             for name, (tab, pred, keys) in sorted(dq.CHECK_RULES.items())]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def q_dq_rule_violations(spark, d):
    """All CHECK, NOT NULL and length rules of the eight tables, one pass over each; and the rules of
    ``order_items`` on the raw order requests, odd ones included."""
    t = _tables(spark, d)
    keys = dict(_TABLE_KEYS)
    m = dt_.movements(spark, d).filter("kind = 'ORDER'")
    requests = m.select(F.col("request_id").alias("order_item_id"), F.col("request_id").alias("order_id"), "product_id",
                        F.col("qty").alias("qty_ordered"))
    out = dq.broken_rules(requests, "order_requests", dq.row_rules("order_items"), ["order_item_id"])
    for name in sorted(t):
        out = out.unionByName(dq.broken_rules(t[name], name, dq.row_rules(name), keys[name]))
    return out


def q_dq_negative_positions(spark, d):
    """E3 on derived data: positions of the raw events ledger applied to the opening stock
    without admission - the rows where the stock CHECK (qty_on_hand >= 0) would have failed."""
    pos = mv.stock_position(dt_.movement_opening(spark, d), dt_.ledger_events(spark, d))
    return dq.dq_check_violations(pos, "product_stock.qty_on_hand_nonneg", "qty_on_hand >= 0", ["log_id"])


def q_dq_missing_required(spark, d):
    t = _tables(spark, d)
    parts = [dq.dq_missing_required(t[name], dq.required_columns(name), _TABLE_KEYS[name], name)
             for name in sorted(t)]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def q_apply_defaults(spark, d):
    p = dt_.products(spark, d).drop("reorder_min", "active_flag")
    return dq.apply_defaults(p, "products", EVENTS_AS_OF, ACTOR)


def q_ledger_append_restock(spark, d):
    """C3 onto existing rows: restock rows without time and user join the events ledger, numbered
    on from its last id in item order."""
    rows = q_cancel_restock_ledger(spark, d).drop("txn_time", "performed_by")
    return mv.ledger_append(dt_.ledger_events(spark, d), rows, EVENTS_AS_OF, ACTOR, number_by=["log_id"])


def q_apply_defaults_stock(spark, d):
    stock = dt_.product_stock(spark, d).drop("qty_on_hand", "last_updated")
    return dq.apply_defaults(stock, "product_stock", EVENTS_AS_OF, ACTOR)


def q_apply_defaults_orders(spark, d):
    return dq.apply_defaults(dt_.orders_after(spark, d).drop("status"), "orders", LINEITEM_AS_OF, ACTOR)


def q_apply_defaults_ledger(spark, d):
    log = dt_.ledger_events(spark, d).drop("txn_time", "performed_by")
    return dq.apply_defaults(log, "stock_txn_log", EVENTS_AS_OF, ACTOR)


# -- the day-partitioned ledger and the SQL surface ------------------------------------------

STORED_DAYS = 7     # lookback of the queries on the stored ledger, of about 30 days


def _stored_ledger(spark, d) -> DataFrame:
    """The events ledger written by C3 in day partitions, read from the first day of the lookback on."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledger-{uuid.uuid4().hex}"
    mv.write_ledger(mv.ledger_append(None, dt_.ledger_events(spark, d), EVENTS_AS_OF, ACTOR), path)
    return mv.read_ledger(spark, path, since=window_start(EVENTS_AS_OF, STORED_DAYS))


def q_daily_issue_qty_stored(spark, d):
    """B1 on the stored ledger: partitions of earlier days are not read."""
    return fc.daily_issue_qty(_stored_ledger(spark, d), EVENTS_AS_OF, STORED_DAYS)


def q_top_moving_products_stored(spark, d):
    """A4 on the stored ledger."""
    return rp.top_moving_products(_stored_ledger(spark, d), dt_.products(spark, d), EVENTS_AS_OF, STORED_DAYS)


def q_sql_forecast(spark, d):
    """B4 from SQL: the table function with its default lookback and with one of 7 days."""
    p, s, _ = _dims(spark, d)
    tables = {"product_stock": dt_.product_stock(spark, d), "stock_txn_log": dt_.ledger_events(spark, d), "products": p, "suppliers": s}
    register_forecast_function(spark, tables, EVENTS_AS_OF)
    return spark.sql("SELECT 30 AS lookback, * FROM forecast_reorder_qty() UNION ALL SELECT 7, * FROM forecast_reorder_qty(7)")


# -- S: finite streams ----------------------------------------------------------------------

def q_stream_daily_issue(spark, d):
    """S2 replayed in update mode: the last value of every day."""
    rows = fs.replay(dt_.ledger_events(spark, d), "txn_time", sa.stream_daily_issue, "update")
    return fs.latest(rows, [*KEY, "window_start"])


def q_stream_monthly_consumption(spark, d):
    """S3 replayed: the live report after the last slice."""
    p = dt_.products(spark, d)
    rows = fs.replay(dt_.ledger_events(spark, d), "txn_time", lambda s: sa.stream_monthly_consumption(s, p), "update")
    return fs.latest(rows, ["sku", "txn_month"])


def q_stream_order_admission(spark, d):
    """S4 replayed: the C1 columns of every request, from opening balances as initial state."""
    p, s, _ = _dims(spark, d)
    rows = fs.replay(dt_.movements(spark, d), "request_time", lambda m: ss.stream_order_admission(
        ss.inventory_events(m, dt_.movement_opening(spark, d), p, s)))
    return rows.drop("batch_id")


def q_stream_alerts(spark, d):
    """S1 replayed: alert events, with the scan's alerts on the snapshot open at the start."""
    p, s, _ = _dims(spark, d)
    known = scan_alerts(spark, d).join(dt_.movement_keys(spark, d), KEY, "left_semi").withColumn(
        "alert_id", -F.col("product_id") * 5 - F.col("warehouse_id") - 1)
    rows = fs.replay(dt_.movements(spark, d), "request_time", lambda m: ss.stream_alerts(
        ss.inventory_events(m, dt_.movement_opening(spark, d), p, s, open_alerts=known)))
    return rows.drop("batch_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stock_health": q_stock_health,
    "open_reorder_alerts": q_open_reorder_alerts,
    "monthly_consumption": q_monthly_consumption,
    "top_moving_products": q_top_moving_products,
    "top_moving_products_events": q_top_moving_products_events,
    "daily_issue_qty": q_daily_issue_qty,
    "weighted_daily_avg": q_weighted_daily_avg,
    "product_lead_time": q_product_lead_time,
    "forecast_reorder_qty": q_forecast_reorder_qty,
    "reorder_scan": q_reorder_scan,
    "order_admission": q_order_admission,
    "order_outputs": q_order_outputs,
    "order_outputs_orders": q_order_outputs_orders,
    "order_outputs_items": q_order_outputs_items,
    "closing_stock": q_closing_stock,
    "receive_stock": q_receive_stock,
    "receive_stock_ledger": q_receive_stock_ledger,
    "ledger_append": q_ledger_append,
    "cancel_restock": q_cancel_restock,
    "cancel_restock_ledger": q_cancel_restock_ledger,
    "cancel_restock_alerts": q_cancel_restock_alerts,
    "stock_position": q_stock_position,
    "raise_low_stock_alerts": q_raise_low_stock_alerts,
    "resolve_alerts_on_receipt": q_resolve_alerts_on_receipt,
    "alert_timeline": q_alert_timeline,
    "alert_suggested_qty": q_alert_suggested_qty,
    "low_stock_alerts": q_low_stock_alerts,
    "dq_duplicate_keys": q_dq_duplicate_keys,
    "dq_orphans": q_dq_orphans,
    "dq_check_violations": q_dq_check_violations,
    "dq_negative_positions": q_dq_negative_positions,
    "dq_rule_violations": q_dq_rule_violations,
    "daily_issue_qty_stored": q_daily_issue_qty_stored,
    "top_moving_products_stored": q_top_moving_products_stored,
    "sql_forecast": q_sql_forecast,
    "dq_missing_required": q_dq_missing_required,
    "apply_defaults": q_apply_defaults,
    "dq_declared_keys": q_dq_declared_keys,
    "dq_inactive_references": q_dq_inactive_references,
    "dq_missing_supplier": q_dq_missing_supplier,
    "ledger_append_restock": q_ledger_append_restock,
    "apply_defaults_stock": q_apply_defaults_stock,
    "apply_defaults_orders": q_apply_defaults_orders,
    "apply_defaults_ledger": q_apply_defaults_ledger,
    "stream_daily_issue": q_stream_daily_issue,
    "stream_monthly_consumption": q_stream_monthly_consumption,
    "stream_order_admission": q_stream_order_admission,
    "stream_alerts": q_stream_alerts,
}
