"""A plain sequential model of the source procedures and triggers, for brute-force checks.

One movement at a time, exactly as the stored procedures and row triggers would run it.
"""

from __future__ import annotations

import datetime as dt
import math
from fractions import Fraction


def forecast(log, key, as_of, lookback=30, lead=7, visible=lambda r: True):
    """Weighted moving average forecast by definition (rows: dicts of the ledger)."""
    start = as_of - dt.timedelta(days=lookback)
    days = {}
    for r in log:
        if (r["product_id"], r["warehouse_id"]) != key or r["txn_type"] != "ISSUE":
            continue
        if r["txn_time"] < start or not visible(r):
            continue
        d = r["txn_time"].date()
        days[d] = days.get(d, 0) + abs(r["qty_change"])
    wsum = sum(q * (lookback - (as_of.date() - d).days) for d, q in days.items())
    wden = sum(lookback - (as_of.date() - d).days for d in days)
    if wden == 0:
        return 0
    return math.ceil(Fraction(wsum, wden) * lead * Fraction(6, 5))


def simulate(movements, opening, reorder_min, open_alerts=(), active=()):
    """Apply movements (dicts: request_id, request_time, product_id, warehouse_id, kind, qty) in
    (request_time, request_id) order; a SCAN looks at its pair if the product is ``active``.
    Returns (results per request, ledger, alerts)."""
    stock = dict(opening)
    is_open = {k: True for k in open_alerts}
    results, ledger, alerts = {}, [], []
    for m in sorted(movements, key=lambda m: (m["request_time"], m["request_id"])):
        key = (m["product_id"], m["warehouse_id"])
        q, kind = m["qty"], m["kind"]
        before = stock.get(key)
        res = {"accepted": True, "reject_reason": None, "available": before, "qty_after": before,
               "stock_updated": False}
        updated = False
        if kind == "SCAN":
            mn = reorder_min.get(m["product_id"])
            if before is not None and m["product_id"] in active and before <= mn:
                alerts.append({"alert_id": m["request_id"], "product_id": key[0], "warehouse_id": key[1],
                               "qty_on_hand": before, "raised_on": m["request_time"], "resolved_flag": "N",
                               "_ledger_len": len(ledger), "_scan": True})
                is_open[key] = True
            continue
        if kind == "ORDER":
            if before is None:
                res.update(accepted=False, reject_reason="NO_STOCK_ROW")
            elif q is None or q <= 0:
                res.update(accepted=False, reject_reason="INVALID_QTY")
            elif before < q:
                res.update(accepted=False, reject_reason="INSUFFICIENT_STOCK")
            else:
                stock[key] = before - q
                updated = True
        elif kind == "RECEIPT":
            if q is None:
                res.update(accepted=False, reject_reason="INVALID_QTY")
            elif before is None:
                if q >= 0:
                    stock[key] = q
                else:
                    res.update(accepted=False, reject_reason="NEGATIVE_STOCK")
            elif before + q < 0:
                res.update(accepted=False, reject_reason="NEGATIVE_STOCK")
            else:
                stock[key] = before + q
                updated = True
        else:
            if q is None or q <= 0:
                res.update(accepted=False, reject_reason="INVALID_QTY")
            elif before is not None:
                stock[key] = before + q
                updated = True
        res["qty_after"] = stock.get(key)
        res["stock_updated"] = updated
        results[m["request_id"]] = res
        if updated:   # row triggers, before the movement's own ledger row is written
            new, mn = stock[key], reorder_min.get(m["product_id"])
            if mn is not None:
                if new > before and new > mn:
                    for a in alerts:
                        if (a["product_id"], a["warehouse_id"]) == key:
                            a["resolved_flag"] = "Y"
                    is_open[key] = False
                elif new <= mn and not is_open.get(key, False):
                    alerts.append({"alert_id": m["request_id"], "product_id": key[0], "warehouse_id": key[1],
                                   "qty_on_hand": new, "raised_on": m["request_time"], "resolved_flag": "N",
                                   "_ledger_len": len(ledger), "_scan": False})
                    is_open[key] = True
        if res["accepted"]:
            ttype = {"ORDER": "ISSUE", "RECEIPT": "RECEIPT", "RESTOCK": "ADJUSTMENT"}[kind]
            ledger.append({"log_id": m["request_id"], "product_id": key[0], "warehouse_id": key[1],
                           "txn_type": ttype, "qty_change": -q if kind == "ORDER" else q,
                           "txn_time": m["request_time"]})
    return results, ledger, alerts
