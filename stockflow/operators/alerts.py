"""Low-stock alert life cycle (D1-D4) as relational rules over one sequence of stock events.

The source keeps alerts on two paths. Row triggers: an UPDATE leaving qty <= reorder_min raises an
alert unless one is open for the pair (D1), and an increase ending above reorder_min closes all
open alerts of the pair (D2). The reorder scan (B5): every active pair at or below its reorder point
gets an alert, open ones or not. Both write to ``low_stock_alerts`` and block or close each other, so
updates and scan rows form one sequence per pair, and the rules are a window formula over it:

* ``low`` = qty_after <= reorder_min, ``close`` = an increase with qty_after > reorder_min (mutually
  exclusive; a scan closes nothing);
* ``epoch`` = running count of closes per pair (chunked running sum, ``functions.running``);
* of an epoch's low rows the first one raises if it is an update; scan rows always raise and, when
  first, keep later updates of the epoch from raising;
* an alert is resolved iff its pair has a later close, i.e. its epoch is below the pair's close count.

D4 gives each alert the forecast as its writer saw it: the ledger up to, but excluding, the
movement that raised it, over the 30 days before the alert's own day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.functions.exprs import DEFAULT_LEAD_TIME_DAYS, DEFAULT_LOOKBACK_DAYS, suggested_qty
from stockflow.functions.running import CHUNK, chunked, dense_ids, running_sums
from stockflow.operators.admission import SCAN
from stockflow.operators.forecast import product_lead_time
from stockflow.session import cut_lineage

KEY = ["product_id", "warehouse_id"]
ORDER = ["txn_time", "seq"]
ISSUED = "issued_before"     # units issued by the pair earlier in the alert's own sequence


def updates_from_admission(admitted: DataFrame) -> DataFrame:
    """Stock UPDATE events of an admission run and its scans (rejections and row-creating receipts
    excluded). ``issued`` is what the event's own ISSUE row will log."""
    scan = F.col("kind") == SCAN
    rows = admitted.filter(F.col("stock_updated") | (scan & F.col("available").isNotNull()))
    chunk = [CHUNK] if CHUNK in admitted.columns else []
    return rows.select(
        F.col("request_id").alias("seq"), *KEY, F.col("request_time").alias("txn_time"),
        F.col("available").alias("qty_before"), "qty_after",
        F.when(F.col("kind") == "ORDER", F.col("qty")).otherwise(0).cast("long").alias("issued"), scan.alias("scan"), *chunk)


def updates_from_positions(positions: DataFrame) -> DataFrame:
    """Stock UPDATE events from running positions (C5): every ledger row changed an existing row."""
    issue = F.when(F.col("txn_type") == "ISSUE", F.abs("qty_change")).otherwise(0).cast("long")
    return positions.select(F.col("log_id").alias("seq"), *KEY, "txn_time",
                            (F.col("qty_on_hand") - F.col("qty_change")).alias("qty_before"),
                            F.col("qty_on_hand").alias("qty_after"), issue.alias("issued"), F.lit(False).alias("scan"))


def _events(updates: DataFrame) -> DataFrame:
    """Updates with the optional columns filled: no scan, nothing issued."""
    for name, value in (("scan", F.lit(False)), ("issued", F.lit(0).cast("long"))):
        if name not in updates.columns:
            updates = updates.withColumn(name, value)
    return updates


def _classified(updates: DataFrame, products: DataFrame) -> DataFrame:
    """Events with ``_low``, ``_close`` and ``_epoch``, and the units issued before each."""
    rows = _events(updates)
    rows = rows if CHUNK in rows.columns else chunked(rows, KEY, ORDER)
    u = rows.join(products.select("product_id", "reorder_min", "active_flag"), "product_id", "inner")
    qty, least = F.col("qty_after"), F.col("reorder_min")
    low = (qty <= least) & (~F.col("scan") | (F.col("active_flag") == "Y"))
    close = ~F.col("scan") & (qty > F.col("qty_before")) & (qty > least)
    u = u.select("seq", *KEY, "txn_time", "qty_after", "issued", "scan", "reorder_min", CHUNK,
                 F.coalesce(low, F.lit(False)).alias("_low"), close.alias("_close"))
    sums = running_sums(u, KEY, ORDER, {"_epoch": F.col("_close").cast("long"), ISSUED: F.col("issued")})
    return sums.withColumn(ISSUED, F.col(ISSUED) - F.col("issued"))


def _raised(updates: DataFrame, products: DataFrame, open_alerts: DataFrame | None) -> DataFrame:
    """Raised alerts of a sequence: seq, pair, qty, time, resolved_flag, scan, reorder_min and the
    units issued before."""
    c = _classified(updates, products)
    lows = c.filter("_low")
    alert = F.struct("txn_time", "seq", "scan", "qty_after", ISSUED, "reorder_min")
    firsts = lows.groupBy(*KEY, "_epoch").agg(F.min(alert).alias("_a"))
    firsts = firsts.filter(~F.col("_a.scan"))       # a first scan row is among the scan rows below
    if open_alerts is not None:
        blocked = (open_alerts.filter(F.col("resolved_flag") == "N").select(*KEY).distinct()
                   .withColumn("_epoch", F.lit(0).cast("long")))
        firsts = firsts.join(blocked, KEY + ["_epoch"], "left_anti")
    alerts = firsts.unionByName(lows.filter("scan").select(*KEY, "_epoch", alert.alias("_a")))
    closes = c.groupBy(*KEY).agg(F.sum(F.col("_close").cast("long")).alias("_n_close"))
    return alerts.join(closes, KEY).select(
        F.col("_a.seq").alias("seq"), *KEY, F.col("_a.qty_after").alias("qty_on_hand"), F.col("_a.txn_time").alias("raised_on"),
        F.when(F.col("_epoch") < F.col("_n_close"), "Y").otherwise("N").alias("resolved_flag"),
        F.col("_a.scan").alias("scan"), F.col("_a.reorder_min").alias("reorder_min"), F.col(f"_a.{ISSUED}").alias(ISSUED))


def raise_low_stock_alerts(updates: DataFrame, products: DataFrame, open_alerts: DataFrame | None = None) -> DataFrame:
    """D1 (+D2 inside the batch): alerts raised by a batch of stock updates.

    ``open_alerts`` are alerts already open before the batch (from either the trigger or the
    scan); they block raising for their pair until a close in the batch. Output: alert_id (the
    seq of the raising update), pair, qty_on_hand, raised_on, resolved_flag at batch end, and
    ``issued_before``, the units the batch had issued for the pair until then.
    """
    return _raised(_events(updates).filter(~F.col("scan")), products, open_alerts).select(
        F.col("seq").alias("alert_id"), *KEY, "qty_on_hand", "raised_on", "resolved_flag", ISSUED)


def alert_timeline(updates: DataFrame, products: DataFrame) -> DataFrame:
    """D3: full raise/resolve history of a movement sequence with no alert open at its start."""
    return raise_low_stock_alerts(updates, products, None)


def low_stock_alerts(updates: DataFrame, products: DataFrame, suppliers: DataFrame, log: DataFrame,
                     lookback: int = DEFAULT_LOOKBACK_DAYS, first_id: int = 1, whole_log: bool = False) -> DataFrame:
    """The table ``low_stock_alerts`` after a sequence of updates and scans: alerts of both paths.

    A trigger alert suggests the plain forecast, a scan alert at least the reorder point. Ids are
    dense, in the order of the raising events. ``whole_log`` says that ``log`` holds what this sequence
    logged and nothing else; the forecast then needs no second pass over it.
    """
    a = cut_lineage(_raised(updates, products, None))       # the range sort reads it twice
    a = dense_ids(a, ["raised_on", "seq", *KEY], "alert_id", first_id)
    f = alert_suggested_qty(a, log, products, suppliers, lookback, ISSUED if whole_log else None)
    q = F.when(F.col("scan"), F.greatest("suggested_qty", "reorder_min")).otherwise(F.col("suggested_qty"))
    return f.select("alert_id", *KEY, "qty_on_hand", q.cast("long").alias("suggested_qty"), "raised_on", "resolved_flag")


def resolve_alerts_on_receipt(alerts: DataFrame, updates: DataFrame, products: DataFrame) -> DataFrame:
    """Alerts open before the batch are resolved when the batch has any increase of their pair
    that ends strictly above the reorder point (equal does not resolve)."""
    p = products.select("product_id", "reorder_min")
    closing = (_events(updates).filter(~F.col("scan")).join(p, "product_id", "inner")
               .filter((F.col("qty_after") > F.col("qty_before")) & (F.col("qty_after") > F.col("reorder_min")))
               .select(*KEY).distinct().withColumn("_closed", F.lit(True)))
    j = alerts.join(closing, KEY, "left")
    return j.withColumn("resolved_flag", F.when((F.col("resolved_flag") == "N") & F.col("_closed"), F.lit("Y"))
                        .otherwise(F.col("resolved_flag"))).drop("_closed")


def alert_suggested_qty(alerts: DataFrame, log: DataFrame, products: DataFrame, suppliers: DataFrame,
                        lookback: int = DEFAULT_LOOKBACK_DAYS, issued: str | None = None) -> DataFrame:
    """Suggested quantity of each alert from the ledger visible when it was raised.

    Visible = ISSUE rows of the pair before the raising movement in (txn_time, log_id) order and
    not older than ``raised_on - lookback`` days; weights are relative to the alert's day.

    The oldest day of the window has weight 0, so earlier days enter as whole daily totals: sums of
    quantity, quantity x day, days and their number over a range of days, one window over a
    pair's daily totals and alert days (as many rows as days, however many movements). Units of the
    alert's own day are those issued before the alert less those of all earlier days.
    ``issued`` names the column of the alerts that holds what ``log`` had issued before (the alert rules
    leave it as ``issued_before``, right where the ledger is that of the same sequence); without it a
    chunked running sum over the ledger tells.

    ``log`` is read once or twice: pass a materialised input when it comes out of a long pipeline.
    """
    issues = log.filter(F.col("txn_type") == "ISSUE").select(
        "log_id", *KEY, "txn_time", F.abs("qty_change").cast("long").alias("_q"))
    out_cols = [c for c in alerts.columns if c != ISSUED]
    a = (alerts.select(*out_cols, F.col(issued).alias("_issued")) if issued
         else _issued_before(alerts.select(*out_cols), issues))
    a = a.withColumn("_day", F.datediff(F.to_date("raised_on"), F.lit("1970-01-01").cast("date")).cast("long"))
    day = F.datediff(F.to_date("txn_time"), F.lit("1970-01-01").cast("date")).cast("long")
    daily = issues.groupBy(*KEY, day.alias("_day")).agg(F.sum("_q").alias("_dq"), F.lit(1).cast("long").alias("_n"))
    asked = a.select(*KEY, "_day", F.lit(0).cast("long").alias("_dq"), F.lit(0).cast("long").alias("_n"))
    days = daily.unionByName(asked).groupBy(*KEY, "_day").agg(F.sum("_dq").alias("_dq"), F.max("_n").alias("_n"))
    by_day = Window.partitionBy(*KEY).orderBy("_day")
    span, ahead = by_day.rangeBetween(1 - lookback, -1), by_day.rangeBetween(Window.unboundedPreceding, -1)

    def total(c, w):
        return F.coalesce(F.sum(c).over(w), F.lit(0))
    d = F.col("_day")
    sums = days.select(*KEY, "_day", total(F.col("_dq"), span).alias("_s0"), total(F.col("_dq") * d, span).alias("_s1"),
                       total(F.col("_n"), span).alias("_n0"), total(F.col("_n") * d, span).alias("_n1"),
                       total(F.col("_dq"), ahead).alias("_past"))
    j = a.join(sums, [*KEY, "_day"]).join(product_lead_time(products, suppliers), "product_id", "left")
    back, same = F.lit(lookback) - d, F.col("_issued") - F.col("_past")
    wsum = back * F.col("_s0") + F.col("_s1") + F.lit(lookback) * same
    wden = back * F.col("_n0") + F.col("_n1") + F.when(same > 0, F.lit(lookback)).otherwise(0)
    lead_days = F.coalesce("lead_time_days", F.lit(DEFAULT_LEAD_TIME_DAYS))
    out = j.withColumn("suggested_qty", suggested_qty(wsum, wden, lead_days))
    return out.select(*out_cols, "suggested_qty")


def _issued_before(alerts: DataFrame, issues: DataFrame) -> DataFrame:
    """Alerts with the units of their pair issued before them: alerts join the pair's sequence of
    issues as rows that sort before the log row of the same time and id."""
    cells = F.struct(*alerts.columns)
    rows = issues.select(*KEY, "txn_time", F.col("log_id").alias("seq"), F.lit(1).alias("_o"), "_q", F.lit(None).cast(
        alerts.select(cells).schema[0].dataType).alias("_a"))
    asks = alerts.select(*KEY, F.col("raised_on").alias("txn_time"), F.col("alert_id").alias("seq"), F.lit(0).alias("_o"),
                         F.lit(0).cast("long").alias("_q"), cells.alias("_a"))
    order = ["txn_time", "seq", "_o"]
    walked = running_sums(chunked(rows.unionByName(asks), KEY, order), KEY, order, {"_issued": F.col("_q")})
    return walked.filter(F.col("_o") == 0).select("_a.*", "_issued")
