"""DuckDB text of every registered query, over the driver's raw tables.

Written independently of the Spark plans where the Spark side is clever: the admission and the
alert life cycle are a step-by-step recursive simulation (one step per movement of a key), and
the alert forecast is the plain range join of its definition. Inventory views are CTEs with the
same mapping as ``stockflow.sources.driver_tables`` (``inv_orders`` avoids the driver's table name).
"""

from __future__ import annotations

V = {
    "suppliers": """suppliers AS (
  SELECT CAST(s_suppkey AS BIGINT) AS supplier_id, s_name AS supplier_name,
         CAST(1 + s_suppkey % 14 AS INTEGER) AS lead_time_days, CAST(NULL AS VARCHAR) AS contact_email
  FROM supplier)""",
    "warehouses": """warehouses AS (
  SELECT CAST(r_regionkey AS BIGINT) AS warehouse_id, r_name AS warehouse_name,
         CAST(NULL AS VARCHAR) AS location FROM region)""",
    "products": """products AS (
  SELECT CAST(p_partkey AS BIGINT) AS product_id, 'SKU-' || CAST(p_partkey AS VARCHAR) AS sku,
         p_name AS product_name, CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
         CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE CAST(p_partkey % (SELECT max(s_suppkey) + 1 FROM supplier) AS BIGINT) END AS supplier_id,
         CAST(p_size AS BIGINT) AS reorder_min,
         CASE WHEN p_partkey % 10 = 3 THEN 'N' ELSE 'Y' END AS active_flag
  FROM part)""",
    "product_stock": """product_stock AS (
  SELECT CAST(p_partkey AS BIGINT) AS product_id, CAST(r_regionkey AS BIGINT) AS warehouse_id,
         CAST((p_partkey * 7 + r_regionkey * 13) % 60 AS BIGINT) AS qty_on_hand,
         TIMESTAMP '2024-01-01 00:00:00' AS last_updated
  FROM part, region)""",
    "ledger_e": """ledger_e AS (
  SELECT CAST(event_id AS BIGINT) AS log_id, CAST(user_id AS BIGINT) AS product_id,
         CAST(event_id % 5 AS BIGINT) AS warehouse_id,
         CASE WHEN event_type IN ('purchase', 'view', 'click') THEN 'ISSUE'
              WHEN event_type = 'signup' THEN 'RECEIPT' WHEN event_type = 'error' THEN 'ADJUSTMENT' END AS txn_type,
         CAST(CASE WHEN event_type IN ('purchase', 'view', 'click') THEN -u
                   WHEN event_type = 'signup' THEN 2 * u ELSE u END AS BIGINT) AS qty_change,
         ts AS txn_time, 'INVENTORY_APP' AS performed_by
  FROM (SELECT *, GREATEST(1, CAST(CEIL(value / 10) AS BIGINT)) AS u FROM events))""",
    "ledger_l": """ledger_l AS (
  SELECT CAST(l_orderkey * 16 + l_linenumber AS BIGINT) AS log_id, CAST(l_partkey AS BIGINT) AS product_id,
         CAST(l_suppkey % 5 AS BIGINT) AS warehouse_id,
         CASE WHEN l_returnflag = 'R' THEN 'ADJUSTMENT' ELSE 'ISSUE' END AS txn_type,
         CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE -CAST(l_quantity AS BIGINT) END AS qty_change,
         l_shipdate AS txn_time, 'INVENTORY_APP' AS performed_by
  FROM lineitem)""",
    "movements": """movements AS (
  SELECT request_id, request_time, product_id, warehouse_id, kind,
         CAST(CASE WHEN request_id % 97 = 0 THEN NULL WHEN request_id % 89 = 0 AND kind <> 'RECEIPT' THEN 0
                   WHEN kind <> 'RECEIPT' THEN u WHEN request_id % 7 = 0 THEN -2 * u ELSE 2 * u END AS BIGINT) AS qty
  FROM (SELECT CAST(event_id AS BIGINT) AS request_id, ts AS request_time, CAST(user_id AS BIGINT) AS product_id,
               CAST(event_id % 5 AS BIGINT) AS warehouse_id,
               CASE event_type WHEN 'signup' THEN 'RECEIPT' WHEN 'error' THEN 'RESTOCK' ELSE 'ORDER' END AS kind,
               GREATEST(1, CAST(CEIL(value / 10) AS BIGINT)) AS u FROM events))""",
    "opening": """opening AS (
  SELECT DISTINCT product_id, warehouse_id, CAST((product_id * 37 + warehouse_id * 13) % 80 AS BIGINT) AS qty_on_hand,
         TIMESTAMP '2024-01-01 00:00:00' AS last_updated
  FROM movements WHERE (product_id + 2 * warehouse_id) % 11 <> 0)""",
    "scans": """scans AS (
  SELECT CAST(-1 AS BIGINT) AS request_id, t AS request_time, product_id, warehouse_id, 'SCAN' AS kind, CAST(NULL AS BIGINT) AS qty
  FROM (SELECT DISTINCT product_id, warehouse_id FROM movements),
       (SELECT unnest([TIMESTAMP '2024-01-12 00:00:00', TIMESTAMP '2024-01-22 00:00:00']) AS t))""",
    "receipts": """receipts AS (
  SELECT log_id AS receipt_id, product_id + CASE WHEN log_id % 13 = 0 THEN 1000000000 ELSE 0 END AS product_id,
         CASE WHEN log_id % 17 = 0 THEN 99 ELSE warehouse_id END AS warehouse_id,
         CASE WHEN log_id % 11 = 0 THEN NULL WHEN log_id % 7 = 0 THEN -3 * qty_change ELSE qty_change END AS qty,
         txn_time AS received_at
  FROM ledger_e WHERE txn_type = 'RECEIPT')""",
    "inv_orders": """inv_orders AS (
  SELECT CAST(o_orderkey AS BIGINT) AS order_id, CAST(o_custkey % 5 AS BIGINT) AS warehouse_id,
         o_orderdate AS order_date,
         CASE o_orderstatus WHEN 'F' THEN 'FULFILLED' WHEN 'O' THEN 'PLACED' WHEN 'P' THEN 'CANCELLED' END AS status
  FROM orders)""",
    "orders_before": """orders_before AS (
  SELECT order_id, warehouse_id, order_date,
         CASE WHEN status = 'CANCELLED' THEN CASE WHEN order_id % 2 = 0 THEN 'FULFILLED' ELSE 'PLACED' END
              ELSE status END AS status FROM inv_orders)""",
    "order_items": """order_items AS (
  SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, l_suppkey, l_shipdate) AS order_item_id,
         CAST(l_orderkey AS BIGINT) AS order_id,
         CAST(l_partkey AS BIGINT) AS product_id, CAST(l_quantity AS BIGINT) AS qty_ordered FROM lineitem)""",
}
DEPS = {"opening": ["movements"], "orders_before": ["inv_orders"], "scans": ["movements"], "receipts": ["ledger_e"]}

EVENTS_AS_OF = "TIMESTAMP '2024-01-31 12:00:00'"
LINEITEM_AS_OF = "TIMESTAMP '2001-08-01 00:00:00'"


def with_views(names, *extra: str) -> str:
    """``WITH`` clause holding the named views (plus dependencies) and extra CTEs, in order."""
    order: list[str] = []

    def add(n):
        for d in DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)
    for n in names:
        add(n)
    parts = [V[n] for n in order] + list(extra)
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"


def _sim(initial_open: str = "FALSE", moves: str = "movements") -> list[str]:
    """Step-by-step simulation of admission plus the alert rules, per pair.

    State per pair after step rn: bal (stock; NULL while there is no stock row), open (an alert is
    open). A step applies movement rn. An applied movement of an existing row is an UPDATE: it raises
    an alert when the new stock is <= reorder_min and none is open, and closes all alerts on an
    increase ending above it. A scan raises for an active pair at or below reorder_min, open or not.
    ``initial_open`` = SQL boolean per pair (alias k) telling if an alert is already open.
    """
    return [
        f"""mseq AS (
  SELECT m.*, p.reorder_min, p.active_flag,
         row_number() OVER (PARTITION BY m.product_id, m.warehouse_id ORDER BY m.request_time, m.request_id) AS rn
  FROM (SELECT * FROM {moves}) m LEFT JOIN products p ON p.product_id = m.product_id)""",
        f"""sim(product_id, warehouse_id, rn, bal, is_open, why, raised, closed, prev_bal, touched) AS (
  SELECT k.product_id, k.warehouse_id, CAST(0 AS BIGINT), o.qty_on_hand, {initial_open}, CAST(NULL AS VARCHAR), FALSE, FALSE,
         CAST(NULL AS BIGINT), FALSE
  FROM (SELECT DISTINCT product_id, warehouse_id FROM mseq) k
  LEFT JOIN opening o ON o.product_id = k.product_id AND o.warehouse_id = k.warehouse_id
  UNION ALL
  SELECT y.product_id, y.warehouse_id, y.rn, y.nb,
         CASE WHEN y.hit AND y.nb > y.ob AND y.nb > y.reorder_min THEN FALSE
              WHEN (y.hit OR y.looks) AND y.nb <= y.reorder_min THEN TRUE ELSE y.was_open END,
         y.why,
         COALESCE(y.nb <= y.reorder_min AND (y.looks OR (y.hit AND NOT y.was_open)), FALSE),
         COALESCE(y.hit AND y.nb > y.ob AND y.nb > y.reorder_min, FALSE),
         y.ob, y.hit
  FROM (
    SELECT x.*, x.why IS NULL AND x.ob IS NOT NULL AND x.kind <> 'SCAN' AS hit,
           x.kind = 'SCAN' AND x.ob IS NOT NULL AND x.active_flag = 'Y' AS looks,
           CASE WHEN x.why IS NOT NULL OR x.kind = 'SCAN' THEN x.ob WHEN x.kind = 'ORDER' THEN x.ob - x.qty
                WHEN x.kind = 'RECEIPT' THEN COALESCE(x.ob, 0) + x.qty ELSE x.ob + x.qty END AS nb
    FROM (
      SELECT m.product_id, m.warehouse_id, m.rn, m.reorder_min, m.active_flag, m.kind, m.qty, f.bal AS ob, f.is_open AS was_open,
             CASE WHEN m.kind = 'ORDER' AND f.bal IS NULL THEN 'NO_STOCK_ROW'
                  WHEN m.kind <> 'SCAN' AND (m.qty IS NULL OR (m.kind <> 'RECEIPT' AND m.qty <= 0)) THEN 'INVALID_QTY'
                  WHEN m.kind = 'ORDER' AND f.bal < m.qty THEN 'INSUFFICIENT_STOCK'
                  WHEN m.kind = 'RECEIPT' AND COALESCE(f.bal, 0) + m.qty < 0 THEN 'NEGATIVE_STOCK' END AS why
      FROM sim f JOIN mseq m
        ON m.product_id = f.product_id AND m.warehouse_id = f.warehouse_id AND m.rn = f.rn + 1) x) y)""",
        """admitted AS (
  SELECT s.request_id, s.request_time, s.product_id, s.warehouse_id, s.kind, s.qty, f.why IS NULL AS accepted,
         f.why AS reject_reason, f.prev_bal AS available, f.bal AS qty_after, f.touched AS stock_updated,
         CASE WHEN f.why = 'INSUFFICIENT_STOCK'
              THEN 'Insufficient stock: available ' || CAST(f.prev_bal AS VARCHAR) || ', requested ' || CAST(s.qty AS VARCHAR)
         END AS message,
         f.raised, f.closed, s.rn, s.reorder_min
  FROM mseq s JOIN sim f ON f.product_id = s.product_id AND f.warehouse_id = s.warehouse_id AND f.rn = s.rn)""",
        """mledger AS (
  SELECT request_id AS log_id, product_id, warehouse_id,
         CASE kind WHEN 'ORDER' THEN 'ISSUE' WHEN 'RECEIPT' THEN 'RECEIPT' ELSE 'ADJUSTMENT' END AS txn_type,
         CASE WHEN kind = 'ORDER' THEN -qty ELSE qty END AS qty_change, request_time AS txn_time,
         'INVENTORY_APP' AS performed_by
  FROM admitted WHERE accepted AND kind <> 'SCAN')""",
        """sim_alerts AS (
  SELECT request_id AS alert_id, product_id, warehouse_id, qty_after AS qty_on_hand, request_time AS raised_on,
         CASE WHEN closes_left > 0 THEN 'Y' ELSE 'N' END AS resolved_flag, kind, reorder_min
  FROM (SELECT *, count(*) FILTER (closed) OVER (PARTITION BY product_id, warehouse_id ORDER BY rn
                                                ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS closes_left FROM admitted)
  WHERE raised)""",
        """closing AS (
  SELECT k.product_id, k.warehouse_id, COALESCE(l.qty_after, o.qty_on_hand) AS qty_on_hand, COALESCE(l.at_, o.last_updated) AS last_updated
  FROM (SELECT product_id, warehouse_id FROM opening UNION SELECT product_id, warehouse_id FROM admitted) k
  LEFT JOIN opening o ON o.product_id = k.product_id AND o.warehouse_id = k.warehouse_id
  LEFT JOIN (SELECT product_id, warehouse_id, arg_max(qty_after, rn) AS qty_after, arg_max(request_time, rn) AS at_
             FROM admitted WHERE accepted AND kind <> 'SCAN' AND qty_after IS NOT NULL GROUP BY product_id, warehouse_id) l
    ON l.product_id = k.product_id AND l.warehouse_id = k.warehouse_id
  WHERE COALESCE(l.qty_after, o.qty_on_hand) IS NOT NULL)""",
    ]


SCANNED = "(SELECT * FROM movements UNION ALL SELECT * FROM scans)"

#: The table low_stock_alerts after the run with its scans, from the simulation's raised rows.
ALERTS = """low_stock_alerts AS (
  SELECT row_number() OVER (ORDER BY raised_on, alert_id, product_id, warehouse_id) AS alert_id, product_id, warehouse_id,
         qty_on_hand, CASE WHEN kind = 'SCAN' THEN GREATEST(suggested_qty, reorder_min) ELSE suggested_qty END AS suggested_qty,
         raised_on, resolved_flag
  FROM alert_fc)"""


def _alert_forecast(alerts: str) -> str:
    """Forecast of each alert by definition: a range join of the alert with the visible ledger."""
    return f"""alert_days AS (
  SELECT a.product_id, a.warehouse_id, a.raised_on, a.alert_id, SUM(ABS(l.qty_change)) AS dq,
         30 - datediff('day', CAST(l.txn_time AS DATE), CAST(a.raised_on AS DATE)) AS w
  FROM {alerts} a JOIN mledger l
    ON l.product_id = a.product_id AND l.warehouse_id = a.warehouse_id AND l.txn_type = 'ISSUE'
   AND (l.txn_time, l.log_id) < (a.raised_on, a.alert_id) AND l.txn_time >= a.raised_on - INTERVAL 30 DAY
  GROUP BY ALL),
alert_sums AS (
  SELECT product_id, warehouse_id, raised_on, alert_id, CAST(SUM(dq * w) AS BIGINT) AS wsum, CAST(SUM(w) AS BIGINT) AS wden
  FROM alert_days GROUP BY ALL),
alert_fc AS (
  SELECT a.*, CAST(CASE WHEN COALESCE(f.wden, 0) = 0 THEN 0
                   ELSE (f.wsum * lt.lead_time_days * 6 + f.wden * 5 - 1) // (f.wden * 5) END AS BIGINT) AS suggested_qty
  FROM {alerts} a LEFT JOIN alert_sums f USING (product_id, warehouse_id, raised_on, alert_id)
  LEFT JOIN lead_times lt ON lt.product_id = a.product_id)"""


LEAD = """lead_times AS (
  SELECT p.product_id, CAST(COALESCE(s.lead_time_days, 7) AS INTEGER) AS lead_time_days
  FROM products p LEFT JOIN suppliers s ON s.supplier_id = p.supplier_id)"""

SUGGEST = "CAST(CASE WHEN wden IS NULL OR wden = 0 THEN 0 ELSE (wsum * lt.lead_time_days * 6 + wden * 5 - 1) // (wden * 5) END AS BIGINT)"


def _daily(as_of: str) -> str:
    return f"""daily AS (
  SELECT product_id, warehouse_id, CAST(txn_time AS DATE) AS txn_day,
         CAST(SUM(ABS(qty_change)) AS BIGINT) AS daily_qty,
         CAST(30 - datediff('day', CAST(txn_time AS DATE), CAST({as_of} AS DATE)) AS BIGINT) AS weight
  FROM ledger_e WHERE txn_type = 'ISSUE' AND txn_time >= {as_of} - INTERVAL 30 DAY
  GROUP BY product_id, warehouse_id, CAST(txn_time AS DATE))"""


WAVG = """wavg AS (
  SELECT product_id, warehouse_id, CAST(SUM(daily_qty * weight) AS BIGINT) AS wsum, CAST(SUM(weight) AS BIGINT) AS wden
  FROM daily GROUP BY product_id, warehouse_id)"""

SCAN = f"""scan AS (
  SELECT ps.product_id, ps.warehouse_id, ps.qty_on_hand,
         GREATEST({SUGGEST}, p.reorder_min) AS suggested_qty, 'N' AS resolved_flag
  FROM product_stock ps JOIN products p ON p.product_id = ps.product_id
  LEFT JOIN wavg w ON w.product_id = ps.product_id AND w.warehouse_id = ps.warehouse_id
  LEFT JOIN lead_times lt ON lt.product_id = ps.product_id
  WHERE p.active_flag = 'Y' AND ps.qty_on_hand <= p.reorder_min)"""

SIM_VIEWS = ["products", "suppliers", "movements", "opening"]


def _q() -> dict[str, str]:
    q: dict[str, str] = {}
    ev = EVENTS_AS_OF
    # status = place in a list: one step for any stock, a second for stock above the reorder point
    q["stock_health"] = with_views(["products", "warehouses", "product_stock"], """names AS (
  SELECT ['OUT OF STOCK', 'LOW STOCK', 'HEALTHY'] AS status, map(list(warehouse_id), list(warehouse_name)) AS wname FROM warehouses)""") + """
SELECT sku, product_name, wname[warehouse_id] AS warehouse_name, qty_on_hand, reorder_min,
       status[1 + CAST(qty_on_hand <> 0 AS INT) * (1 + CAST(qty_on_hand > reorder_min AS INT))] AS stock_status, last_updated
FROM names, product_stock JOIN products USING (product_id)
WHERE map_contains(wname, warehouse_id)"""
    # sums per product id first (month as a date), names afterwards
    def months(ledger: str) -> str:
        return with_views(["products", ledger], f"""months AS (
  SELECT product_id, date_trunc('month', txn_time) AS m, CAST(-SUM(qty_change) AS BIGINT) AS units
  FROM {ledger} WHERE txn_type = 'ISSUE' GROUP BY ALL)""") + """
SELECT (SELECT sku FROM products p WHERE p.product_id = m.product_id) AS sku,
       (SELECT product_name FROM products p WHERE p.product_id = m.product_id) AS product_name,
       year(m) || '-' || lpad(CAST(month(m) AS VARCHAR), 2, '0') AS txn_month, units AS units_issued
FROM months m WHERE product_id IN (SELECT product_id FROM products)"""
    q["monthly_consumption"] = months("ledger_l")

    def top(ledger: str, as_of: str) -> str:
        return with_views(["products", ledger], f"""moved AS (
  SELECT product_id, CAST(SUM(greatest(qty_change, -qty_change)) AS BIGINT) AS units FROM {ledger}
  WHERE txn_type = 'ISSUE' AND epoch({as_of}) - epoch(txn_time) <= 30 * 86400 GROUP BY product_id)""") + """
SELECT sku, product_name, units AS units_issued_30d FROM moved JOIN products USING (product_id)
QUALIFY row_number() OVER (ORDER BY units DESC, sku) <= 10"""
    q["top_moving_products"] = top("ledger_l", LINEITEM_AS_OF)
    q["top_moving_products_events"] = top("ledger_e", ev)
    q["daily_issue_qty"] = with_views(["ledger_e"], _daily(ev)) + "SELECT * FROM daily"
    q["weighted_daily_avg"] = with_views(["ledger_e"], _daily(ev), WAVG) + """
SELECT product_id, warehouse_id, wsum, wden, COALESCE(CAST(wsum AS DOUBLE) / NULLIF(wden, 0), 0.0) AS weighted_avg FROM wavg"""
    q["product_lead_time"] = with_views(["products", "suppliers"], LEAD) + "SELECT * FROM lead_times"
    q["forecast_reorder_qty"] = with_views(["products", "suppliers", "product_stock", "ledger_e"], _daily(ev), WAVG, LEAD) + f"""
SELECT k.product_id, k.warehouse_id, {SUGGEST} AS suggested_qty
FROM (SELECT DISTINCT product_id, warehouse_id FROM product_stock) k
LEFT JOIN wavg w ON w.product_id = k.product_id AND w.warehouse_id = k.warehouse_id
LEFT JOIN lead_times lt ON lt.product_id = k.product_id"""
    q["reorder_scan"] = with_views(["products", "suppliers", "product_stock", "ledger_e"], _daily(ev), WAVG, LEAD, SCAN) + \
        "SELECT product_id, warehouse_id, qty_on_hand, suggested_qty FROM scan"

    sim = _sim()
    q["order_admission"] = with_views(SIM_VIEWS, *sim) + """
SELECT request_id, request_time, product_id, warehouse_id, kind, qty, accepted, reject_reason, available,
       qty_after, stock_updated, message FROM admitted"""
    q["order_outputs"] = with_views(SIM_VIEWS, *sim) + "SELECT * FROM mledger WHERE txn_type = 'ISSUE'"
    q["order_outputs_orders"] = with_views(SIM_VIEWS, *sim) + """
SELECT request_id AS order_id, warehouse_id, request_time AS order_date, 'FULFILLED' AS status
FROM admitted WHERE kind = 'ORDER' AND accepted"""
    q["order_outputs_items"] = with_views(SIM_VIEWS, *sim) + """
SELECT request_id AS order_item_id, request_id AS order_id, product_id, qty AS qty_ordered
FROM admitted WHERE kind = 'ORDER' AND accepted"""
    q["closing_stock"] = with_views(SIM_VIEWS, *sim) + "SELECT * FROM closing"
    q["ledger_append"] = with_views(SIM_VIEWS, *sim) + "SELECT *, CAST(txn_time AS DATE) AS txn_date FROM mledger"
    q["stock_position"] = with_views(SIM_VIEWS, *sim) + """
SELECT l.log_id, l.product_id, l.warehouse_id, l.txn_type, l.qty_change, l.txn_time,
       CAST(COALESCE(o.qty_on_hand, 0) + SUM(l.qty_change) OVER (PARTITION BY l.product_id, l.warehouse_id
            ORDER BY l.txn_time, l.log_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS qty_on_hand
FROM mledger l LEFT JOIN opening o ON o.product_id = l.product_id AND o.warehouse_id = l.warehouse_id"""
    plain = "alert_id, product_id, warehouse_id, qty_on_hand, raised_on, resolved_flag"
    q["alert_timeline"] = with_views(SIM_VIEWS, *sim) + f"SELECT {plain} FROM sim_alerts"
    q["alert_suggested_qty"] = with_views(SIM_VIEWS, *sim, LEAD, _alert_forecast("sim_alerts")) + f"""
SELECT {plain}, suggested_qty FROM alert_fc"""
    scan_sim = [SIM_VIEWS + ["scans", "warehouses", "inv_orders", "orders_before", "order_items"],
                *_sim(moves=SCANNED), LEAD, _alert_forecast("sim_alerts"), ALERTS]
    q["low_stock_alerts"] = with_views(*scan_sim) + "SELECT * FROM low_stock_alerts"
    # open alerts by set difference: all of the final table less the resolved ones
    q["open_reorder_alerts"] = with_views(*scan_sim) + """
SELECT x.alert_id, sku, product_name, warehouse_name, x.qty_on_hand, x.suggested_qty,
       sup.supplier_name, sup.lead_time_days, x.raised_on
FROM (FROM low_stock_alerts EXCEPT FROM low_stock_alerts WHERE resolved_flag <> 'N') x
JOIN (FROM products, warehouses) d USING (product_id, warehouse_id)
LEFT JOIN suppliers sup USING (supplier_id)"""
    scan_views = SIM_VIEWS + ["product_stock", "ledger_e"]
    blocked = """EXISTS (SELECT 1 FROM scan sc WHERE sc.product_id = k.product_id AND sc.warehouse_id = k.warehouse_id)"""
    q["raise_low_stock_alerts"] = with_views(scan_views, _daily(ev), WAVG, LEAD, SCAN, *_sim(blocked),
                                             _alert_forecast("sim_alerts")) + f"SELECT {plain}, suggested_qty FROM alert_fc"
    moved = """moved AS (
  SELECT i.order_item_id, i.product_id, a.warehouse_id, i.qty_ordered
  FROM inv_orders a JOIN orders_before b ON b.order_id = a.order_id
  JOIN order_items i ON i.order_id = a.order_id
  WHERE a.status = 'CANCELLED' AND b.status = 'FULFILLED')"""
    # restocks only add: a pair's last restock leaves the most, so it tells whether any closed
    q["resolve_alerts_on_receipt"] = with_views(*scan_sim, moved) + """
SELECT l.* REPLACE (CASE WHEN l.resolved_flag = 'N' AND c.qty_on_hand + b.back > p.reorder_min THEN 'Y' ELSE l.resolved_flag END AS resolved_flag)
FROM low_stock_alerts l JOIN products p ON p.product_id = l.product_id
LEFT JOIN closing c ON c.product_id = l.product_id AND c.warehouse_id = l.warehouse_id
LEFT JOIN (SELECT product_id, warehouse_id, SUM(qty_ordered) AS back FROM moved GROUP BY ALL) b
  ON b.product_id = l.product_id AND b.warehouse_id = l.warehouse_id"""
    q["cancel_restock_alerts"] = with_views(["products", "suppliers", "product_stock", "ledger_e", "inv_orders", "orders_before",
                                             "order_items"], _daily(ev), WAVG, LEAD, SCAN, moved, """back AS (
  SELECT m.*, s.qty_on_hand + SUM(m.qty_ordered) OVER (PARTITION BY m.product_id, m.warehouse_id ORDER BY m.order_item_id) AS after_,
         s.qty_on_hand + SUM(m.qty_ordered) OVER (PARTITION BY m.product_id, m.warehouse_id) AS last_,
         row_number() OVER (PARTITION BY m.product_id, m.warehouse_id ORDER BY m.order_item_id) AS nth
  FROM moved m JOIN product_stock s ON s.product_id = m.product_id AND s.warehouse_id = m.warehouse_id)""") + """
SELECT 'SCAN' AS raised_by, CAST(NULL AS BIGINT) AS order_item_id, sc.product_id, sc.warehouse_id, sc.qty_on_hand,
       CASE WHEN b.last_ > p.reorder_min THEN 'Y' ELSE 'N' END AS resolved_flag
FROM scan sc JOIN products p ON p.product_id = sc.product_id
LEFT JOIN back b ON b.product_id = sc.product_id AND b.warehouse_id = sc.warehouse_id AND b.nth = 1
UNION ALL
SELECT 'RESTOCK', b.order_item_id, b.product_id, b.warehouse_id, CAST(b.after_ AS BIGINT),
       CASE WHEN b.last_ > p.reorder_min THEN 'Y' ELSE 'N' END
FROM back b JOIN products p ON p.product_id = b.product_id
WHERE b.nth = 1 AND b.after_ <= p.reorder_min
  AND NOT EXISTS (SELECT 1 FROM scan sc WHERE sc.product_id = b.product_id AND sc.warehouse_id = b.warehouse_id)"""
    judged = ["""rseq AS (
  SELECT *, row_number() OVER (PARTITION BY product_id, warehouse_id ORDER BY received_at, receipt_id) AS rn
  FROM receipts SEMI JOIN products USING (product_id) SEMI JOIN warehouses USING (warehouse_id))""",
              """rsim(product_id, warehouse_id, rn, bal, ok) AS (
  SELECT k.product_id, k.warehouse_id, CAST(0 AS BIGINT), s.qty_on_hand, FALSE
  FROM (SELECT DISTINCT product_id, warehouse_id FROM rseq) k LEFT JOIN product_stock s USING (product_id, warehouse_id)
  UNION ALL
  SELECT product_id, warehouse_id, rn, CASE WHEN ok THEN COALESCE(bal, 0) + qty ELSE bal END, ok
  FROM (SELECT r.*, f.bal, COALESCE(COALESCE(f.bal, 0) + r.qty >= 0, FALSE) AS ok
        FROM rsim f JOIN rseq r ON r.product_id = f.product_id AND r.warehouse_id = f.warehouse_id AND r.rn = f.rn + 1))""",
              "good AS (SELECT r.* FROM rseq r JOIN rsim f USING (product_id, warehouse_id, rn) WHERE f.ok)"]
    receipt_views = ["product_stock", "receipts", "products", "warehouses"]
    q["receive_stock"] = with_views(receipt_views, *judged) + """
SELECT product_id, warehouse_id, CAST(SUM(q) AS BIGINT) AS qty_on_hand, COALESCE(MAX(at_), MAX(old)) AS last_updated
FROM (SELECT product_id, warehouse_id, qty_on_hand AS q, NULL AS at_, last_updated AS old FROM product_stock
      UNION ALL SELECT product_id, warehouse_id, qty, received_at, NULL FROM good)
GROUP BY ALL"""
    q["receive_stock_ledger"] = with_views(receipt_views, *judged) + """
SELECT receipt_id AS log_id, product_id, warehouse_id, 'RECEIPT' AS txn_type, qty AS qty_change, received_at AS txn_time,
       'INVENTORY_APP' AS performed_by FROM good"""
    cancel = with_views(["product_stock", "orders_before", "order_items"], moved)
    q["cancel_restock"] = cancel + f"""
SELECT s.product_id, s.warehouse_id, CAST(s.qty_on_hand + COALESCE(b.back, 0) AS BIGINT) AS qty_on_hand,
       CASE WHEN b.back IS NOT NULL THEN {LINEITEM_AS_OF} ELSE s.last_updated END AS last_updated
FROM product_stock s LEFT JOIN (SELECT product_id, warehouse_id, SUM(qty_ordered) AS back FROM moved
                                GROUP BY product_id, warehouse_id) b
  ON b.product_id = s.product_id AND b.warehouse_id = s.warehouse_id"""
    q["cancel_restock_ledger"] = cancel + f"""
SELECT order_item_id AS log_id, product_id, warehouse_id, 'ADJUSTMENT' AS txn_type, qty_ordered AS qty_change,
       {LINEITEM_AS_OF} AS txn_time, 'INVENTORY_APP' AS performed_by FROM moved"""

    q["dq_duplicate_keys"] = """
SELECT CAST(l_orderkey AS BIGINT) AS order_id, CAST(l_linenumber AS BIGINT) AS line_number, COUNT(*) AS n
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1"""
    all_tables = [["product_stock", "ledger_e", *scan_sim[0]], *scan_sim[1:]]
    tname = {"orders": "inv_orders", "stock_txn_log": "ledger_e"}
    keys = {"products": ["product_id"], "suppliers": ["supplier_id"], "warehouses": ["warehouse_id"],
            "product_stock": ["product_id", "warehouse_id"], "orders": ["order_id"],
            "order_items": ["order_item_id"], "stock_txn_log": ["log_id"], "low_stock_alerts": ["alert_id"]}

    def rk(t, alias="c"):
        return "concat_ws('|', " + ", ".join(f"CAST({alias}.{k} AS VARCHAR)" for k in keys[t]) + ")"
    fks = {
        "products.supplier_id": ("products", "supplier_id", "suppliers", "supplier_id"),
        "product_stock.product_id": ("product_stock", "product_id", "products", "product_id"),
        "product_stock.warehouse_id": ("product_stock", "warehouse_id", "warehouses", "warehouse_id"),
        "orders.warehouse_id": ("orders", "warehouse_id", "warehouses", "warehouse_id"),
        "order_items.order_id": ("order_items", "order_id", "orders", "order_id"),
        "order_items.product_id": ("order_items", "product_id", "products", "product_id"),
        "stock_txn_log.product_id": ("stock_txn_log", "product_id", "products", "product_id"),
        "stock_txn_log.warehouse_id": ("stock_txn_log", "warehouse_id", "warehouses", "warehouse_id"),
        "low_stock_alerts.product_id": ("low_stock_alerts", "product_id", "products", "product_id"),
        "low_stock_alerts.warehouse_id": ("low_stock_alerts", "warehouse_id", "warehouses", "warehouse_id"),
    }
    parts = []
    for name, (ch, fk, par, pk) in sorted(fks.items()):
        parts.append(f"SELECT '{name}' AS fk_name, {rk(ch)} AS row_key FROM {tname.get(ch, ch)} c "
                     f"WHERE c.{fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {tname.get(par, par)} p WHERE p.{pk} = c.{fk})")
    q["dq_orphans"] = with_views(*all_tables) + "\nUNION ALL\n".join(parts)
    checks = {
        "order_items.qty_ordered_positive": ("order_items", "qty_ordered > 0"),
        "orders.status_domain": ("orders", "status IN ('PLACED', 'FULFILLED', 'CANCELLED')"),
        "product_stock.qty_on_hand_nonneg": ("product_stock", "qty_on_hand >= 0"),
        "products.active_flag_in_YN": ("products", "active_flag IN ('Y', 'N')"),
        "low_stock_alerts.resolved_flag_in_YN": ("low_stock_alerts", "resolved_flag IN ('Y', 'N')"),
    }
    parts = [f"SELECT '{n}' AS rule_name, {rk(t)} AS row_key FROM {tname.get(t, t)} c WHERE NOT COALESCE({pred}, TRUE)"
             for n, v in sorted(checks.items()) for t, pred in [v]]
    q["dq_check_violations"] = with_views(*all_tables) + "\nUNION ALL\n".join(parts)
    required = {
        "order_items": ["order_item_id", "order_id", "product_id", "qty_ordered"],
        "orders": ["order_id", "warehouse_id", "order_date"],
        "product_stock": ["product_id", "warehouse_id", "qty_on_hand"],
        "products": ["product_id", "sku", "product_name", "unit_price", "reorder_min"],
        "stock_txn_log": ["log_id", "product_id", "warehouse_id", "txn_type", "qty_change"],
        "suppliers": ["supplier_id", "supplier_name", "lead_time_days"],
        "warehouses": ["warehouse_id", "warehouse_name"],
        "low_stock_alerts": ["alert_id", "product_id", "warehouse_id", "qty_on_hand", "suggested_qty"],
    }
    parts = []
    for t in sorted(required):
        key = "concat_ws('|', " + ", ".join(f"COALESCE(CAST(c.{k} AS VARCHAR), 'NULL')" for k in keys[t]) + ")"
        for c in required[t]:
            parts.append(f"SELECT '{t}' AS table_name, {key} AS row_key, '{c}' AS column_name "
                         f"FROM {tname.get(t, t)} c WHERE c.{c} IS NULL")
    q["dq_missing_required"] = with_views(*all_tables) + "\nUNION ALL\n".join(parts)
    q["dq_negative_positions"] = with_views(["movements", "opening", "ledger_e"]) + """
SELECT 'product_stock.qty_on_hand_nonneg' AS rule_name, CAST(log_id AS VARCHAR) AS row_key FROM (
  SELECT l.log_id, COALESCE(o.qty_on_hand, 0) + SUM(l.qty_change) OVER (PARTITION BY l.product_id, l.warehouse_id
         ORDER BY l.txn_time, l.log_id ROWS UNBOUNDED PRECEDING) AS q
  FROM ledger_e l LEFT JOIN opening o ON o.product_id = l.product_id AND o.warehouse_id = l.warehouse_id) x
WHERE NOT COALESCE(q >= 0, TRUE)"""
    q["apply_defaults"] = with_views(["products"]) + """
SELECT product_id, sku, product_name, unit_price, supplier_id, CAST(10 AS BIGINT) AS reorder_min, 'Y' AS active_flag
FROM products"""
    declared = {"suppliers.pk": ("suppliers", ["supplier_id"]), "warehouses.pk": ("warehouses", ["warehouse_id"]),
                "products.pk": ("products", ["product_id"]), "products.sku_unique": ("products", ["sku"]),
                "product_stock.pk": ("product_stock", ["product_id", "warehouse_id"]),
                "orders.pk": ("inv_orders", ["order_id"]), "order_items.pk": ("order_items", ["order_item_id"]),
                "stock_txn_log.pk": ("ledger_e", ["log_id"]), "low_stock_alerts.pk": ("low_stock_alerts", ["alert_id"]),
                "low_stock_alerts.open_pair": ("(FROM low_stock_alerts WHERE resolved_flag = 'N')", ["product_id", "warehouse_id"])}
    q["dq_declared_keys"] = with_views(*all_tables) + "\nUNION ALL\n".join(
        f"SELECT DISTINCT * FROM (SELECT '{name}' AS key_name, concat_ws('|', {', '.join(f'CAST({c} AS VARCHAR)' for c in cols)}) "
        f"AS row_key, COUNT(*) OVER (PARTITION BY {', '.join(cols)}) AS n FROM {t}) WHERE n > 1"
        for name, (t, cols) in declared.items())
    q["dq_inactive_references"] = with_views(["products", "order_items"]) + """
SELECT i.order_item_id, i.order_id, i.product_id, i.qty_ordered FROM order_items i
LEFT JOIN products p ON p.product_id = i.product_id WHERE p.active_flag IS DISTINCT FROM 'Y'"""
    q["dq_missing_supplier"] = """
SELECT 'products' AS table_name, CAST(p_partkey AS VARCHAR) AS row_key, 'supplier_id' AS column_name
FROM part WHERE p_partkey % 17 = 0"""
    q["ledger_append_restock"] = with_views(["ledger_e", "orders_before", "order_items"], moved) + f"""
SELECT *, CAST(txn_time AS DATE) AS txn_date FROM ledger_e
UNION ALL
SELECT (SELECT max(log_id) FROM ledger_e) + row_number() OVER (ORDER BY order_item_id), product_id, warehouse_id, 'ADJUSTMENT',
       qty_ordered, {EVENTS_AS_OF}, 'INVENTORY_APP', CAST({EVENTS_AS_OF} AS DATE) FROM moved"""
    q["apply_defaults_stock"] = with_views(["product_stock"]) + f"""
SELECT product_id, warehouse_id, CAST(0 AS BIGINT) AS qty_on_hand, {EVENTS_AS_OF} AS last_updated FROM product_stock"""
    q["apply_defaults_orders"] = with_views(["inv_orders"]) + """
SELECT order_id, warehouse_id, order_date, 'PLACED' AS status FROM inv_orders"""
    q["apply_defaults_ledger"] = with_views(["ledger_e"]) + f"""
SELECT log_id, product_id, warehouse_id, txn_type, qty_change, {EVENTS_AS_OF} AS txn_time,
       'INVENTORY_APP' AS performed_by FROM ledger_e"""
    q["stream_daily_issue"] = with_views(["ledger_e"]) + """
SELECT product_id, warehouse_id, date_trunc('day', txn_time) AS window_start, CAST(SUM(ABS(qty_change)) AS BIGINT) AS daily_qty
FROM ledger_e WHERE txn_type = 'ISSUE' GROUP BY product_id, warehouse_id, date_trunc('day', txn_time)"""
    lengths = {"suppliers": {"supplier_name": 120, "contact_email": 120}, "warehouses": {"warehouse_name": 120, "location": 200},
               "products": {"sku": 40, "product_name": 150, "active_flag": 1}, "orders": {"status": 20},
               "stock_txn_log": {"txn_type": 20, "performed_by": 60}, "low_stock_alerts": {"resolved_flag": 1}}
    rules = [(t, f"{c}_required", "NOT NULL", f"{c} IS NULL") for t, cols in required.items() for c in cols]
    rules += [(t, n.split(".")[1], "CHECK", f"NOT COALESCE({pred}, TRUE)") for n, (t, pred) in checks.items()]
    rules += [(t, f"{c}_length", "LENGTH", f"COALESCE(length({c}) > {n}, FALSE)") for t, cols in lengths.items() for c, n in cols.items()]
    rules += [("order_requests", r, k, c) for t, r, k, c in rules if t == "order_items"]
    keys["order_requests"], tname["order_requests"] = ["order_item_id"], "order_requests"
    q["dq_rule_violations"] = with_views(*all_tables, """order_requests AS (
  SELECT request_id AS order_item_id, request_id AS order_id, product_id, qty AS qty_ordered FROM movements WHERE kind = 'ORDER')""") + \
        "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, {rk(t)} AS row_key, '{r}' AS rule_name, '{k}' AS kind FROM {tname.get(t, t)} c WHERE {cond}"
                             for t, r, k, cond in rules)
    q["top_moving_products_stored"] = q["top_moving_products_events"].replace("30 * 86400", "7 * 86400")
    week = _daily(ev).replace("30 - datediff", "7 - datediff").replace("INTERVAL 30 DAY", "INTERVAL 7 DAY")
    q["sql_forecast"] = f"""SELECT 30 AS lookback, * FROM ({q["forecast_reorder_qty"]})
UNION ALL SELECT 7, * FROM ({q["forecast_reorder_qty"].replace(_daily(ev), week)})"""
    q["daily_issue_qty_stored"] = q["daily_issue_qty"].replace(_daily(ev), week)
    q["stream_monthly_consumption"] = months("ledger_e")
    q["stream_order_admission"] = q["order_admission"]
    q["stream_alerts"] = with_views(scan_views, _daily(ev), WAVG, LEAD, SCAN, *_sim(blocked), _alert_forecast("sim_alerts"), """known AS (
  SELECT alert_id, product_id, warehouse_id, rn FROM sim_alerts s JOIN admitted a USING (product_id, warehouse_id)
  WHERE a.request_id = s.alert_id
  UNION ALL
  SELECT -product_id * 5 - warehouse_id - 1, product_id, warehouse_id, 0
  FROM scan SEMI JOIN movements USING (product_id, warehouse_id))""") + """
SELECT 'RAISED' AS event, alert_id, product_id, warehouse_id, qty_on_hand, suggested_qty, raised_on AS event_time FROM alert_fc
UNION ALL
SELECT 'RESOLVED', k.alert_id, k.product_id, k.warehouse_id, arg_min(c.qty_after, c.rn), CAST(NULL AS BIGINT), arg_min(c.request_time, c.rn)
FROM known k JOIN admitted c ON c.product_id = k.product_id AND c.warehouse_id = k.warehouse_id AND c.closed AND c.rn > k.rn
GROUP BY k.alert_id, k.product_id, k.warehouse_id"""
    return q


ORACLE_SQL = _q()
