"""S1 + S4: order admission and the alert life cycle on an unbounded movement stream.

One stateful processor per product (``transformWithState`` on the RocksDB store) holds its (product,
warehouse) keys. State per key: one list entry with the balance (null while there is no stock row) and
the ids of the open alerts, and one list entry a day with the issued units, for the forecast at alert
time. A day goes once the watermark has left it ``lookback`` days behind, by an event-time timer for the
oldest day of the product, so a product without movements sheds its days too; a key holds at most
``lookback`` days, those of the watermark delay, and days dated in the future.

Inside a micro-batch the rows of a key are applied in (request_time, request_id) order; across
micro-batches in arrival order, as the source system does. Rows later than the watermark are dropped
(our rule: the source has no late data). Opening balances, open alerts and earlier issues come with a
key's rows, from a static table joined to the stream, and count when the key has no state yet: what
Spark takes as initial state reaches Python as one Arrow batch a key, and cost more than all the rules.
A stream that goes on after a restart has to be given the same tables. The reorder point and the lead
time come from static tables too. A product's rows of one micro-batch are sorted together, so bound the
micro-batch at the source (``maxFilesPerTrigger``).

A product costs a few calls to the store in a micro-batch, however many rows, warehouses and days it has:
each list is read once, when it is needed, and written once.

Emitted rows (``event``): ADMISSION (one per movement, the C1 columns), RAISED (a new alert with
its suggested quantity) and RESOLVED (an open alert closed by an increase).
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from stockflow.functions.exprs import (DEFAULT_LEAD_TIME_DAYS, DEFAULT_LOOKBACK_DAYS, INSUFFICIENT_MSG, SAFETY_FACTOR_DEN,
                                       SAFETY_FACTOR_NUM)
from stockflow.operators.admission import INSUFFICIENT_STOCK, INVALID_QTY, NEGATIVE_STOCK, NO_STOCK_ROW, SCAN
from stockflow.operators.forecast import product_lead_time
from stockflow.session import cut_lineage, ensure_checkpoint_dir
from stockflow.streaming.aggregates import as_instant

KEY = ["product_id", "warehouse_id"]
PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DAY_MS = 86_400_000
EPOCH_DAY = dt.date(1970, 1, 1).toordinal()

EVENT_SCHEMA = T.StructType([
    T.StructField("event", T.StringType()), T.StructField("product_id", T.LongType()),
    T.StructField("warehouse_id", T.LongType()), T.StructField("request_id", T.LongType()),
    T.StructField("request_time", T.TimestampNTZType()), T.StructField("kind", T.StringType()),
    T.StructField("qty", T.LongType()), T.StructField("accepted", T.BooleanType()),
    T.StructField("reject_reason", T.StringType()), T.StructField("available", T.LongType()),
    T.StructField("qty_after", T.LongType()), T.StructField("stock_updated", T.BooleanType()),
    T.StructField("message", T.StringType()), T.StructField("alert_id", T.LongType()),
    T.StructField("suggested_qty", T.LongType()),
])
EVENT = Row(*EVENT_SCHEMA.names)
#: What a movement brings to its product, as one column: Python takes a struct faster than its fields.
MOVEMENT = ["request_id", "request_time", "warehouse_id", "kind", "qty", "reorder_min", "active_flag", "lead_time_days",
            "opening_qty", "open_alerts", "days", "units"]


def judge(kind: str, qty: int | None, balance: int | None) -> tuple[str | None, int | None]:
    """Verdict (None: accepted) on a movement and the balance after it; a balance of None is no row."""
    if kind == SCAN:
        return None, balance
    if kind == "ORDER" and balance is None:
        return NO_STOCK_ROW, None
    if qty is None or (kind != "RECEIPT" and qty <= 0):
        return INVALID_QTY, balance
    if kind == "ORDER":
        return (None, balance - qty) if balance >= qty else (INSUFFICIENT_STOCK, balance)
    if kind == "RECEIPT":
        after = (balance or 0) + qty
        return (None, after) if after >= 0 else (NEGATIVE_STOCK, balance)
    return None, None if balance is None else balance + qty


def suggest(days: dict[int, int], today: int, lookback: int, lead: int) -> int:
    """Exact ceiling of the weighted average x lead time x safety factor over issued units per day."""
    part = {d: lookback - (today - d) for d in days if today - d < lookback}
    wden = sum(part.values())
    wsum = sum(days[d] * w for d, w in part.items())
    return -(-wsum * lead * SAFETY_FACTOR_NUM // (wden * SAFETY_FACTOR_DEN)) if wden else 0


class InventoryProcessor(StatefulProcessor):
    """The rules of C1, D1, D2 and D4 on the warehouses of one product."""

    def __init__(self, lookback: int):
        self.lookback = lookback

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.stock = handle.getListState("stock", "warehouse_id long, balance long, alerts array<long>")
        self.days = handle.getListState("days", "warehouse_id long, day int, units long")

    def _keep(self, days: dict[tuple, int], timer: bool) -> None:
        """Write the days; ``timer``: none is set yet for the time at which no alert can look back to the oldest."""
        self.days.put([(w, d, u) for (w, d), u in days.items()])
        if timer:
            self.handle.registerTimer((min(d for _, d in days) + self.lookback) * DAY_MS)

    def _past(self) -> dict[tuple, int]:
        return {(w, int(d)): int(u) for w, d, u in self.days.get()}

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802
        stock = {w: (bal, list(ids or ())) for w, bal, ids in self.stock.get()}
        was = {w: (bal, list(ids)) for w, (bal, ids) in stock.items()}
        past = self._past() if stock else {}
        timer = not past                          # a product with days in the store has a timer
        dirty = False
        movements = [tuple(r.m.values()) for r in rows]
        movements.sort(key=lambda m: (m[1], m[0] is not None, m[0]))
        for i, t, w, kind, q, least, active, lead, opening, alerts, days, units in movements:
            if w not in stock:
                stock[w] = opening, list(alerts or ())
                past.update(((w, d), u) for d, u in zip(days or (), units or ()))
                dirty = dirty or bool(days)
            before, open_ids = stock[w]
            why, bal = judge(kind, q, before)
            scan = kind == SCAN
            updated = why is None and before is not None and not scan
            row = (*key, w, i, t, kind, q)
            message = f"{INSUFFICIENT_MSG[0]}{before}{INSUFFICIENT_MSG[1]}{q}" if why == INSUFFICIENT_STOCK else None
            yield EVENT("ADMISSION", *row, why is None, why, before, bal, updated, message, None, None)
            looks = scan and before is not None and active == "Y"
            day = t.toordinal() - EPOCH_DAY
            if least is not None and (updated or looks):      # the rules run before the ledger row exists
                if updated and bal > before and bal > least:
                    for a in sorted(open_ids):
                        yield EVENT("RESOLVED", *row, None, None, before, bal, None, None, a, None)
                    open_ids = []
                elif bal <= least and (looks or not open_ids):
                    s = suggest({d: u for (v, d), u in past.items() if v == w}, day, self.lookback, lead)
                    yield EVENT("RAISED", *row, None, None, before, bal, None, None, i, max(s, least) if looks else s)
                    open_ids = [*open_ids, i]
            stock[w] = bal, open_ids
            if why is None and kind == "ORDER":
                past[w, day] = past.get((w, day), 0) + q
                dirty = True
        if stock != was:
            self.stock.put([(w, bal, list(dict.fromkeys(ids))) for w, (bal, ids) in stock.items()])
        if dirty:
            self._keep(past, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        left = {k: u for k, u in self._past().items() if (k[1] + self.lookback) * DAY_MS > now}
        if left:
            self._keep(left, True)
        else:
            self.days.clear()
        return iter(())

    def close(self) -> None:
        pass


def initial_state(opening: DataFrame, open_alerts: DataFrame | None = None, log: DataFrame | None = None) -> DataFrame:
    """One row per key: opening balance, ids of open alerts, and units issued per earlier day."""
    rows = [opening.select(*KEY, F.col("qty_on_hand").cast("long").alias("opening_qty"))]
    if open_alerts is not None:
        rows.append(open_alerts.filter("resolved_flag = 'N'").select(*KEY, F.col("alert_id").cast("long").alias("_id")))
    if log is not None:
        day = F.datediff(F.to_date("txn_time"), F.lit("1970-01-01").cast("date"))
        rows.append(log.filter("txn_type = 'ISSUE'").groupBy(*KEY, day.alias("_day"))
                    .agg(F.sum(F.abs("qty_change")).cast("long").alias("_units")))
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    ids, days = F.lit(None).cast("array<long>"), F.lit(None).cast("array<struct<_day:int,_units:long>>")
    if open_alerts is not None:
        ids = F.sort_array(F.collect_set("_id"))
    if log is not None:
        days = F.collect_list(F.when(F.col("_day").isNotNull(), F.struct("_day", "_units")))
    g = out.groupBy(*KEY).agg(F.max("opening_qty").alias("opening_qty"), ids.alias("open_alerts"), days.alias("_days"))
    return g.select(*KEY, "opening_qty", "open_alerts", F.col("_days")["_day"].alias("days"), F.col("_days")["_units"].alias("units"))


def inventory_events(movement_stream: DataFrame, opening: DataFrame, products: DataFrame,
                     suppliers: DataFrame, lookback: int = DEFAULT_LOOKBACK_DAYS, open_alerts: DataFrame | None = None,
                     log: DataFrame | None = None, watermark: str = "1 day") -> DataFrame:
    """S1 + S4 on a movement stream (schema ``schemas.MOVEMENTS``); returns the event stream.

    ``open_alerts`` (with ``alert_id``) and the ledger ``log`` are what came before the stream. The session has
    to name the RocksDB state store (``streaming.finite.rocksdb`` or ``PROVIDER_CONF``).
    """
    lead = product_lead_time(products, suppliers)
    p = products.select("product_id", "reorder_min", "active_flag").join(lead, "product_id", "left")
    start = cut_lineage(initial_state(opening, open_alerts, log)).withColumnsRenamed({c: f"_{c}" for c in KEY})
    same = F.lit(True)
    for c in KEY:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    s = (movement_stream.join(p, "product_id", "left").join(start, same, "left").drop(*[f"_{c}" for c in KEY])
         .withColumn("lead_time_days", F.coalesce("lead_time_days", F.lit(DEFAULT_LEAD_TIME_DAYS)))
         .select("product_id", as_instant("request_time").alias("_at"), F.struct(*MOVEMENT).alias("m")).withWatermark("_at", watermark))
    return s.groupBy("product_id").transformWithState(InventoryProcessor(lookback), EVENT_SCHEMA, "append", "EventTime")


def stream_order_admission(events: DataFrame) -> DataFrame:
    """The admission rows of the event stream (the C1 columns)."""
    return events.filter(F.col("event") == "ADMISSION").drop("event", "alert_id", "suggested_qty")


def stream_alerts(events: DataFrame) -> DataFrame:
    """Alert events (RAISED with qty_on_hand and suggested_qty; RESOLVED with alert_id)."""
    return events.filter(F.col("event") != "ADMISSION").select(
        "event", "alert_id", *KEY, F.col("qty_after").alias("qty_on_hand"), "suggested_qty",
        F.col("request_time").alias("event_time"))


def stream_checkpoint(spark, name: str) -> str:
    """The checkpoint location of a named streaming query in the shared checkpoint folder.

    It depends on the name alone, so a restarted query goes on from its offsets and state."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"
