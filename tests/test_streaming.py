"""S1-S4 on a finite stream (availableNow, one file per trigger): streaming result = batch result."""

import datetime as dt
import os
import shutil
import time
import uuid

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from stockflow.operators import alerts as al
from stockflow.operators import movements as mv
from stockflow.operators import reports as rp
from stockflow.session import cut_lineage
from stockflow.sources import driver_tables as D
from stockflow.sources import schemas
from stockflow.streaming import aggregates as sa
from stockflow.streaming import stateful as ss
from stockflow.streaming.finite import rocksdb
from stockflow.streaming.sinks import start_idempotent_sink, write_batch
from tests.model import forecast

SF = "/root/testdata/sf0.001"


@pytest.fixture(params=["UTC", "America/Los_Angeles"])
def zone(spark, request):
    """Results must not depend on the session's zone."""
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def write_daily_files(df, path, time_col):
    """Split a small batch into one parquet file per day, oldest first (file mtime order)."""
    pdf = df.toPandas().astype({c: "Int64" for c, t in df.dtypes if t == "bigint"})
    os.makedirs(path, exist_ok=True)
    days = sorted(pdf[time_col].dt.date.unique())
    t0 = time.time() - 10_000
    for i, d in enumerate(days):
        part = pdf[pdf[time_col].dt.date == d]
        f = os.path.join(path, f"part-{i:04d}.parquet")
        part.to_parquet(f, index=False, coerce_timestamps="us")
        os.utime(f, (t0 + i, t0 + i))
    return len(days)


def run_stream(spark, df, name, mode="append"):
    q = (df.writeStream.outputMode(mode).format("memory").queryName(name)
         .option("checkpointLocation", ss.stream_checkpoint(spark, f"{name}-{uuid.uuid4().hex}"))
         .trigger(availableNow=True).start())
    q.awaitTermination(600)
    out = spark.table(name)
    return out


@pytest.fixture(scope="module")
def movement_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("movements"))
    n = write_daily_files(D.movements(spark, SF), path, "request_time")
    assert n > 5
    return path


ADMISSION = ["accepted", "reject_reason", "available", "qty_after", "stock_updated", "message"]


def test_stream_admission_and_alerts_equal_batch(spark, movement_dir, tmp_path):
    """One file a micro-batch, then a restart with another batch size: all C1 columns and all alert
    events equal the batch operators."""
    opening, prods, sups = D.movement_opening(spark, SF), D.products(spark, SF), D.suppliers(spark, SF)
    half = len(os.listdir(movement_dir)) // 2
    src = tmp_path / "in"
    src.mkdir()
    files = sorted(f for f in os.listdir(movement_dir) if f.endswith(".parquet"))
    for part, per in ((files[:half], 1), (files[half:], 5)):
        for f in part:
            shutil.copy2(os.path.join(movement_dir, f), src / f)
        stream = spark.readStream.schema(schemas.MOVEMENTS).option("maxFilesPerTrigger", per).parquet(str(src))
        with rocksdb(spark):
            start_idempotent_sink(ss.inventory_events(stream, opening, prods, sups), str(tmp_path / "out"), f"events-{per}",
                                  available_now=True, checkpoint_location=str(tmp_path / "state")).awaitTermination(600)
    ev = cut_lineage(spark.read.parquet(str(tmp_path / "out")).drop("batch_id"))
    adm = cut_lineage(mv.admit_sequence(D.movements(spark, SF), opening))
    got = {r.request_id: tuple(r[c] for c in ADMISSION) for r in ss.stream_order_admission(ev).collect()}
    assert got == {r.request_id: tuple(r[c] for c in ADMISSION) for r in adm.collect()}
    raised = cut_lineage(al.alert_timeline(al.updates_from_admission(adm), prods))
    batch = {r.alert_id: r for r in al.alert_suggested_qty(raised, mv.movement_ledger(adm), prods, sups).collect()}
    alerts = ss.stream_alerts(ev).collect()
    rais = {r.alert_id: r for r in alerts if r.event == "RAISED"}
    resolved = {r.alert_id for r in alerts if r.event == "RESOLVED"}
    assert len(batch) > 0 and set(rais) == set(batch)
    for k, b in batch.items():
        assert (rais[k].qty_on_hand, rais[k].suggested_qty, rais[k].event_time) == \
            (b.qty_on_hand, b.suggested_qty, b.raised_on)
        assert (k in resolved) == (b.resolved_flag == "Y")


def test_state_is_bounded_and_old_days_do_not_count(spark, tmp_path):
    """A year of daily orders: a key holds a lookback of days, and its alerts forecast from them alone;
    an idle key sheds its days by the timer; open alerts and earlier issues enter as initial state."""
    t0 = dt.datetime(2024, 1, 1, 9)
    prods = spark.createDataFrame([(1, "A", "a", None, None, 5, "Y"), (2, "B", "b", None, None, 5, "Y")],
                                  "product_id long, sku string, product_name string, unit_price decimal(10,2), supplier_id long, reorder_min long, active_flag string")
    sups = spark.createDataFrame([], schemas.SUPPLIERS)
    opening = spark.createDataFrame([(1, 1, 100, t0), (2, 1, 50, t0)], schemas.PRODUCT_STOCK)
    open_alerts = spark.createDataFrame([(77, 1, 1, "N"), (78, 1, 1, "N"), (79, 2, 1, "Y")],
                                        "alert_id long, product_id long, warehouse_id long, resolved_flag string")
    log = spark.createDataFrame([(0, 1, 1, "ISSUE", -9, t0 - dt.timedelta(days=3), "u")], schemas.STOCK_TXN_LOG)
    rows = []
    for d in range(365):
        t = t0 + dt.timedelta(days=d)
        rows.append((4 * d, t, 1, 1, "ORDER", 1 + d % 4))
        rows.append((4 * d + 1, t + dt.timedelta(hours=1), 1, 1, "RECEIPT", 1 + d % 4 if d % 30 else 7))
        if d < 3:
            rows.append((4 * d + 2, t, 2, 1, "ORDER", 2))
        if d in (20, 200, 201):
            rows.append((4 * d + 3, t + dt.timedelta(hours=2), 1, 1, "ORDER", {20: 102, 200: 36, 201: 0}[d]))
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for k in range(0, 365, 73):
        part = [r for r in rows if k <= (r[1] - t0).days < k + 73]
        spark.createDataFrame(part, schemas.MOVEMENTS).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schemas.MOVEMENTS).parquet(src)
        with rocksdb(spark):
            start_idempotent_sink(ss.inventory_events(stream, opening, prods, sups, open_alerts=open_alerts, log=log), out,
                                  f"year-{k}", available_now=True, checkpoint_location=str(tmp_path / "state")).awaitTermination(600)
            days = (spark.read.format("statestore").option("stateVarName", "days").load(str(tmp_path / "state"))
                    .groupBy("key").count().collect())
        per = {r["key"]["product_id"]: r["count"] for r in days}
        # a slice's own days are all alive until the watermark moves after it
        assert per.get(1, 0) <= 73 + 32 and per.get(2, 0) <= 3
    assert 2 not in per                                            # idle since day 2
    ev = spark.read.parquet(out)
    assert sorted(r.alert_id for r in ev.filter("event = 'RESOLVED'").collect())[:2] == [77, 78]
    ledger = [dict(product_id=1, warehouse_id=1, txn_type="ISSUE", qty_change=-9, txn_time=t0 - dt.timedelta(days=3))]
    adm = sorted(ev.filter("event = 'ADMISSION' AND accepted AND kind = 'ORDER' AND product_id = 1").collect(), key=lambda r: r.request_id)
    ledger += [dict(product_id=1, warehouse_id=1, txn_type="ISSUE", qty_change=-r.qty, txn_time=r.request_time, id=r.request_id) for r in adm]
    raised = ev.filter("event = 'RAISED'").collect()
    assert len(raised) > 10
    for r in raised:
        visible = [x for x in ledger if x.get("id", -1) < r.request_id]
        assert r.suggested_qty == forecast(visible, (1, 1), r.request_time)


def test_stream_daily_issue_closed_days(spark, tmp_path, zone):
    path = str(tmp_path / "ledger")
    write_daily_files(D.ledger_events(spark, SF), path, "txn_time")
    stream = spark.readStream.schema(schemas.STOCK_TXN_LOG).option("maxFilesPerTrigger", 1).parquet(path)
    got = {(r.product_id, r.warehouse_id, r.window_start): r.daily_qty
           for r in run_stream(spark, sa.stream_daily_issue(stream), "daily_issue").collect()}
    exp = {(r.product_id, r.warehouse_id, r.window_start): r.daily_qty
           for r in sa.daily_issue_frame(D.ledger_events(spark, SF)).collect()}
    assert got and set(got) <= set(exp)
    assert all(exp[k] == v for k, v in got.items())
    last = max(k[2] for k in exp)
    closed = {k for k in exp if (last - k[2]).days >= 2}
    assert closed <= set(got)          # every day the watermark has passed was emitted, exactly


def test_stream_monthly_consumption(spark, tmp_path, zone):
    path = str(tmp_path / "ledger")
    led = D.ledger_lineitem(spark, SF).filter(F.col("txn_time") < "1995-06-01")
    write_daily_files(led, path, "txn_time")
    stream = spark.readStream.schema(schemas.STOCK_TXN_LOG).option("maxFilesPerTrigger", 20).parquet(path)
    out = run_stream(spark, sa.stream_monthly_consumption(stream, D.products(spark, SF)), "monthly", mode="update")
    got = {(r.sku, r.txn_month): r.units for r in out.groupBy("sku", "txn_month").agg(F.max("units_issued").alias("units")).collect()}
    exp = {(r.sku, r.txn_month): r.units_issued for r in rp.monthly_consumption(led, D.products(spark, SF)).collect()}
    assert got == exp and len(exp) > 10


def test_idempotent_sink(spark, movement_dir, tmp_path):
    stream = spark.readStream.schema(schemas.MOVEMENTS).option("maxFilesPerTrigger", 2).parquet(movement_dir)
    opening, prods, sups = D.movement_opening(spark, SF), D.products(spark, SF), D.suppliers(spark, SF)
    out = str(tmp_path / "events")
    with rocksdb(spark):
        q = start_idempotent_sink(ss.stream_order_admission(ss.inventory_events(stream, opening, prods, sups)),
                                  out, f"admission_sink_{uuid.uuid4().hex}", available_now=True)
        q.awaitTermination(600)
    first = spark.read.parquet(out)
    n, batches = first.count(), [r.batch_id for r in first.select("batch_id").distinct().collect()]
    assert n == D.movements(spark, SF).count() and len(batches) > 1
    # a retried batch replaces its earlier output instead of adding to it
    again = first.filter(F.col("batch_id") == batches[0]).drop("batch_id")
    write_batch(again, batches[0], out)
    assert spark.read.parquet(out).count() == n


def test_checkpoint_location_is_stable(spark):
    assert ss.stream_checkpoint(spark, "q") == ss.stream_checkpoint(spark, "q") != ss.stream_checkpoint(spark, "r")


def test_session_settings_are_restored(spark):
    old = spark.conf.get(ss.PROVIDER_CONF, None)
    with rocksdb(spark):
        assert spark.conf.get(ss.PROVIDER_CONF) == ss.ROCKSDB
    assert spark.conf.get(ss.PROVIDER_CONF, None) == old


def test_a_product_costs_few_state_calls():
    """The store is called as often for many rows, warehouses and days as for few; nothing comes as initial state."""
    calls = []

    class State:
        def __init__(self, name):
            self.name, self.rows = name, []

        def get(self):
            calls.append(f"get {self.name}")
            return iter(self.rows)

        def put(self, rows):
            calls.append(f"put {self.name}")
            self.rows = list(rows)

    class Handle:
        def getListState(self, name, schema):  # noqa: N802
            return states.setdefault(name, State(name))

        def registerTimer(self, at):  # noqa: N802
            calls.append("timer")

    states = {}
    p = ss.InventoryProcessor(30)
    p.init(Handle())
    t0 = dt.datetime(2024, 1, 1)

    def rows(first, days):
        return [Row(m=dict(zip(ss.MOVEMENT, (100 * d + w, t0 + dt.timedelta(days=d), w, "ORDER", 1, 5, "Y", 7, 50, None, None, None))))
                for d in range(first, first + days) for w in range(8)]

    out = list(p.handleInputRows((1,), iter(rows(0, 1)), None))
    few, calls[:] = len(calls), []
    out += list(p.handleInputRows((1,), iter(rows(1, 39)), None))
    assert len(calls) <= few + 1 <= 6
    assert len(out) == 8 * 40 and {r.qty_after for r in out} == set(range(10, 50))
    assert len(states["stock"].rows) == 8 and len(states["days"].rows) == 8 * 40


def test_start_state_has_each_open_alert_once(spark):
    """Repeated alert rows and null keys make one row a key, with each open alert once."""
    opening = spark.createDataFrame([(1, 1, 9)], "product_id long, warehouse_id long, qty_on_hand long")
    alerts = spark.createDataFrame([(7, 1, 1, "N"), (7, 1, 1, "N"), (6, 1, 1, "N"), (5, 1, 1, "Y"), (8, None, 1, "N"), (8, None, 1, "N")],
                                   "alert_id long, product_id long, warehouse_id long, resolved_flag string")
    got = ss.initial_state(opening, alerts).collect()
    assert {(r.product_id, r.warehouse_id): (r.opening_qty, r.open_alerts) for r in got} == {(1, 1): (9, [6, 7]), (None, 1): (None, [8])}
    assert len(got) == 2
