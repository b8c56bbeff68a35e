"""Stock movements (C1b-C5): order outputs, receipts, ledger append, cancellation restock and
running stock positions, as bulk operators over a batch of movements. The admission itself (C1) is in
``operators.admission``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.functions.exprs import ts_lit
from stockflow.functions.running import CHUNK, chunked, dense_ids, running_sums
from stockflow.operators.admission import (INSUFFICIENT_STOCK, INVALID_QTY, KEY, NEGATIVE_STOCK, NO_STOCK_ROW, SCAN,
                                           admit_movements, admit_sequence)
from stockflow.session import cut_lineage

__all__ = ["INSUFFICIENT_STOCK", "INVALID_QTY", "KEY", "NEGATIVE_STOCK", "NO_STOCK_ROW", "SCAN", "admit_movements",
           "admit_sequence", "order_outputs", "movement_ledger", "closing_stock", "receive_stock", "receipt_ledger",
           "ledger_append", "write_ledger", "read_ledger", "cancel_restock", "cancel_updates", "stock_position"]

UNKNOWN_KEY = "UNKNOWN_KEY"           # a receipt for a product or warehouse that does not exist (foreign keys)


def order_outputs(admitted: DataFrame, actor: str = "SYSTEM") -> dict[str, DataFrame]:
    """Admitted orders become a FULFILLED order, one order item and one ISSUE ledger row.

    Ids: the request id is carried as order id, item id and log id.
    """
    ok = admitted.filter((F.col("kind") == "ORDER") & F.col("accepted"))
    orders = ok.select(F.col("request_id").alias("order_id"), "warehouse_id",
                       F.col("request_time").alias("order_date"), F.lit("FULFILLED").alias("status"))
    items = ok.select(F.col("request_id").alias("order_item_id"), F.col("request_id").alias("order_id"),
                      "product_id", F.col("qty").alias("qty_ordered"))
    ledger = ok.select(F.col("request_id").alias("log_id"), *KEY, F.lit("ISSUE").alias("txn_type"),
                       (-F.col("qty")).alias("qty_change"), F.col("request_time").alias("txn_time"),
                       F.lit(actor).alias("performed_by"))
    return {"orders": orders, "order_items": items, "ledger": ledger}


def movement_ledger(admitted: DataFrame, actor: str = "SYSTEM") -> DataFrame:
    """The ledger rows written by admitted movements: ISSUE (-qty), RECEIPT (+qty), ADJUSTMENT (+qty).

    A restock is logged even when no stock row exists (the source writes the row regardless); a
    scan moves nothing.
    """
    ok = admitted.filter(F.col("accepted") & (F.col("kind") != SCAN))
    k = F.col("kind")
    return ok.select(
        F.col("request_id").alias("log_id"), *KEY,
        F.when(k == "ORDER", "ISSUE").when(k == "RECEIPT", "RECEIPT").otherwise("ADJUSTMENT").alias("txn_type"),
        F.when(k == "ORDER", -F.col("qty")).otherwise(F.col("qty")).cast("long").alias("qty_change"),
        F.col("request_time").alias("txn_time"), F.lit(actor).alias("performed_by"))


def closing_stock(admitted: DataFrame, opening: DataFrame) -> DataFrame:
    """Stock after the batch: per key the balance and time of the last movement that wrote the
    stock row (accepted, row present); keys without one keep their opening row."""
    last = (admitted.filter(F.col("accepted") & F.col("qty_after").isNotNull() & (F.col("kind") != SCAN))
            .groupBy(*KEY).agg(F.max_by(F.struct("qty_after", "request_time"),
                                        F.struct("request_time", "request_id")).alias("_l")))
    o = opening.select(*KEY, "qty_on_hand", "last_updated")
    j = o.join(last, KEY, "full_outer")
    return j.select(*KEY, F.coalesce("_l.qty_after", "qty_on_hand").alias("qty_on_hand"),
                    F.coalesce("_l.request_time", "last_updated").alias("last_updated"))


def judge_receipts(stock: DataFrame, receipts: DataFrame, products: DataFrame | None = None,
                   warehouses: DataFrame | None = None) -> DataFrame:
    """Every receipt with its verdict: ``accepted``, ``reject_reason`` (UNKNOWN_KEY, INVALID_QTY,
    NEGATIVE_STOCK) beside ``receipt_id``, key, ``qty``, ``received_at``.

    A receipt that is not negative always stands on its own. Only keys with a negative receipt depend
    on the order (the stock may not go below zero in between); those go through the admission.
    """
    r = receipts.select(*KEY, F.col("qty").cast("long").alias("qty"),
                        F.col("received_at").cast("timestamp_ntz").alias("received_at"),
                        F.col("receipt_id").cast("long").alias("receipt_id"))
    known = F.col("product_id").isNotNull() & F.col("warehouse_id").isNotNull()
    for dim, key in ((products, "product_id"), (warehouses, "warehouse_id")):
        if dim is not None:
            r = r.join(dim.select(key).withColumn(f"_{key}", F.lit(True)), key, "left")
            known = known & F.col(f"_{key}").isNotNull()
    reason = F.when(~known, UNKNOWN_KEY).when(F.col("qty").isNull(), INVALID_QTY)
    r = r.select("receipt_id", *KEY, "qty", "received_at", reason.alias("reject_reason"))
    cols = ["receipt_id", *KEY, "qty", "received_at", "accepted", "reject_reason"]
    odd = (r.filter(F.col("reject_reason").isNull() & (F.col("qty") < 0)).select(*KEY).distinct())
    plain = r.filter(F.col("reject_reason").isNull()).join(odd, KEY, "left_anti")
    requests = (r.filter(F.col("reject_reason").isNull()).join(odd, KEY, "left_semi")
                .select(F.col("receipt_id").alias("request_id"), F.col("received_at").alias("request_time"), *KEY,
                        F.lit("RECEIPT").alias("kind"), "qty"))
    judged = admit_movements(requests, stock.join(odd, KEY, "left_semi")).select(
        F.col("request_id").alias("receipt_id"), *KEY, "qty", F.col("request_time").alias("received_at"), "accepted", "reject_reason")
    return (r.filter(F.col("reject_reason").isNotNull()).withColumn("accepted", F.lit(False)).select(*cols)
            .unionByName(plain.withColumn("accepted", F.lit(True)).select(*cols)).unionByName(judged.select(*cols)))


def receive_stock(stock: DataFrame, receipts: DataFrame, products: DataFrame | None = None,
                  warehouses: DataFrame | None = None) -> DataFrame:
    """Upsert receipts into the stock snapshot (MERGE: matched -> add, else insert).

    Accepted receipts (``judge_receipts``) are summed per key (partial aggregation, then one full
    outer join). New rows need a known product and warehouse (foreign keys); receipts that fail
    leave no trace.
    """
    ok = judge_receipts(stock, receipts, products, warehouses).filter("accepted")
    add = ok.groupBy(*KEY).agg(F.sum("qty").cast("long").alias("_add"), F.max("received_at").alias("_at"))
    s = stock.select(*KEY, "qty_on_hand", "last_updated")
    return s.join(add, KEY, "full_outer").select(
        *KEY, (F.coalesce("qty_on_hand", F.lit(0)) + F.coalesce("_add", F.lit(0))).cast("long").alias("qty_on_hand"),
        F.coalesce("_at", "last_updated").alias("last_updated"))


def receipt_ledger(judged: DataFrame, actor: str = "SYSTEM") -> DataFrame:
    """RECEIPT ledger rows of the accepted receipts of ``judge_receipts``; rejected ones rolled back."""
    return judged.filter("accepted").select(
        F.col("receipt_id").alias("log_id"), *KEY, F.lit("RECEIPT").alias("txn_type"),
        F.col("qty").cast("long").alias("qty_change"), F.col("received_at").alias("txn_time"),
        F.lit(actor).alias("performed_by"))


LEDGER_COLS = ["log_id", "product_id", "warehouse_id", "txn_type", "qty_change", "txn_time", "performed_by"]


def ledger_append(existing: DataFrame | None, rows: DataFrame, as_of: dt.datetime,
                  actor: str = "SYSTEM", number_by: list[str] | None = None) -> DataFrame:
    """Append typed movement rows to the ledger; omitted txn_time / performed_by take the
    defaults (the clock ``as_of`` and the acting user). Adds ``txn_date``, the partition column.

    ``number_by`` (a total order of ``rows``) gives the rows new ids that follow the largest of the
    ledger without gaps, as the source's identity column does.
    """
    if "txn_time" not in rows.columns:
        rows = rows.withColumn("txn_time", ts_lit(as_of))
    if "performed_by" not in rows.columns:
        rows = rows.withColumn("performed_by", F.lit(actor))
    if number_by:
        last = existing.agg(F.max("log_id")).first()[0] if existing is not None else None
        rows = dense_ids(rows.withColumnRenamed("log_id", "_from"), ["_from" if c == "log_id" else c for c in number_by],
                         "log_id", 1 if last is None else last + 1)
    rows = rows.select(*LEDGER_COLS)
    out = rows if existing is None else existing.select(*LEDGER_COLS).unionByName(rows)
    return out.withColumn("txn_date", F.to_date("txn_time"))


def write_ledger(ledger: DataFrame, path: str) -> None:
    """Append to a day-partitioned parquet ledger (partition pruning for the windowed reads).

    Rows are rebalanced by day: small days share a task, AQE splits a large day over several.
    """
    if "txn_date" not in ledger.columns:
        ledger = ledger.withColumn("txn_date", F.to_date("txn_time"))
    (ledger.hint("rebalance", "txn_date").write.mode("append").partitionBy("txn_date").parquet(path))


def read_ledger(spark, path: str, since: dt.datetime | None = None) -> DataFrame:
    """Read the partitioned ledger; ``since`` adds the redundant day predicate that prunes
    partitions in front of the exact time filter of the caller."""
    df = spark.read.parquet(path)
    if since is not None:
        df = df.filter(F.col("txn_date") >= F.lit(since.date()))
    return df


def cancelled_items(orders_before: DataFrame, orders_after: DataFrame, items: DataFrame) -> DataFrame:
    """Items of the orders that went from FULFILLED to CANCELLED, with the order's warehouse.

    The orders that moved are hashed and the items pass by them: no task sorts its share of all items."""
    b = orders_before.filter(F.col("status") == "FULFILLED").select("order_id")
    a = orders_after.filter(F.col("status") == "CANCELLED").select("order_id", "warehouse_id")
    it = items.select("order_item_id", "order_id", "product_id", "qty_ordered")
    moved = b.join(a.hint("shuffle_hash"), "order_id", "inner")
    return (it.join(moved.hint("shuffle_hash"), "order_id", "inner")
            .select("order_id", "warehouse_id", "order_item_id", "product_id", "qty_ordered"))


def cancel_restock(orders_before: DataFrame, orders_after: DataFrame, items: DataFrame,
                   stock: DataFrame, as_of: dt.datetime, actor: str = "SYSTEM") -> dict[str, DataFrame]:
    """C4: FULFILLED -> CANCELLED transitions return every item to the order's warehouse.

    Every item row counts (a product listed twice restocks twice). A missing stock row is left
    alone, but the ADJUSTMENT ledger row is still written (ledger and stock may then disagree,
    as in the source). Returns the new stock snapshot and the ADJUSTMENT rows.
    """
    moved = cancelled_items(orders_before, orders_after, items)
    ledger = moved.select(F.col("order_item_id").alias("log_id"), *KEY,
                          F.lit("ADJUSTMENT").alias("txn_type"),
                          F.col("qty_ordered").cast("long").alias("qty_change"),
                          ts_lit(as_of).alias("txn_time"), F.lit(actor).alias("performed_by"))
    back = moved.groupBy(*KEY).agg(F.sum("qty_ordered").cast("long").alias("_back"))
    s = stock.select(*KEY, "qty_on_hand", "last_updated")
    new_stock = s.join(back, KEY, "left").select(
        *KEY, (F.col("qty_on_hand") + F.coalesce("_back", F.lit(0))).cast("long").alias("qty_on_hand"),
        F.when(F.col("_back").isNotNull(), ts_lit(as_of)).otherwise(F.col("last_updated")).alias("last_updated"))
    return {"stock": new_stock, "ledger": ledger}


def cancel_updates(orders_before: DataFrame, orders_after: DataFrame, items: DataFrame, stock: DataFrame,
                   as_of: dt.datetime) -> DataFrame:
    """The stock UPDATEs of a cancellation batch, one per item in item order, as events for the
    alert rules (columns of ``alerts.updates_from_admission``). Pairs without a stock row have none."""
    moved = cancelled_items(orders_before, orders_after, items).join(stock.select(*KEY, "qty_on_hand"), KEY)
    q = F.col("qty_ordered").cast("long")
    rows = chunked(cut_lineage(moved.select(F.col("order_item_id").alias("seq"), *KEY, ts_lit(as_of).alias("txn_time"),
                                            q.alias("_q"), "qty_on_hand")), KEY, ["seq"])
    after = F.col("qty_on_hand") + F.col("_sum")
    return running_sums(rows, KEY, ["seq"], {"_sum": F.col("_q")}).select(
        "seq", *KEY, "txn_time", (after - F.col("_q")).alias("qty_before"), after.alias("qty_after"),
        F.lit(0).cast("long").alias("issued"), F.lit(False).alias("scan"), CHUNK)


def stock_position(opening: DataFrame, ledger: DataFrame) -> DataFrame:
    """On-hand quantity per key after every ledger movement, in (txn_time, log_id) order.

    ``qty_on_hand = opening + running sum(qty_change)``; the opening row is the first element of
    each key's sequence, so one chunked running sum does it (no extra join).
    Keys with ledger rows but no opening row start from 0.
    """
    lg = ledger.select("log_id", *KEY, "txn_type", "qty_change", "txn_time", F.lit(1).alias("_is_req"))
    op = opening.select(F.lit(None).cast("long").alias("log_id"), *KEY, F.lit("OPEN").alias("txn_type"),
                        F.col("qty_on_hand").cast("long").alias("qty_change"),
                        F.lit(None).cast("timestamp_ntz").alias("txn_time"), F.lit(0).alias("_is_req"))
    order = ["_is_req", "txn_time", "log_id"]
    rows = chunked(lg.unionByName(op), KEY, order)
    return (running_sums(rows, KEY, order, {"qty_on_hand": F.col("qty_change")})
            .filter(F.col("_is_req") == 1).drop("_is_req", CHUNK))
