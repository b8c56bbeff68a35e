"""Explicit schemas of the eight inventory tables (never inferred).

The source DATE type carries time of day, so every clock column is TIMESTAMP_NTZ; ids and quantities are
64-bit integers; Y/N flags stay strings so that NULL remains distinguishable.
"""

from pyspark.sql import types as T

L, I, S = T.LongType(), T.IntegerType(), T.StringType()
NTZ = T.TimestampNTZType()


def _s(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


SUPPLIERS = _s(("supplier_id", L, False), ("supplier_name", S, False),
               ("lead_time_days", I, False), ("contact_email", S, True))
WAREHOUSES = _s(("warehouse_id", L, False), ("warehouse_name", S, False), ("location", S, True))
PRODUCTS = _s(("product_id", L, False), ("sku", S, False), ("product_name", S, False),
              ("unit_price", T.DecimalType(10, 2), False), ("supplier_id", L, True),
              ("reorder_min", L, False), ("active_flag", S, True))
PRODUCT_STOCK = _s(("product_id", L, False), ("warehouse_id", L, False),
                   ("qty_on_hand", L, False), ("last_updated", NTZ, True))
ORDERS = _s(("order_id", L, False), ("warehouse_id", L, False), ("order_date", NTZ, False),
            ("status", S, True))
ORDER_ITEMS = _s(("order_item_id", L, False), ("order_id", L, False), ("product_id", L, False),
                 ("qty_ordered", L, False))
STOCK_TXN_LOG = _s(("log_id", L, False), ("product_id", L, False), ("warehouse_id", L, False),
                   ("txn_type", S, False), ("qty_change", L, False), ("txn_time", NTZ, True),
                   ("performed_by", S, True))
LOW_STOCK_ALERTS = _s(("alert_id", L, False), ("product_id", L, False), ("warehouse_id", L, False),
                      ("qty_on_hand", L, False), ("suggested_qty", L, False),
                      ("raised_on", NTZ, True), ("resolved_flag", S, True))

# A movement request for the bulk admission fold (C1): one row per place_order / receive_stock /
# cancellation restock call, ordered by (request_time, request_id).
MOVEMENTS = _s(("request_id", L, False), ("request_time", NTZ, False), ("product_id", L, False),
               ("warehouse_id", L, False), ("kind", S, False), ("qty", L, True))

TABLES = {
    "suppliers": SUPPLIERS, "warehouses": WAREHOUSES, "products": PRODUCTS,
    "product_stock": PRODUCT_STOCK, "orders": ORDERS, "order_items": ORDER_ITEMS,
    "stock_txn_log": STOCK_TXN_LOG, "low_stock_alerts": LOW_STOCK_ALERTS,
}

# Fixed values of the data model (must equal the source module's table definitions).
TXN_TYPES = ("ISSUE", "RECEIPT", "ADJUSTMENT")
ORDER_STATUSES = ("PLACED", "FULFILLED", "CANCELLED")
FLAG_VALUES = ("Y", "N")
MOVEMENT_KINDS = ("ORDER", "RECEIPT", "RESTOCK")
