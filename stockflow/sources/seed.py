"""The source module's seed data (suppliers, warehouses, products, opening stock) and its demo run
(ten orders of one product, a reorder scan, a receipt), as DataFrames for tests and examples.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from stockflow.sources import schemas

# The seed rows of the source module, ids in insertion order.
SUPPLIERS = [
    (1, "Al-Noor Traders", 5, "sales@alnoor-traders.example"),
    (2, "Continental Parts Co.", 12, "orders@continentalparts.example"),
]
WAREHOUSES = [
    (1, "Main Warehouse - Lahore", "Lahore, PK"),
    (2, "Regional Hub - Karachi", "Karachi, PK"),
]
PRODUCTS = [
    (1, "SKU-1001", "Hydraulic Seal Kit", Decimal("850.00"), 1, 15, "Y"),
    (2, "SKU-1002", "Bearing Assembly 6205", Decimal("420.50"), 2, 20, "Y"),
]
STOCK = [(1, 1, 100), (2, 1, 60)]
DEMO_ORDERS, DEMO_ORDER_QTY, DEMO_RECEIPT_QTY = 10, 8, 100

DEMO_TIME = dt.datetime(2024, 3, 1, 10, 0, 0)


def seed_tables(spark: SparkSession, reorder_min_1: int = 15) -> dict[str, DataFrame]:
    """Seed tables; ``reorder_min_1`` overrides product 1's reorder point (demo variants)."""
    products = [(p[0], p[1], p[2], p[3], p[4], reorder_min_1 if p[0] == 1 else p[5], p[6]) for p in PRODUCTS]
    stock = [(p, w, q, DEMO_TIME - dt.timedelta(days=1)) for p, w, q in STOCK]
    return {
        "suppliers": spark.createDataFrame(SUPPLIERS, schemas.SUPPLIERS),
        "warehouses": spark.createDataFrame(WAREHOUSES, schemas.WAREHOUSES),
        "products": spark.createDataFrame(products, schemas.PRODUCTS),
        "product_stock": spark.createDataFrame(stock, schemas.PRODUCT_STOCK),
    }


def demo_orders(spark: SparkSession, qty: int = DEMO_ORDER_QTY, n: int = DEMO_ORDERS) -> DataFrame:
    """The demo's order loop: ``n`` orders of product 1 at warehouse 1, all at one instant."""
    rows = [(i, DEMO_TIME, 1, 1, "ORDER", qty) for i in range(1, n + 1)]
    return spark.createDataFrame(rows, schemas.MOVEMENTS)


def demo_receipt(spark: SparkSession, qty: int = DEMO_RECEIPT_QTY, request_id: int = 100) -> DataFrame:
    return spark.createDataFrame([(request_id, DEMO_TIME + dt.timedelta(minutes=5), 1, 1, "RECEIPT", qty)],
                                 schemas.MOVEMENTS)
