"""Table-rule checks (E1-E5): the source's declared constraints re-aimed as data-quality
operators that return the violating rows instead of rejecting writes.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stockflow.functions.exprs import check_fails, ts_lit
from stockflow.sources import schemas


def dq_duplicate_keys(df: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Key values held by more than one row (PRIMARY KEY / UNIQUE), with their row count.

    A plain grouped count: partial counts per task, so a hot key costs one row per task.
    """
    return (df.groupBy(*key_cols).agg(F.count(F.lit(1)).cast("long").alias("n"))
            .filter(F.col("n") > 1))


def dq_orphans(child: DataFrame, fk_cols: Sequence[str], parent: DataFrame,
               pk_cols: Sequence[str]) -> DataFrame:
    """Child rows whose foreign key has no parent; a NULL in the key is valid (not checked)."""
    not_null = F.lit(True)
    for c in fk_cols:
        not_null = not_null & F.col(c).isNotNull()
    p = parent.select(*[F.col(pk).alias(fk) for pk, fk in zip(pk_cols, fk_cols)])
    return child.filter(not_null).join(p, list(fk_cols), "left_anti")


def dq_check_violations(df: DataFrame, rule_name: str, predicate: Column | str,
                        key_cols: Sequence[str]) -> DataFrame:
    """Rows for which a CHECK predicate is FALSE (NULL passes, as in SQL)."""
    if isinstance(predicate, str):
        predicate = F.expr(predicate)
    return df.filter(check_fails(predicate)).select(
        F.lit(rule_name).alias("rule_name"),
        F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols]).alias("row_key"))


def dq_missing_required(df: DataFrame, required_cols: Sequence[str], key_cols: Sequence[str],
                        table: str = "") -> DataFrame:
    """One row per (row, NOT NULL column) holding a NULL. One pass over ``df``."""
    rules = [(c, "NOT NULL", F.col(c).isNull()) for c in required_cols]
    return broken_rules(df, table, rules, key_cols).select("table_name", "row_key", F.col("rule_name").alias("column_name"))


def row_key(key_cols: Sequence[str]) -> Column:
    """The key of a row as text, parts of a compound key joined by |."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in key_cols])


def broken_rules(df: DataFrame, table: str, rules: Sequence[tuple[str, str, Column]], key_cols: Sequence[str],
                 observation: Observation | None = None) -> DataFrame:
    """Every (row, rule) that is broken, of any number of row rules, in one pass over ``df``.

    A rule is (name, kind, condition under which it is broken). ``observation`` collects the rows read and
    the broken rows of each rule while the pass runs, so no second pass has to count them.
    """
    broken = {name: F.coalesce(cond, F.lit(False)) for name, _, cond in rules}
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("rows"),
                        *[F.count(F.when(c, 1)).alias(name) for name, c in broken.items()])
    cells = [F.when(broken[name], F.struct(F.lit(name).alias("rule_name"), F.lit(kind).alias("kind"))) for name, kind, _ in rules]
    return (df.select(row_key(key_cols).alias("row_key"), F.explode(F.array_compact(F.array(*cells))).alias("r"))
            .select(F.lit(table).alias("table_name"), "row_key", "r.rule_name", "r.kind"))


def row_rules(table: str) -> list[tuple[str, str, Column]]:
    """All row rules of a table of the source: CHECK (broken only if FALSE), NOT NULL and VARCHAR lengths."""
    out = [(name.split(".", 1)[1], "CHECK", check_fails(F.expr(pred))) for name, (tab, pred, _) in CHECK_RULES.items() if tab == table]
    out += [(f"{c}_required", "NOT NULL", F.col(c).isNull()) for c in required_columns(table)]
    return out + [(f"{c}_length", "LENGTH", F.length(c) > n) for c, n in MAX_LENGTHS.get(table, {}).items()]


# Column defaults of the source tables; _CLOCK = the as_of clock, _USER = the acting user.
_CLOCK, _USER = object(), object()
DEFAULTS = {
    "products": {"reorder_min": 10, "active_flag": "Y"},
    "product_stock": {"qty_on_hand": 0, "last_updated": _CLOCK},
    "orders": {"order_date": _CLOCK, "status": "PLACED"},
    "stock_txn_log": {"txn_time": _CLOCK, "performed_by": _USER},
    "low_stock_alerts": {"raised_on": _CLOCK, "resolved_flag": "N"},
}


def apply_defaults(df: DataFrame, table: str, as_of: dt.datetime, actor: str = "SYSTEM") -> DataFrame:
    """E5: fill the columns an INSERT omitted with the table's defaults; an explicit NULL stays
    NULL (defaults apply to omitted columns only). Output follows the table's schema order."""
    schema = schemas.TABLES[table]
    out = df
    for name, value in DEFAULTS.get(table, {}).items():
        if name in out.columns:
            continue
        if value is _CLOCK:
            v = ts_lit(as_of)
        elif value is _USER:
            v = F.lit(actor)
        else:
            v = F.lit(value)
        out = out.withColumn(name, v)
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in out.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return out.select(*cols)


# Declared CHECK rules of the source schema (SQL predicate text, parsed when used).
CHECK_RULES = {
    "products.active_flag_in_YN": ("products", "active_flag IN ('Y', 'N')", ["product_id"]),
    "product_stock.qty_on_hand_nonneg": ("product_stock", "qty_on_hand >= 0", ["product_id", "warehouse_id"]),
    "orders.status_domain": ("orders", "status IN ('PLACED', 'FULFILLED', 'CANCELLED')", ["order_id"]),
    "order_items.qty_ordered_positive": ("order_items", "qty_ordered > 0", ["order_item_id"]),
    "low_stock_alerts.resolved_flag_in_YN": ("low_stock_alerts", "resolved_flag IN ('Y', 'N')", ["alert_id"]),
}

# Longest texts of the source's columns (fixed values of its table definitions).
MAX_LENGTHS = {
    "suppliers": {"supplier_name": 120, "contact_email": 120},
    "warehouses": {"warehouse_name": 120, "location": 200},
    "products": {"sku": 40, "product_name": 150, "active_flag": 1},
    "orders": {"status": 20},
    "stock_txn_log": {"txn_type": 20, "performed_by": 60},
    "low_stock_alerts": {"resolved_flag": 1},
}

FOREIGN_KEYS = {
    "products.supplier_id": ("products", ["supplier_id"], "suppliers", ["supplier_id"]),
    "product_stock.product_id": ("product_stock", ["product_id"], "products", ["product_id"]),
    "product_stock.warehouse_id": ("product_stock", ["warehouse_id"], "warehouses", ["warehouse_id"]),
    "orders.warehouse_id": ("orders", ["warehouse_id"], "warehouses", ["warehouse_id"]),
    "order_items.order_id": ("order_items", ["order_id"], "orders", ["order_id"]),
    "order_items.product_id": ("order_items", ["product_id"], "products", ["product_id"]),
}


# Declared keys (PRIMARY KEY and UNIQUE) of the source tables.
DECLARED_KEYS = {
    "suppliers.pk": ("suppliers", ["supplier_id"]),
    "warehouses.pk": ("warehouses", ["warehouse_id"]),
    "products.pk": ("products", ["product_id"]),
    "products.sku_unique": ("products", ["sku"]),
    "product_stock.pk": ("product_stock", ["product_id", "warehouse_id"]),
    "orders.pk": ("orders", ["order_id"]),
    "order_items.pk": ("order_items", ["order_item_id"]),
    "stock_txn_log.pk": ("stock_txn_log", ["log_id"]),
    "low_stock_alerts.pk": ("low_stock_alerts", ["alert_id"]),
}


def required_columns(table: str) -> list[str]:
    return [f.name for f in schemas.TABLES[table].fields if not f.nullable]
