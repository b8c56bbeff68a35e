"""The driver contract: entry() runs, and every registered query equals its DuckDB oracle (sf0.001)."""

import datetime as dt
import decimal
import math
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from stockflow.plans.registry import QUERIES   # the training-data queries have tests of their own

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def canon(cols, rows):
    return sorted((tuple(norm(r[c]) for c in cols) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["product_id", "warehouse_id", "qty_on_hand", "suggested_qty"]
    assert df.count() > 0


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) == set(E.oracle_sql()) & set(QUERIES)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    srows = [r.asDict() for r in sdf.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    drows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert sorted(sdf.columns) == sorted(rel.columns)
    cols = sorted(sdf.columns)
    assert canon(cols, srows) == canon(cols, drows)


@pytest.mark.parametrize("name", ["order_admission", "stock_position", "low_stock_alerts", "raise_low_stock_alerts",
                                  "receive_stock_ledger", "cancel_restock_alerts", "dq_negative_positions"])
def test_query_matches_oracle_in_small_chunks(spark, duck, name):
    """Same comparison with chunks of 37 rows."""
    spark.conf.set("stockflow.chunkRows", "37")
    try:
        sdf = E.queries()[name](spark, SF)
        srows = [r.asDict() for r in sdf.collect()]
    finally:
        spark.conf.unset("stockflow.chunkRows")
    rel = duck.sql(E.oracle_sql()[name])
    drows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    cols = sorted(sdf.columns)
    assert canon(cols, srows) == canon(cols, drows)


def test_admission_shows_every_reason(spark):
    got = {r.reject_reason for r in E.queries()["order_admission"](spark, "/root/testdata/sf0.01").select("reject_reason").distinct().collect()}
    assert got == {None, "NO_STOCK_ROW", "INSUFFICIENT_STOCK", "INVALID_QTY", "NEGATIVE_STOCK"}


def test_ids_are_distinct(spark):
    """Alert, item and log ids are dense or at least distinct, and the same in a rerun with another
    number of partitions."""
    q = E.queries()
    for name, col in (("low_stock_alerts", "alert_id"), ("cancel_restock_ledger", "log_id"), ("ledger_append_restock", "log_id")):
        first = sorted(map(tuple, q[name](spark, SF).collect()), key=repr)
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        try:
            df = q[name](spark, SF)
            rows = df.collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert sorted(map(tuple, rows), key=repr) == first
        ids = [r[col] for r in rows]
        assert len(set(ids)) == len(ids)
        if name == "low_stock_alerts":
            assert sorted(ids) == list(range(1, len(ids) + 1))


@pytest.mark.parametrize("lost", ["corpus_pipeline", "stockflow.llm", "xxhash", "tokenizers"])
def test_inventory_queries_without_the_training_data_part(lost):
    """Without the subpackage, the pipeline or a library of theirs the entry file still loads."""
    code = (f"import sys; sys.modules[{lost!r}] = None; sys.path.insert(0, {os.path.dirname(os.path.abspath(E.__file__))!r})\n"
            "import __spark_entry__ as E; from stockflow.plans.registry import QUERIES\n"
            "assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())")
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
