"""Column expressions shared by the operators (all JVM-side, codegen-friendly)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the source module's business rules.
DEFAULT_LOOKBACK_DAYS = 30      # forecast lookback, days
DEFAULT_LEAD_TIME_DAYS = 7      # lead time when a product has no supplier row
SAFETY_FACTOR_NUM, SAFETY_FACTOR_DEN = 6, 5   # 1.2 = 6/5 (20 % safety buffer)
TOP_K = 10                      # rows of the top movers report
STATUS_OUT, STATUS_LOW, STATUS_OK = "OUT OF STOCK", "LOW STOCK", "HEALTHY"
INSUFFICIENT_MSG = ("Insufficient stock: available ", ", requested ")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(t: dt.datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal (zone-less, like the source's DATE/TIMESTAMP columns).

    Built from text, so neither the Python process zone nor the session zone can shift it.
    """
    if isinstance(t, str):
        t = dt.datetime.fromisoformat(t)
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def window_start(as_of: dt.datetime | str, days: int) -> dt.datetime:
    """``as_of - days`` with time of day kept (a date minus n days in the source SQL)."""
    if isinstance(as_of, str):
        as_of = dt.datetime.fromisoformat(as_of)
    return as_of - dt.timedelta(days=days)


def day_weight(txn_day, as_of_day, lookback: int = DEFAULT_LOOKBACK_DAYS) -> Column:
    """Recency weight ``lookback - (day(as_of) - day(txn))``: today = lookback, lookback days ago = 0."""
    return (F.lit(lookback) - F.datediff(col(as_of_day), col(txn_day))).cast("long")


def suggested_qty(wsum, wden, lead) -> Column:
    """``CEIL(wsum / wden * lead * 1.2)`` computed exactly in 64-bit integers.

    ``ceil(a / b) = (a + b - 1) div b`` for a >= 0, b > 0 with a = wsum*lead*6, b = wden*5.
    No history (wden NULL or 0) gives 0. Doubles and decimals both round wrongly here.
    """
    wsum, wden, lead = col(wsum).cast("long"), col(wden).cast("long"), col(lead).cast("long")
    num = wsum * lead * F.lit(SAFETY_FACTOR_NUM) + wden * F.lit(SAFETY_FACTOR_DEN) - F.lit(1)
    den = wden * F.lit(SAFETY_FACTOR_DEN)
    return (F.when(wden.isNull() | (wden == 0), F.lit(0).cast("long"))
            .otherwise(F.call_function("div", num, F.nullif(den, F.lit(0))).cast("long")))


def stock_status(qty, reorder_min) -> Column:
    """Three-way status, first match wins: 0 -> OUT OF STOCK, <= min -> LOW STOCK, else HEALTHY."""
    qty, reorder_min = col(qty), col(reorder_min)
    return (F.when(qty == 0, F.lit(STATUS_OUT))
            .when(qty <= reorder_min, F.lit(STATUS_LOW))
            .otherwise(F.lit(STATUS_OK)))


def insufficient_message(available, requested) -> Column:
    """Rejection text of an order that exceeds the available stock."""
    return F.concat(F.lit(INSUFFICIENT_MSG[0]), col(available).cast("string"),
                    F.lit(INSUFFICIENT_MSG[1]), col(requested).cast("string"))


def check_fails(predicate: Column) -> Column:
    """SQL CHECK semantics: a row violates only when the predicate is FALSE (NULL passes)."""
    return ~F.coalesce(predicate, F.lit(True))
