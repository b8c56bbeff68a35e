"""Pieces shared by the two vector operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(v: Column) -> Column:
    """True for vectors without null or non-finite components and of a non-zero, finite length."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return v.isNotNull() & F.coalesce(~bad, F.lit(False)) & F.exists(v, lambda x: x != 0)


def usable_rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id``, ``v`` (doubles), ``dim`` of the rows that take part; null ids do not."""
    v = F.col(vector_col)
    return (vectors.filter(F.col(id_col).isNotNull() & usable(v))
            .select(F.col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("v"))
            .withColumn("dim", F.size("v")))


def matrix(column) -> np.ndarray:
    """Rows of an equal-length list column as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros((0, 0))
    return np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by the largest component first, so nothing overflows."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def cosines(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray, step: int = 200_000) -> np.ndarray:
    """Cosine of the unit rows ``x[i]`` and ``y[j]`` in double precision, pair by pair."""
    out = np.empty(len(i))
    for a in range(0, len(i), step):
        out[a:a + step] = np.einsum("ij,ij->i", x[i[a:a + step]], y[j[a:a + step]])
    return out
