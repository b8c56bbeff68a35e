"""Finite streams: a table replayed through a streaming query in time slices.

Each slice is appended to a folder that a file-stream source reads, and the query is started again
with ``availableNow``: it goes on from its checkpoint, as after a restart, and ends when the slice is done.
Results go through the idempotent sink, one ``batch_id`` partition a micro-batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockflow.session import ensure_checkpoint_dir
from stockflow.streaming.sinks import start_idempotent_sink
from stockflow.streaming.stateful import PROVIDER_CONF, ROCKSDB


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """The RocksDB state store for the queries started inside."""
    old = spark.conf.get(PROVIDER_CONF, None)
    spark.conf.set(PROVIDER_CONF, ROCKSDB)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(PROVIDER_CONF)
        else:
            spark.conf.set(PROVIDER_CONF, old)


def replay(df: DataFrame, time_col: str, build: Callable[[DataFrame], DataFrame], mode: str = "append",
           slices: int = 2) -> DataFrame:
    """The output rows of ``build(stream)`` with their ``batch_id``, where the stream brings ``df`` in
    ``slices`` slices of equal time, oldest first, and the query restarts for each."""
    spark = df.sparkSession
    at = f"{ensure_checkpoint_dir(spark).rstrip('/')}/finite-{uuid.uuid4().hex}"
    first, last = df.agg(F.min(time_col), F.max(time_col)).first()
    bounds = [] if first is None else [first + (last - first) * k / slices for k in range(1, slices)]
    edges = [None, *bounds, None]
    for low, high in zip(edges[:-1], edges[1:]):
        part = df
        if low is not None:
            part = part.filter(F.col(time_col) >= F.lit(low.isoformat(sep=" ")).cast("timestamp_ntz"))
        if high is not None:
            part = part.filter(F.col(time_col) < F.lit(high.isoformat(sep=" ")).cast("timestamp_ntz"))
        part.write.mode("append").parquet(f"{at}/in")
        stream = spark.readStream.schema(df.schema).parquet(f"{at}/in")
        with rocksdb(spark):
            q = start_idempotent_sink(build(stream), f"{at}/out", f"replay-{uuid.uuid4().hex}", available_now=True,
                                      checkpoint_location=f"{at}/state", mode=mode)
            q.awaitTermination()
    return spark.read.parquet(f"{at}/out")


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The last state of each key in the output of an update-mode query."""
    by = Window.partitionBy(*keys).orderBy(F.desc("batch_id"))
    return rows.withColumn("_k", F.row_number().over(by)).filter("_k = 1").drop("_k", "batch_id")
