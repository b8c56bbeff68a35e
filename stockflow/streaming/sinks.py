"""Idempotent file sink for streaming results.

A micro-batch that is retried after a failure is written again with the same ``batch_id``;
writing each batch into its own ``batch_id=<n>`` partition with overwrite makes the retry replace
its earlier attempt instead of duplicating rows (exactly-once output on top of the checkpointed
source offsets). Plain parquet has no MERGE, so this is the idempotence the file sink offers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stockflow.streaming.stateful import stream_checkpoint


def write_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """Write one micro-batch into ``path/batch_id=<batch_id>``, replacing any earlier attempt."""
    (batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(path))


def start_idempotent_sink(stream: DataFrame, path: str, name: str, available_now: bool = False,
                          checkpoint_location: str | None = None, mode: str = "append") -> StreamingQuery:
    """Run ``stream`` into ``path`` through ``foreachBatch`` + ``write_batch``; the checkpoint
    location defaults to a folder under the session's shared checkpoint directory."""
    w = (stream.writeStream.outputMode(mode).foreachBatch(lambda df, bid: write_batch(df, bid, path))
         .option("checkpointLocation", checkpoint_location or stream_checkpoint(stream.sparkSession, name)))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.queryName(name).start()
