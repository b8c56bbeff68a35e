"""Session construction and lineage cutting.

The cluster names its shared checkpoint folder in ``spark.checkpoint.dir``; we read it from the
session and only set one ourselves when it is absent (local tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every stockflow job relies on; cluster deployments pass them in spark-defaults.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Suggested additions for a large cluster (about 100 TB of ledger): many shuffle partitions that
# AQE coalesces at runtime, skew-join splitting, partition sizes that fit executor memory, and
# removal of checkpoint files once their DataFrames are gone.
CLUSTER_CONF = {
    **BASE_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "stockflow", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (the cluster builds its own)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g"))
    for k, v in {**BASE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking the cluster's ``spark.checkpoint.dir`` when set.

    Only a session on a ``local`` master gets a scratch folder when nothing is configured; any
    other master must name a shared one.
    """
    try:
        sc = spark.sparkContext
    except Exception:   # Spark Connect: the server applies its own spark.checkpoint.dir
        named = spark.conf.get("spark.checkpoint.dir", "")
        if not named:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share") from None
        return named
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="stockflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (reliable, survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
