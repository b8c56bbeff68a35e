"""The corpus pipeline: quality, near-duplicates, secrets, mixing, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all documents that its predecessor kept;
all but the last return the columns of documents. ``run`` writes each stage as Parquet in the
shared folder and reads it again as the next one's documents; a stage's table goes once its successor
is written, the last one stays for the result to be read from.

Rows stand for themselves: null and repeated ids, texts that are null, empty or very long, repeated
rows and columns of any name pass through every stage, each by the rule of its operator. Of rows alike
in every column near-duplicate removal keeps one. An empty table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from stockflow.llm import mixing, packing, quality, secret_scan, simhash
from stockflow.llm.common import drop, read, small_batches
from stockflow.llm.queries import VOCABULARY
from stockflow.session import ensure_checkpoint_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    small_batches(spark)
    return quality.keep_good(docs, quality.score_quality(docs, read(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each SimHash group."""
    small_batches(spark)
    return simhash.keep_one(docs, shingle=4, radius=4)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    small_batches(spark)
    return secret_scan.redact_documents(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often, and as far, as the mix takes them."""
    return mixing.mixed_documents(docs, mixing.mix_sources(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents in sequences of at most 2048 tokens."""
    small_batches(spark)
    return packing.best_fit_pack(docs, VOCABULARY)


STAGES = [("quality classifier", quality_stage), ("SimHash near-dedup", near_dedup_stage),
          ("secret scans", secrets_stage), ("mixing sources", mixing_stage), ("best-fit packing", packing_stage)]

#: Fitted models, tokenizers and fingerprints have no SQL; tests/llm/test_pipeline.py holds every stage
#: of a run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    at = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{k}")
        docs = spark.read.parquet(f"{at}/{k}")
        if k:
            drop(spark, f"{at}/{k - 1}")
    return docs
