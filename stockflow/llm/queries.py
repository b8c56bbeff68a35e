"""The dealt operators bound to the driver's tables, with DuckDB text where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.llm import (collocations, hard_negatives, int8_join, line_dedup, mixing, one_bit, packing, ppm, quality,
                           secret_scan, simhash, suffix_dedup, toxicity)
from stockflow.llm.common import read, small_batches


VOCABULARY = packing.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"),
                                public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.score_quality(read(spark, d, "documents"), read(spark, d, "labels")).drop("key")


def op2_suffix_dedup(spark: SparkSession, d: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, d, "documents")).drop("kept")


def op3_nearest(spark: SparkSession, d: str) -> DataFrame:
    return one_bit.nearest(read(spark, d, "embeddings"), every=50, k=5)


def op4_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.score_toxicity(read(spark, d, "documents"), read(spark, d, "labels"))


def op5_secrets(spark: SparkSession, d: str) -> DataFrame:
    return secret_scan.scan_secrets(read(spark, d, "documents"))


def op6_ppm(spark: SparkSession, d: str) -> DataFrame:
    return ppm.score_texts(read(spark, d, "documents"))


def op7_near_vectors(spark: SparkSession, d: str) -> DataFrame:
    return int8_join.near_vectors(read(spark, d, "embeddings"), threshold=0.9)


def op8_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.simhash_groups(read(spark, d, "documents"), shingle=4, radius=4)


def op9_mixing(spark: SparkSession, d: str) -> DataFrame:
    return (mixing.mix_sources(read(spark, d, "documents"), weights=(5, 2, 1), share=1.5, max_epochs=2)
            .select("doc_id", "size", "source_size", "target", "taken"))


def op10_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.best_fit_pack(read(spark, d, "documents"), VOCABULARY)


def op11_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    return line_dedup.remove_shared_lines(read(spark, d, "documents"), min_chars=40, min_docs=5).drop("kept")


def op12_hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine_hard_negatives(read(spark, d, "embeddings"), label=moved, every=100, positives=5,
                                              negatives=10, low=30, high=90)


def op13_collocations(spark: SparkSession, d: str) -> DataFrame:
    return collocations.mine_collocations(read(spark, d, "documents"), at_least=30, top=2000)


def _bound(f: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        small_batches(spark)
        return f(spark, d)
    run.__name__ = f.__name__
    return run


QUERIES = {f.__name__: _bound(f) for f in (op1_quality, op2_suffix_dedup, op3_nearest, op4_toxicity, op5_secrets, op6_ppm, op7_near_vectors, op8_simhash, op9_mixing, op10_packing,
                                          op11_line_dedup, op12_hard_negatives, op13_collocations)}

#: Places come from a running sum over all rows of a source, targets from the caps in the order
#: in which sources fill.
OP9_SQL = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
         md5('mix|' || coalesce(cast(doc_id as varchar), '|' || md5(coalesce(text, '')))) as k
  from documents),
s as (
  select source, sum(size) as source_size,
         [5, 2, 1][1 + (row_number() over (order by source nulls last) - 1) % 3] as w
  from d group by source),
f as (
  select *, 2 * source_size as cap,
         sum(source_size) over () * cast(1.5 as double) as budget,
         row_number() over (order by 2 * source_size / cast(w as double), source nulls last) as i
  from s),
g as (
  select a.*, (a.budget - coalesce((select sum(b.cap) from f b where b.i < a.i), 0))
              / (select sum(b.w) from f b where b.i >= a.i) as level
  from f a),
t as (
  select source, source_size, cap, w, (select arg_min(level, i) from g where cap > level * w) as water from g),
u as (
  select source, cast(source_size as bigint) as source_size,
         case when water is null or cap <= water * w then cast(cap as double) else water * w end as target
  from t),
p as (
  select d.doc_id, d.size, u.source_size, u.target,
         sum(d.size) over (partition by d.source order by k, d.size rows unbounded preceding) - d.size as at_
  from d join u on d.source is not distinct from u.source)
select doc_id, cast(size as bigint) as size, source_size, target,
       cast(case when source_size = 0 then 0
            else (cast(floor(target) as bigint) // source_size) * size
               + least(size, greatest(0, cast(floor(target) as bigint) % source_size - at_)) end as bigint) as taken
from p
"""

ORACLE_SQL: dict[str, str] = {"op7_near_vectors": int8_join.SQL, "op9_mixing": OP9_SQL, "op11_line_dedup": line_dedup.SQL,
                              "op12_hard_negatives": hard_negatives.SQL, "op13_collocations": collocations.SQL}
