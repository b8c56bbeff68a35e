"""Operator 9: mixing sources to target weights, with DataFrame functions only.

Each document gets a hash-random key. All documents are range-sorted by source and key and cut into
chunks of a set number of rows, so a source that holds a third of all rows is spread over many
chunks, rows alike in every column too. Word counts are summed in each chunk and source, the sums
of the chunks before give each chunk its offset, and a running sum inside the chunk gives each
document its place in the source. The source is then cut at its exact budget, going round as often
as the budget asks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.functions.running import chunked, running_sums
from stockflow.llm.common import WORD, row_key
from stockflow.session import cut_lineage


def source_targets(totals: DataFrame, weights=(5, 2, 1), share: float = 1.5,
                   max_epochs: int = 2) -> DataFrame:
    """Targets of the sources from their sizes (``source``, ``source_size``), one row a source.

    Sources in code-point order (null last) weigh ``weights``, repeating, and share
    ``share`` x the total size. A source whose part exceeds ``max_epochs`` x its size is held
    there and the excess goes to the others by weight, until none is above: the water level is
    the first level, over sources ordered by how early they fill, that the next source does not
    reach. One row per source passes through one task, never document rows.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    n = len(weights)
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), ((F.col("_n") - 1) % n + 1).cast("int"))
    t = (totals.withColumn("_n", F.row_number().over(order))
         .withColumn("_w", w.cast("long"))
         .withColumn("_cap", F.col("source_size") * F.lit(int(max_epochs))))
    fill = Window.orderBy((F.col("_cap") / F.col("_w")).asc(), F.col("_n"))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    t = (t.withColumn("_held", F.coalesce(F.sum("_cap").over(before), F.lit(0)))
         .withColumn("_left", F.sum("_w").over(after))
         .withColumn("_budget", F.sum("source_size").over(whole) * F.lit(float(share)))
         .withColumn("_level", (F.col("_budget") - F.col("_held")) / F.col("_left"))
         .withColumn("_k", F.row_number().over(fill))
         .withColumn("_open", F.col("_cap") > F.col("_level") * F.col("_w")))
    level = F.min(F.when(F.col("_open"), F.struct("_k", "_level"))).over(whole)["_level"]
    t = t.withColumn("_water", level)
    target = F.when(F.col("_water").isNull() | (F.col("_cap") <= F.col("_water") * F.col("_w")),
                    F.col("_cap").cast("double")).otherwise(F.col("_water") * F.col("_w"))
    return t.select("source", "source_size", target.alias("target"))


def word_count(text) -> F.Column:
    """Words of a text; null and empty texts have none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weights=(5, 2, 1), share: float = 1.5,
                max_epochs: int = 2, seed: str = "mix") -> DataFrame:
    """How many words of each document the mix takes.

    Returns one row per input row: ``doc_id``, ``size``, ``source_size``, ``target`` (its
    source's), ``taken``, ``source`` and ``row`` (a key of all its columns). ``taken`` counts repeats:
    whole rounds first, then the documents of one more round in key order up to the budget, whose
    last document is cut. The taken words of a source sum to its target rounded down.

    Null texts and texts without words have size 0 and ``taken`` 0. A null source is a source of
    its own, ordered last. Null ids are keyed by their text. Rows repeated with the same id follow
    one another (same key, by size, then by their other columns); each counts. Other columns are
    ignored. An empty table gives an empty result. Keys depend on the rows and ``seed`` alone, so
    reruns agree, in any partitioning.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("|"), F.md5(text.cast("binary"))))
    order = ["_key", "size", "row", "_tie"]
    # texts are read once: sampling and sorting go on from the narrow rows
    slim = cut_lineage(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        F.md5(F.concat(F.lit(seed + "|"), key).cast("binary")).alias("_key"),
        row_key(text_col, *(c for c in docs.columns if c != text_col)).alias("row"),
        F.monotonically_increasing_id().alias("_tie")))      # tells rows alike in all else apart
    rows = chunked(slim, ["source"], order)
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_epochs)
    t = targets.withColumnRenamed("source", "_ts")
    placed = (running_sums(rows, ["source"], order, {"_upto": F.col("size")})
              .join(t, F.col("source").eqNullSafe(F.col("_ts"))))
    rounds = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(0)
    rest = F.floor("target") - F.col("_rounds") * F.col("source_size")
    part = F.least(F.col("size"), F.greatest(F.lit(0), rest - (F.col("_upto") - F.col("size"))))
    return (placed.withColumn("_rounds", rounds)
            .select("doc_id", "size", "source_size", "target",
                    (F.col("_rounds") * F.col("size") + part).cast("long").alias("taken"), "source", "row"))


def mixed_documents(docs: DataFrame, mix: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The documents as the mix takes them, with the columns of ``docs``.

    A document taken twice gives two rows; one taken in part is cut after its last taken word
    (and its ``n_chars`` set anew). Documents not taken are left out. Rows are matched by the key of all
    their columns, so it does not matter that ids are null or repeat: of rows alike in every column
    one meets what the mix takes of each of them.
    """
    cols = docs.columns
    once = docs.withColumn("__mx_row", row_key(text_col, *(c for c in cols if c != text_col))).dropDuplicates(["__mx_row"])
    take = mix.filter("taken > 0").select(F.col("row").alias("__mx_of"), F.col("size").alias("__mx_size"),
                                          F.col("taken").alias("__mx_taken"))
    joined = take.join(once, F.col("__mx_of") == F.col("__mx_row"))
    size, words = F.col("__mx_size"), F.col("__mx_words")
    word_runs = F.regexp_extract_all(F.col(text_col), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), 0)
    cut = F.array_join(F.slice(word_runs, F.lit(1), words.cast("int")), "")
    out = (joined.withColumn("__mx_copy", F.explode(F.expr("sequence(0L, (__mx_taken - 1) div __mx_size)")))
           .withColumn("__mx_words", F.least(size, F.col("__mx_taken") - F.col("__mx_copy") * size))
           .withColumn("__mx_text", F.when(words < size, cut).otherwise(F.col(text_col))))
    if chars_col in cols:
        out = out.withColumn(chars_col, F.when(words < size, F.length("__mx_text").cast("long")).otherwise(F.col(chars_col)))
    return out.withColumn(text_col, F.col("__mx_text")).select(*cols)
