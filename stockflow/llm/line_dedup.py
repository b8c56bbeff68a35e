"""Operator 11: removing lines that many documents share.

Lines are exploded with their position, normalised and hashed; per hash the documents that hold it
are counted (each document once, summed before the shuffle) together with the largest id among them.
Keys that reach the threshold lose their lines in every other document, and the remaining lines are
put together again by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.session import cut_lineage

#: Upper and lower case of the letters that are folded, and the characters stripped from lines.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\x0c\r"

#: A key that holds at least this part of all counted lines is heavy: there are at most so many,
#: so the heavy keys are broadcast and no other key gathers more in one task.
HEAVY_PARTS = 4096


def split_lines(text: Column) -> Column:
    """The lines of a text; null and empty texts are one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """A line without blanks at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def hash_pair(c: Column) -> Column:
    """128 bits of a text in two seeds, so that different lines do not meet."""
    return F.struct(F.xxhash64(c).alias("a"), F.xxhash64(F.lit(7), c).alias("b"))


def keyed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``id``, ``ta``, ``tb`` (hashes of the text) and ``lines``: position and key hash (``pos``,
    ``k``) of every line whose key has at least ``min_chars`` characters."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = hash_pair(text)
    lines = F.transform(split_lines(text), lambda x, i: F.struct(i.alias("pos"), line_key(x).alias("key")))
    long_ones = F.filter(lines, lambda s: F.length(s["key"]) >= min_chars)
    return docs.select(
        F.col(id_col).alias("id"), whole["a"].alias("ta"), whole["b"].alias("tb"),
        F.transform(long_ones, lambda s: F.struct(s["pos"].alias("pos"), hash_pair(s["key"]).alias("k"))).alias("lines"))


def shared_keys(keyed: DataFrame, min_docs: int) -> DataFrame:
    """``a``, ``b``, ``n`` (documents) and ``holder`` (largest id) of keys in ``min_docs`` documents."""
    once = keyed.select("id", F.explode(F.array_distinct(F.transform("lines", lambda s: s["k"]))).alias("k"))
    return (once.groupBy(F.col("k.a").alias("a"), F.col("k.b").alias("b"))
            .agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("holder"))
            .filter(F.col("n") >= min_docs))


def remove_shared_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Documents without the lines that ``min_docs`` documents share.

    Returns one row per input row: ``doc_id``, ``n_lines`` (before), ``n_dropped``,
    ``kept_sha256`` (of the kept text in UTF-8) and ``kept``, the text itself. Of a shared key the
    lines in the document of the largest id stay, all of them; keys shorter than ``min_chars`` code
    points always stay.

    Every row is a document of its own, rows that repeat an id too; rows of the largest id all keep
    their lines. A null id is smaller than any other (where only null ids hold a key, all keep
    it). Null and empty texts are one empty line. Other columns are ignored; an empty table gives
    no rows. Heavy keys (at most ``HEAVY_PARTS``) are looked up in a broadcast, all others in a
    shuffle in which none of them is large.
    """
    keyed = keyed_lines(docs, id_col, text_col, min_chars)
    shared = cut_lineage(shared_keys(keyed, min_docs))
    total = shared.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    is_heavy = F.col("n") * HEAVY_PARTS >= F.lit(total)
    heavy = shared.filter(is_heavy).select(F.col("a").alias("ha"), F.col("b").alias("hb"), F.struct("holder").alias("h"))
    light = shared.filter(~is_heavy).select(F.col("a").alias("la"), F.col("b").alias("lb"), F.struct("holder").alias("l"))
    lines = (keyed.select("id", "ta", "tb", F.explode("lines").alias("x"))
             .select("id", "ta", "tb", F.col("x.pos").alias("pos"), F.col("x.k.a").alias("a"), F.col("x.k.b").alias("b")))
    seen = lines.join(F.broadcast(heavy), (F.col("a") == F.col("ha")) & (F.col("b") == F.col("hb")), "left")
    # lines of heavy keys are through: they go on under a key that meets nothing, spread over all tasks
    through = F.col("h").isNotNull()
    seen = seen.select("id", "ta", "tb", "pos", "h", F.when(through, F.xxhash64("ta", "pos")).otherwise(F.col("a")).alias("a"),
                       F.when(~through, F.col("b")).alias("b"))
    hit = (seen.join(light, (F.col("a") == F.col("la")) & (F.col("b") == F.col("lb")), "left")
           .select("id", "ta", "tb", "pos", F.coalesce("h", "l").alias("of")).filter(F.col("of").isNotNull())
           .select("id", "ta", "tb", "pos", "of.holder"))
    # alike rows lose alike positions: a set, no larger than the lines of one text
    drops = (hit.filter(~F.col("id").eqNullSafe(F.col("holder")))
             .groupBy("id", "ta", "tb").agg(F.collect_set("pos").alias("gone"))
             .select(F.col("id").alias("_id"), F.col("ta").alias("_ta"), F.col("tb").alias("_tb"), "gone"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"),
                       hash_pair(text)["a"].alias("ta"), hash_pair(text)["b"].alias("tb"))
    joined = rows.join(drops, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("ta") == F.col("_ta"))
                       & (F.col("tb") == F.col("_tb")), "left")
    cut = (joined.withColumn("_lines", split_lines(F.col("_text")))
           .withColumn("n_lines", F.size("_lines").cast("long"))
           .withColumn("n_dropped", F.coalesce(F.size("gone"), F.lit(0)).cast("long")))
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("_text")).otherwise(
        F.array_join(F.transform(places, lambda i: F.get(F.col("_lines"), i)), "\n"))
    return (cut.select("doc_id", "n_lines", "n_dropped", kept.alias("kept"))
            .select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"), "kept"))


SQL = r"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
l as (
  select r, doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos
  from d),
k as (
  select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from l),
s as (
  select key, max(doc_id) as holder from k where length(key) >= 40 group by key having count(distinct r) >= 5),
m as (
  select k.*, s.key is not null and k.doc_id is distinct from s.holder as gone from k left join s on k.key = s.key)
select doc_id, count(*) as n_lines, cast(count(*) filter (gone) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from m group by r, doc_id
"""
