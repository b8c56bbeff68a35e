"""Connected components of a link table by alternating stars, all in joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.session import cut_lineage


def _large_star(e: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour (or itself)."""
    sym = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = sym.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("k"), F.least("u", "m").alias("m"))
    return (sym.filter("v > u").join(low, F.col("u") == F.col("k"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to its smallest neighbour."""
    low = e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
    pulled = (e.join(low, F.col("u") == F.col("k")).filter("v != m")
              .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return pulled.unionByName(low.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """Smallest member of each linked node's component, from links ``u``, ``v`` (long).

    Returns ``node``, ``root`` for every node that has a link and is not itself the root. Every
    round halves the depth at least; the loop ends when the stars no longer change, which is
    seen from their number and the sum of their hashes. Links and stars stay distributed, each
    round in the shared checkpoint folder; only the two figures reach the driver.
    """
    e = cut_lineage(links.filter("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    while True:
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
        e = cut_lineage(_small_star(_large_star(e)))
