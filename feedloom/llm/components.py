"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` to (node, root): the least node reachable, for every node that has a link.

    Each round hangs the larger neighbours of every node, then its smaller ones, below the
    least neighbour; only minima per node are aggregated, so a node with very many links is
    combined before it is shuffled. Every round is stored, and the loop ends when a round changes nothing.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where(F.col("u") != F.col("v")).distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where(F.col("u") != F.col("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v"))
        edges = stored(small.union(down.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    roots = edges.groupBy("u").agg(F.min("v").alias("root"))
    return roots.select(F.col("u").alias("node"), "root").union(roots.select("root", "root").distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
