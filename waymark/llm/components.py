"""Connected components of a graph of numbered nodes, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymark.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """node and root (the least node it is connected with) for every node of `links` (a, b); roots themselves included.

    Each round links all neighbours of a node to the least one, first those above the node, then those below; the
    number of rounds grows with the logarithm of the longest path. Each round is a saved table.
    """
    edges = saved(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("_least"))
        above = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("_least").alias("b")).distinct()
        least = above.groupBy("a").agg(F.min("b").alias("_least"))
        below = above.join(least, "a").where("b <> _least").select(F.col("b").alias("a"), F.col("_least").alias("b"))
        edges = saved(below.union(least).distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select("b", "b").distinct())
