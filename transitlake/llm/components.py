"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from transitlake.llm.common import hold


def components(links: DataFrame, name: str) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node reachable.

    Each round points the larger neighbours of every node at its smallest neighbour (large star), then
    the smaller ones (small star). Rounds are about the logarithm of the longest chain, rows never
    exceed links plus nodes, and each round is written to the shared folder. Links to a node with very
    many neighbours are a skewed join, which adaptive execution splits.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    edges = hold(links.where("a <> b").select(larger.alias("a"), smaller.alias("b")).distinct(), name)
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Now a > b throughout. Small star: every smaller neighbour and the node itself get the smallest one.
        root = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(root, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        edges = hold(small.where("a <> b").distinct(), name)
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = state
