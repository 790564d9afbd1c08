"""Connected components of an undirected graph held in a DataFrame.

Alternates the large-star and small-star steps (each links neighbours to the
smallest node seen), which end after a number of rounds that grows with the
logarithm of the graph.  Minima are pre-aggregated, so a hub with many
neighbours is no hot group; every round is stored, so no lineage builds up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from climark.llm.common import stored


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b of one orderable
    type); root is the smallest node reachable.  Loops and repeated edges are
    fine; no edges give no rows."""
    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, state = stored(edges, "edges"), None
    while True:
        near = _both(edges)
        low = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = near.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).filter("a <> b")
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
        edges = stored(small, "edges")
        # edges change until they are stars: the same edges twice mean the end
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"),
                        F.sum(F.xxhash64("b", "a").cast("decimal(38,0)")).alias("s")).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select("node", F.col("node").alias("root")))
