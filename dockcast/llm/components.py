"""Connected components by alternating large-star and small-star steps on a table of edges.

Each step is a minimum for each node (combined before the shuffle) joined back to the edges. The
minima are stored first, so that the join shuffles both sides itself and AQE can split a hot node's
edges over tasks. Lineage is cut by a stored table after every round; only an edge count and a
checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).collect()[0]
    return r.n, r.s


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of longs, any direction -> (node, component): the component's least node. Nodes
    without an edge to another node don't appear."""
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:          # the steps settle after at most the squared logarithm of a component's size
        # large star: every greater neighbour of u goes to the least node around u
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: u and its lesser neighbours go to the least of them
        large = cut(large, "edges")
        least = cut(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = cut(small.select("e.a", "e.b").where("a <> b").distinct(), "edges")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
