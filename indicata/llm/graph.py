"""Connected components of an undirected graph, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata.sinks.files import materialize


def _with_least(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` with the least of u and its neighbours.  Least values are combined before the shuffle and written
    first, so that the join reads plain shuffles on both sides, which are split where one node has very many edges."""
    least = materialize(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return edges.join(least, "u")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: for each node of an edge, the least node that it is connected with.

    Self-loops and repeated edges are fine; null ends are dropped.  Each round is written to the shared folder, so a
    lost executor costs one round, and rounds grow with the logarithm of the longest path.  No edges: no rows.
    """
    u, v = F.col(a), F.col(b)
    now = materialize(edges.where(u.isNotNull() & v.isNotNull() & (u != v)).select(
        F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "stars")
    before = None
    while True:
        # large star: neighbours above a node move on to the least one around it
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: neighbours below a node, and the node, move on to the least one
        small = _with_least(large.where(F.col("u") > F.col("v")).distinct())
        moved = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            small.select("u", F.col("m").alias("v")))
        now = materialize(moved.where(F.col("u") > F.col("v")).distinct(), "stars")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    ends = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
