"""Classes from links: connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwork.llm.tables import saved, small_side


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node of a link, the component being its smallest node.

    In each round every node moves to the smallest of its neighbours, and on to where that one moves; then links are
    renamed, and those inside one node vanish. Links at least halve in the usual case, and rounds grow with the logarithm of
    the longest chain. Aggregations are partial and moves are joined by node, so a node with many links is not a hot key.
    """
    ends = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("x"), F.least(a, b).alias("y"))
    edges = saved(ends.distinct(), "edges")
    found = edges.select(F.col("x").alias("node"), F.col("x").alias("component")).where("false")
    first = True
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        moves = saved(both.groupBy("x").agg(F.min("y").alias("_y")).select("x", F.least("x", "_y").alias("up")), "moves")
        onward = small_side(moves).select(F.col("x").alias("up"), F.col("up").alias("_top"))
        moves = saved(moves.join(onward, "up", "left").select("x", F.coalesce("_top", "up").alias("up")), "moves")
        side = small_side(moves)
        if first:
            found, first = moves.select(F.col("x").alias("node"), F.col("up").alias("component")), False
        else:
            step = side.select(F.col("x").alias("component"), "up")
            found = saved(
                found.join(step, "component", "left").select("node", F.coalesce("up", "component").alias("component")), "found"
            )
        renamed = edges.join(side, "x").select("y", F.col("up").alias("x"))
        renamed = renamed.join(side.select(F.col("x").alias("y"), "up"), "y").where(F.col("x") != F.col("up"))
        edges = saved(renamed.select(F.greatest("x", "up").alias("x"), F.least("x", "up").alias("y")).distinct(), "edges")
    return found
