"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwork.operators.skew import salted_join
from siftwork.session import materialize


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(src, dst))").alias("x")
    ).first()
    return row["n"], row["x"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Attach every larger neighbour of a node to the smallest node of its neighbourhood."""
    both = edges.union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    smallest = both.groupBy("src").agg(F.min("dst").alias("_min"), F.count(F.lit(1)).alias("n"))
    smallest = smallest.withColumn("_min", F.least("_min", "src"))
    met = salted_join(
        both.where("dst > src"), smallest.select("src", "_min"), ["src"], F.col("dst"), counts=smallest
    )
    return met.select(F.col("dst").alias("src"), F.col("_min").alias("dst")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Attach a node and its smaller neighbours to the smallest of them (edges point to the smaller node)."""
    smallest = edges.groupBy("src").agg(F.min("dst").alias("_min"), F.count(F.lit(1)).alias("n"))
    met = salted_join(edges, smallest.select("src", "_min"), ["src"], F.col("dst"), counts=smallest)
    moved = met.where("dst <> _min").select(F.col("dst").alias("src"), F.col("_min").alias("dst"))
    kept = smallest.select("src", F.col("_min").alias("dst"))
    return moved.union(kept).distinct()


def components(edges: DataFrame, left: str, right: str, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for every node of an edge, the component being its smallest node.

    Alternating large-star and small-star rounds; each round only aggregates and joins on node ids, with hot
    nodes salted, and its result is written to the checkpoint folder. The number of rounds grows with the logarithm
    of the longest chain. The loop ends when a round changes nothing.
    """
    current = materialize(
        edges.where(F.col(left) != F.col(right))
        .select(F.greatest(left, right).alias("src"), F.least(left, right).alias("dst"))
        .distinct()
    )
    state = _state(current)
    for _ in range(max_rounds if state[0] else 0):
        following = materialize(_small_star(_large_star(current)))
        following_state = _state(following)
        current, done = following, following_state == state
        state = following_state
        if done:
            break
    else:
        if state[0]:
            raise RuntimeError("components did not converge")
    roots = current.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    return current.select(F.col("src").alias("node"), F.col("dst").alias("component")).union(roots)
