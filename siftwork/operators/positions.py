"""Tables joined by position, and where their positions disagree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwork.operators.skew import salted_join
from siftwork.operators.tokens import token_offsets


def with_position(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Adds the place of every row in the order of ``order``, from 0 without gaps. No task sees more than one range of it."""
    placed = token_offsets(df.withColumn("_one", F.lit(1)), order, "_one")
    return placed.withColumnRenamed("offset", name).drop("_one")


def zip_by_position(left: DataFrame, right: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``(position, left_key, right_key, left_status, right_status)`` of every position that one of the tables has.

    A row is ``equal`` if the other table has its key at its position, else ``moved`` if it has the key at another one, else
    ``missing``; the status is null where a table has no row. Keys may repeat; a frequent key is salted.
    """
    sides = [with_position(df.select(*dict.fromkeys([key, *order])), order).select("position", F.col(key).alias("key")) for df in (left, right)]
    both = sides[0].withColumnRenamed("key", "left_key").join(sides[1].withColumnRenamed("key", "right_key"), "position", "full")
    both = both.withColumn("_equal", F.coalesce(F.col("left_key") == F.col("right_key"), F.lit(False)))
    for own, other in (("left", "right"), ("right", "left")):
        present = both.where(f"{other}_key IS NOT NULL").select(F.col(f"{other}_key").alias(f"{own}_key")).distinct().withColumn("_there", F.lit(True))
        met = salted_join(both, present, [f"{own}_key"], F.col("position"), "left")
        status = F.when(F.col("_equal"), "equal").when(F.col("_there"), "moved").otherwise("missing")
        there = F.col(f"{own}_key").isNotNull()
        both = met.withColumn(f"{own}_status", F.when(there, status)).drop("_there")
    return both.select("position", "left_key", "right_key", "left_status", "right_status")
