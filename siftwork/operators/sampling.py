"""Seeded samples, class balancing, splits and chunked file manifests.

Every sample is the first k rows by a hash of the seed and the row id: one pass, each task keeps at most k rows,
and the result does not depend on partitioning.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwork.functions.hashing import SEED, order_key
from siftwork.session import materialize


def seeded_sample(df: DataFrame, key: str, k: int, seed: int = SEED, rank: str = "rank") -> DataFrame:
    """Uniform sample of ``k`` rows, numbered from 1 in sampled order."""
    chosen = df.withColumn("_order", order_key(key, seed=seed)).orderBy("_order", key).limit(k)
    # at most k rows are left, so one window partition is bounded by k
    return chosen.withColumn(rank, F.row_number().over(Window.orderBy("_order", key))).drop("_order")


def first_matching(df: DataFrame, key: str, condition: Column, n: int) -> DataFrame:
    """The first ``n`` rows in key order that satisfy a condition."""
    return df.where(condition).orderBy(key).limit(n)


def pool_sample(
    df: DataFrame, key: str, pool: int, k: int, usable: Column, seed: int = 42, rank: str = "rank"
) -> DataFrame:
    """First ``pool`` rows by key, of which the usable ones are sampled."""
    return seeded_sample(df.orderBy(key).limit(pool).where(usable), key, k, seed, rank)


def require_rows(df: DataFrame, n: int, message: str) -> DataFrame:
    """A bounded sample, stored; fails when it is smaller than asked for."""
    stored = materialize(df)
    if stored.count() < n:
        raise RuntimeError(message)
    return stored


def balance_classes(
    df: DataFrame, key: str, label: str, classes: tuple[str, ...], cap: int = 3000, seed: int = SEED
) -> DataFrame:
    """The same number of rows of each class: ``min(cap, size of the smallest class)``.

    Each class is cut to ``cap`` rows by a distributed top-k first; what is ranked afterwards is at most
    ``cap * len(classes)`` rows, however large or skewed the classes are. ``df`` should be narrow: it is stored, so that
    what it takes to find its rows is done once and not once per class.
    """
    ordered = materialize(df).withColumn("_order", order_key(key, seed=seed))
    tops = [ordered.where(F.col(label) == c).orderBy("_order", key).limit(cap) for c in classes]
    top = reduce(DataFrame.unionByName, tops)
    per_class = Window.partitionBy(label)
    ranked = top.withColumns(
        {
            "_rank": F.row_number().over(per_class.orderBy("_order", key)),
            "_size": F.count(F.lit(1)).over(per_class),
        }
    )
    everything = Window.partitionBy(F.lit(1))  # bounded by cap * classes rows
    counts = [F.count_if(F.col(label) == c).over(everything) for c in classes]
    smallest = F.least(*counts) if len(counts) > 1 else counts[0]
    return ranked.withColumn("_n", smallest).where(F.col("_rank") <= F.col("_n")).drop("_rank", "_size", "_n", "_order")


def split_examples(
    df: DataFrame, key: str, train_share: float = 0.9, seed: int = SEED, split: str = "split"
) -> DataFrame:
    """Shuffle a balanced (hence bounded) set and mark the first ``floor(share * N)`` rows as training rows."""
    shuffled = df.withColumn("_order", order_key(F.lit("split"), F.col(key), seed=seed))
    everything = Window.partitionBy(F.lit(1))
    ranked = shuffled.withColumns(
        {
            "_rank": F.row_number().over(everything.orderBy("_order", key)),
            "_size": F.count(F.lit(1)).over(everything),
        }
    )
    in_train = F.col("_rank") <= F.floor(F.lit(train_share) * F.col("_size"))
    return ranked.withColumn(split, F.when(in_train, "train").otherwise("valid")).drop("_order", "_rank", "_size")


def manifest_chunks(
    df: DataFrame, path: str, n_files: int, group_size: int = 4, seed: int = SEED
) -> DataFrame:
    """Sample ``n_files`` paths and put consecutive ones into chunks of ``group_size``."""
    if n_files % group_size:
        raise ValueError("n_files must be a multiple of group_size")
    sampled = seeded_sample(df.select(path), path, n_files, seed)
    return (
        sampled.withColumn("chunk", F.floor((F.col("rank") - 1) / group_size).cast("int"))
        .groupBy("chunk")
        .agg(F.sort_array(F.collect_list(F.struct("rank", path))).alias("_files"))
        .select("chunk", F.col(f"_files.{path}").alias("files"))
    )
