"""Equi-joins that stay balanced when a few keys hold much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one key a single task should meet at most.
ROWS_PER_SALT = 100_000
#: Hot keys that are salted. By counting, every other key holds at most 1/HOT_KEYS of all rows.
HOT_KEYS = 1_000_000
#: Rows of a stored table that may be sent to every executor.
BROADCAST_ROWS = 1_000_000


def hot_keys(counts: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Keys with more than ``ROWS_PER_SALT`` rows, at most ``HOT_KEYS`` of them, with their number of salts.

    ``counts`` holds one row per key. The result is bounded by ``HOT_KEYS`` rows, so it may be broadcast.
    """
    return (
        counts.where(F.col(count) > ROWS_PER_SALT)
        .orderBy(F.desc(count), *keys)
        .limit(HOT_KEYS)
        .select(*keys, F.ceil(F.col(count) / ROWS_PER_SALT).cast("int").alias("_salts"))
    )


def salted_join(
    large: DataFrame,
    small: DataFrame,
    keys: list[str],
    salt_on: Column,
    how: str = "inner",
    counts: DataFrame | None = None,
    hint: str | None = None,
) -> DataFrame:
    """Join ``large`` with ``small`` on ``keys``; rows of a hot key are spread over several tasks.

    Hot keys are found by counting ``large`` (or taken from ``counts``: keys and ``n``). A row of ``large`` draws
    its salt from ``salt_on``; the rows of ``small`` with a hot key are repeated once per salt. Nothing is dropped,
    and keys that are not hot have the single salt 0. ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``;
    ``hint`` a join hint for ``small``.
    """
    if counts is None:
        counts = large.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    hot = F.broadcast(hot_keys(counts, keys, "n"))
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    spread = (
        large.join(hot, keys, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(salt_on), salts).cast("int"))
        .drop("_salts")
    )
    repeated = (
        small.join(hot, keys, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("_salts")
    )
    return spread.join(repeated.hint(hint) if hint else repeated, [*keys, "_salt"], how).drop("_salt")


def lookup_join(
    rows: DataFrame, table: DataFrame, keys: list[str], salt_on: Column, how: str = "inner", counts: DataFrame | None = None
) -> DataFrame:
    """Join ``rows`` with a stored ``table`` of unique keys: by broadcast if the table is small, else salted by key.

    ``counts`` (keys and ``n``) as in :func:`salted_join`; without it ``rows`` are computed twice.
    """
    if table.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table), keys, how)
    return salted_join(rows, table, keys, salt_on, how, counts)
