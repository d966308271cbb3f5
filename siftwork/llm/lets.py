"""Small helpers for array expressions that are evaluated in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once; inside a lambda, any other expression is computed at each use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def total(values: Column, kind: str = "long") -> Column:
    return F.aggregate(values, F.lit(0).cast(kind), lambda s, v: s + v)


def running(values: Column, block: int = 128) -> Column:
    """Sums of all earlier values, one for each value, of an integer array.

    A fold that appends to an array copies it at each step; so the fold runs inside blocks, and once over block sums.
    """

    def appended(items: Column, start: Column) -> Column:
        return F.aggregate(items, F.array(start), lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))

    def by_block(sums: Column) -> Column:
        return let(
            appended(sums, F.lit(0).cast("long")),
            lambda starts: F.flatten(
                F.transform(
                    F.sequence(F.lit(0), F.size(sums) - 1),
                    lambda b: let(
                        F.slice(values, b * block + 1, F.lit(block)),
                        lambda part: F.slice(appended(part, F.get(starts, b)), F.lit(1), F.size(part)),
                    ),
                )
            ),
        )

    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.size(values) / block).cast("int") - 1, F.lit(0))),
        lambda b: total(F.slice(values, b * block + 1, F.lit(block))),
    )
    return F.when(F.size(values) == 0, F.array().cast("array<bigint>")).otherwise(let(blocks, by_block))
