"""Deterministic hashes: sampling order, line fingerprints, gram hashes and the MinHash family."""

from __future__ import annotations

import random

from pyspark.sql import Column
from pyspark.sql import functions as F

SEED = 336
#: Modulus of the MinHash family, a Mersenne prime.
PRIME = (1 << 31) - 1


def order_key(*parts: Column | str, seed: int = SEED) -> Column:
    """Pseudo-random sort key that depends only on the seed and the row, never on partitioning."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in columns]))


def fingerprint(value: Column) -> list[Column]:
    """128 bits as two longs: fixed-width grouping keys are cheaper to shuffle and compare than text."""
    return [F.xxhash64(value), F.xxhash64(F.lit("second half"), value)]


def gram_id(gram: Column) -> Column:
    """60-bit id of a gram from its md5, which any SQL engine can reproduce."""
    return F.conv(F.substring(F.md5(gram), 1, 15), 16, 10).cast("long")


def base_hash(gram: Column) -> Column:
    """The leading 32 bits of a gram id, input of the MinHash family."""
    return F.shiftright(gram, 28)


def minhash_family(num_hashes: int, seed: int = SEED) -> list[tuple[int, int]]:
    """Coefficients ``(a, b)`` of ``(a * h + b) mod PRIME``; the products stay inside a signed long."""
    rng = random.Random(seed)
    return [(rng.randrange(1, PRIME), rng.randrange(0, PRIME)) for _ in range(num_hashes)]
