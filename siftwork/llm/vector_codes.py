"""Short codes of vectors by a product quantiser that is trained with ball k-means.

Components become integers (``floor(1024 x)``) and a vector is cut into equal consecutive parts. Each part position has a
codebook; rounds assign every part to the nearest entry and move entries to the floored mean of their parts. All arithmetic
is on integers, so the result does not depend on how rows are spread.

From the second round on, the assignment is found by balls instead of by a search of the whole codebook. The ball of an entry
holds the parts of the round before; its radius bounds their distances. With ``d`` the distance of a part to its entry ``c``:

* entries farther from ``c`` than twice the radius of its ball can win none of its parts; the others are its neighbours;
* a part with ``2 d`` less than the distance to the nearest neighbour lies in the stable core and keeps its entry;
* the neighbours that can win or tie are those not farther from ``c`` than ``2 d``. They are a prefix of the neighbours in
  order of distance, so parts are dealt into rings by the length of that prefix, and each ring meets its prefix only.

No bound is rounded the wrong way, so codes equal those of the full search. A task needs the codebooks and a block of rows;
only sums per entry (``parts x entries`` rows) reach the driver. Each round reads a table and writes the next one.

Defined results: a null vector, or one with a null or non-finite component, has no row; so has an empty vector and one of
another length than the first kept vector by key. A length that the parts do not divide is filled up with zeros. Integers beyond
``±LIMIT`` are taken for ``±LIMIT``, which keeps all sums in 64 bits. Repeated rows are coded each; rows with a null key come
last. Fewer rows than entries make smaller codebooks, no rows make an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.llm.tables import keyed_join, saved

#: Largest integer of a component.
LIMIT = 1 << 24
#: Rows that are worked on at a time.
BLOCK_ROWS = 1 << 14


@dataclass(frozen=True)
class CodeRule:
    parts: int = 4
    entries: int = 256
    scale: int = 1024
    rounds: int = 4


@dataclass(frozen=True)
class Balls:
    """Codebooks ``(parts, entries, width)``, and squares of the radii of their balls (None before the first round)."""

    books: np.ndarray
    radii: np.ndarray | None = None


@dataclass(frozen=True)
class Coded:
    """``rows``: key, label, ``codes`` and ``errors`` (squared distances) per part, stored; ``books``: the last codebooks."""

    rows: DataFrame
    books: np.ndarray

    def digest(self) -> str:
        numbers = ",".join(str(x) for x in self.books.ravel().tolist())
        return hashlib.sha256(numbers.encode()).hexdigest()


def squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all rows of ``y``."""
    most = float(max(np.abs(x).max(initial=0), np.abs(y).max(initial=0)))
    if 4 * x.shape[1] * most * most < 2**53:  # every sum is an integer that a double holds
        x, y = x.astype(np.float64), y.astype(np.float64)
    found = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)
    return found.astype(np.int64)


class Searcher:
    """Nearest entries of parts for one part position."""

    def __init__(self, book: np.ndarray, radii: np.ndarray | None):
        self.book, self.known = book, radii is not None
        if self.known:
            gaps = squares(book, book)
            np.fill_diagonal(gaps, np.iinfo(np.int64).max)
            order = np.argsort(gaps, axis=1, kind="stable")
            gaps = np.take_along_axis(gaps, order, axis=1)[:, :-1]
            counts = (gaps <= 4 * radii[:, None]).sum(axis=1)
            self.near = [order[i, :n] for i, n in enumerate(counts)]
            self.gaps = [gaps[i, :n] for i, n in enumerate(counts)]

    def __call__(self, rows: np.ndarray, own: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of each row; ``own`` has the entries of the round before."""
        if not self.known:
            found = squares(rows, self.book)
            code = found.argmin(axis=1)
            return code, found[np.arange(len(rows)), code]
        gone = rows - self.book[own]
        far = (gone * gone).sum(axis=1)
        code, best = own.copy(), far.copy()
        order = np.argsort(own, kind="stable")
        ends = np.searchsorted(own[order], np.arange(len(self.book) + 1))
        for entry in np.flatnonzero(np.diff(ends)):
            members = order[ends[entry]:ends[entry + 1]]
            reach = np.searchsorted(self.gaps[entry], 4 * far[members], "right")
            self._rings(rows, entry, members, reach, code, best)
        return code, best

    def _rings(self, rows, entry, members, reach, code, best) -> None:
        """Members outside the stable core against the neighbours within reach, in rings whose reach doubles."""
        inner, outer = 0, 1
        while (reach > inner).any():
            ring = members[(reach > inner) & (reach <= outer)]
            if len(ring):
                near = self.near[entry][:outer]
                found = squares(rows[ring], self.book[near])
                least = found.min(axis=1)
                first = np.where(found == least[:, None], near, len(self.book)).min(axis=1)
                better = (least < best[ring]) | ((least == best[ring]) & (first < code[ring]))
                code[ring[better]], best[ring[better]] = first[better], least[better]
            inner, outer = outer, 2 * outer


def _matrix(batch: pa.RecordBatch, name: str, width: int, kind=np.int64) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width).astype(kind)


def _blocks(batches):
    """Batches joined to blocks of ``BLOCK_ROWS`` rows, so that numpy works on long arrays."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= BLOCK_ROWS:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if n:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _lists(values: np.ndarray, kind) -> pa.Array:
    starts = np.arange(0, values.size + 1, values.shape[1])
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values.ravel(), kind))


def integers(vector: Column, scale: int) -> Column:
    """Components as integers, or null if the vector or one of its components is null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform(
        vector, lambda x: F.floor(F.greatest(F.lit(-float(LIMIT)), F.least(F.lit(float(LIMIT)), x * scale))).cast("int")
    )
    return F.when(finite, whole)


def _assigned(rows: DataFrame, balls: Balls) -> DataFrame:
    """``rows`` (``id``, ``label``, ``whole`` and maybe ``codes``) with the codes and errors of these codebooks, stored."""
    parts, _, width = balls.books.shape
    schema = rows.select("id", "label", "whole", F.lit(None).cast("array<int>").alias("codes"), F.lit(None).cast("array<bigint>").alias("errors")).schema

    def run(batches):
        search = [Searcher(balls.books[p], None if balls.radii is None else balls.radii[p]) for p in range(parts)]
        for block in _blocks(batches):
            whole = _matrix(block, "whole", parts * width)
            own = _matrix(block, "codes", parts) if balls.radii is not None else None
            found = [
                search[p](whole[:, p * width:(p + 1) * width], None if own is None else own[:, p]) for p in range(parts)
            ]
            codes, errors = np.column_stack([c for c, _ in found]), np.column_stack([e for _, e in found])
            columns = [block.column(c) for c in ("id", "label", "whole")]
            yield pa.RecordBatch.from_arrays([*columns, _lists(codes, pa.int32()), _lists(errors, pa.int64())], names=schema.names)

    return saved(rows.mapInArrow(run, schema), "vector-codes")


def _sums(rows: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """``(part, entry, n, far, total)`` of the entries in use: sums over their parts, added up in each task first."""
    parts, entries, width = shape

    def run(batches):
        total = np.zeros((parts * entries, width), np.int64)
        n, far = np.zeros(parts * entries, np.int64), np.zeros(parts * entries, np.int64)
        for block in _blocks(batches):
            whole = _matrix(block, "whole", parts * width).reshape(-1, width)
            at = (_matrix(block, "codes", parts) + np.arange(parts) * entries).ravel()
            np.add.at(total, at, whole)
            np.maximum.at(far, at, _matrix(block, "errors", parts).ravel())
            n += np.bincount(at, minlength=len(n))
        used = np.flatnonzero(n)
        if len(used):
            columns = [pa.array(used // entries), pa.array(used % entries), pa.array(n[used]), pa.array(far[used]), _lists(total[used], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "n", "far", "total"])

    found = rows.select("whole", "codes", "errors").mapInArrow(run, "part bigint, entry bigint, n bigint, far bigint, total array<bigint>")
    return found.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.max("far").alias("far"), F.array(*[F.sum(F.get("total", F.lit(i))) for i in range(width)]).alias("total")
    )


def _moved(rows: DataFrame, books: np.ndarray) -> Balls:
    """Codebooks after a round, and a bound of the squared distances of the parts to their moved entries."""
    new, far = books.copy(), np.zeros(books.shape[:2])
    for r in _sums(rows, books.shape).collect():  # at most parts x entries rows
        new[r["part"], r["entry"]] = np.array(r["total"], np.int64) // r["n"]
        far[r["part"], r["entry"]] = r["far"]
    step = ((new - books) ** 2).sum(axis=2)
    radius = (np.sqrt(far) + np.sqrt(step)) * (1 + 1e-9) + 1e-6
    return Balls(new, np.ceil(radius * radius).astype(np.int64))


def coded(vectors: DataFrame, rule: CodeRule = CodeRule(), key: str = "vec_id", vector: str = "embedding", label: str = "label") -> Coded:
    """Codes of all vectors. The codebooks start as the parts of the first vectors in order of ``key``."""
    cast = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), integers(cast, rule.scale).alias("whole"))
    rows = saved(rows.where("size(whole) > 0"), "vectors")
    order = [F.col("id").asc_nulls_last(), F.col("whole")]
    first = rows.orderBy(*order).limit(1).select(F.size("whole")).first()
    length = first[0] if first else rule.parts
    filled = -(-length // rule.parts) * rule.parts
    rows = rows.where(F.size("whole") == length)
    if filled > length:
        rows = rows.withColumn("whole", F.concat("whole", F.array_repeat(F.lit(0), filled - length)))
    start = [r["whole"] for r in rows.orderBy(*order).limit(rule.entries).select("whole").collect()]
    books = np.array(start, np.int64).reshape(len(start), rule.parts, filled // rule.parts).transpose(1, 0, 2)
    balls = Balls(books)
    if not start:
        empty = rows.withColumns({"codes": F.lit(None).cast("array<int>"), "errors": F.lit(None).cast("array<bigint>")})
        return Coded(empty.drop("whole"), books)
    for _ in range(rule.rounds):
        rows = _assigned(rows, balls)
        balls = _moved(rows, balls.books)
    return Coded(_assigned(rows, balls).drop("whole"), balls.books)


def report(vectors: DataFrame, rule: CodeRule = CodeRule(), key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``(key, code, error, label_error, codebooks_sha256)``: hex digits of the codes, the error and its sum over equal labels."""
    found = coded(vectors, rule, key, vector, label)
    digits = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    error = F.aggregate("errors", F.lit(0).cast("long"), lambda s, e: s + e)
    name = F.when(F.col("label").isNull(), "").otherwise(F.concat(F.lit("="), F.col("label").cast("string")))
    rows = found.rows.select(F.col("id").alias(key), digits.alias("code"), error.alias("error"), name.alias("_name"))
    sums = saved(rows.groupBy("_name").agg(F.sum("error").alias("label_error")), "label-errors")
    joined = keyed_join(rows, sums, ["_name"], F.col("code"))
    return joined.select(key, "code", "error", "label_error", F.lit(found.digest()).alias("codebooks_sha256"))
