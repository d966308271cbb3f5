"""The rounds of :mod:`softmax` over arrays: for words, and as many documents as a task may know the residuals of.

Features are dealt to parts by their hash. A part holds its features in pieces of bounded size: the features, and for each the documents that
have it and how often. So a round is one pass over the pieces: a task gets the residuals of all documents, moves the weights of its
features, and gives the sums of the new weights per document. Weights stay in the part's bucket, and sums per document are all that travels.
Values are those of the rounds over rows, bit for bit: sums are of whole numbers, and other arithmetic is the same.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftwork.operators import classifiers as C
from siftwork.session import materialize, materialize_by

#: Bytes of text by which parts are numbered (as far as there are cores), and those of which a task gathers the features at a time.
PART_BYTES, GATHER_BYTES = 32 << 20, 8 << 20
#: Entries of a piece, if no feature has more.
PIECE = 1 << 20
#: Documents whose sums are a row.
BLOCK = 1 << 16


def _keys(df: DataFrame, n: int) -> np.ndarray:
    """A number for each of ``n`` partitions by which rows are dealt to it."""
    ids = df.sparkSession.range(40 * n + 100).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("p")).agg(F.min("id").alias("id"))
    found = dict(map(tuple, ids.collect()))
    return np.array([found[p] for p in range(n)])


def _blob(values: np.ndarray, kind: str) -> pa.Array:
    return pa.array([np.ascontiguousarray(values, kind).tobytes()], pa.binary())


def _values(batch: pa.RecordBatch, name: str, row: int, kind: str) -> np.ndarray:
    return np.frombuffer(batch.column(name)[row].as_buffer(), kind)


def _dealt(texts: DataFrame, fine: int, stretch: int) -> DataFrame:
    """``(fine, feature, u, c)``: occurrences of features by document, as arrays, for the ranges of hashes that tasks gather."""
    keys = _keys(texts, fine)

    def run(batches):
        for batch in C._gathered(batches, stretch):
            for part in C._stretches(batch, stretch):
                owner, found = C._features(part)
                u = part.column("_u").to_numpy()[owner]
                order = np.lexsort((u, found))
                u, found = u[order], found[order]
                first = np.flatnonzero(np.concatenate([[True], (u[1:] != u[:-1]) | (found[1:] != found[:-1])]))
                times, u, found = np.diff(np.append(first, len(u))), u[first], found[first]
                of = ((found >> np.uint64(32)) * np.uint64(fine)) >> np.uint64(32)  # ascending, as hashes are
                edges = np.searchsorted(of, np.arange(fine + 1, dtype=np.uint64))
                for i in np.flatnonzero(np.diff(edges)):
                    at = slice(edges[i], edges[i + 1])
                    blobs = _blob(found[at], "<u8"), _blob(u[at], "<i4"), _blob(times[at], "<i4")
                    yield pa.RecordBatch.from_arrays([pa.array([keys[i]]), pa.array([i], pa.int32()), *blobs], names=["key", "fine", "feature", "u", "c"])

    return texts.mapInArrow(run, "key bigint, fine int, feature binary, u binary, c binary").repartition(fine, "key")


def _pieces(dealt: DataFrame, n: int, min_count: int) -> DataFrame:
    """``(part, lead, feature, total, first, u, c)``, stored: the features of a piece, what they occur, and where each one's documents begin."""
    keys, piece = _keys(dealt, n), PIECE

    def run(batches):
        waiting: dict[int, list] = {}
        for batch in batches:
            for i, fine in enumerate(batch.column("fine").to_pylist()):
                waiting.setdefault(fine, []).append((_values(batch, "feature", i, "<u8"), _values(batch, "u", i, "<i4"), _values(batch, "c", i, "<i4")))
        for fine in sorted(waiting):
            f, u, c = (np.concatenate(v) for v in zip(*waiting.pop(fine)))
            order = np.lexsort((u, f))
            f, u, c = f[order], u[order], c[order].astype(np.int64)
            new = np.concatenate([[True], f[1:] != f[:-1]])
            feature = np.flatnonzero(new)
            total = np.add.reduceat(c, feature)
            kept = (total >= min_count) | (f[feature] == C._bias_id()[0])
            entry = np.flatnonzero(new | np.concatenate([[True], u[1:] != u[:-1]]))  # a document may have come in several rows
            which, times, u = (np.cumsum(new) - 1)[entry], np.add.reduceat(c, entry), u[entry]
            known = kept[which] & (u >= 0)
            which, times, u = which[known], times[known], u[known]
            first = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]])) if len(which) else np.zeros(0, np.int64)
            ends = np.append(first, len(which))
            total, names = total[which[first]], f[feature][which[first]]
            a = 0
            while a < len(first):
                b = max(a + 1, int(np.searchsorted(ends, ends[a] + piece, "right")) - 1)
                at = slice(ends[a], ends[b])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([keys[fine % n]]), pa.array(names[a : a + 1].view(np.int64)), _blob(names[a:b], "<u8"), _blob(total[a:b], "<i8"),
                        _blob(first[a:b] - ends[a], "<i4"), _blob(u[at], "<i4"), _blob(times[at], "<i4"),
                    ],
                    names=["part", "lead", "feature", "total", "first", "u", "c"],
                )
                a = b

    schema = "part bigint, lead bigint, feature binary, total binary, first binary, u binary, c binary"
    return materialize_by(dealt.mapInArrow(run, schema), "part", n, dealt=True)


def _added(u: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of whole numbers by document."""
    if not len(values) or float(np.abs(values).max()) * len(values) < 2**53:  # floating point has them exactly
        return np.bincount(u, values, n).astype(np.int64)
    out = np.zeros(n, np.int64)
    np.add.at(out, u, values)
    return out


def _blocks(sums: np.ndarray):
    """``(block, values)`` of sums, a row of them for each value of a document."""
    for block, first in enumerate(range(0, sums.shape[1], BLOCK)):
        yield block, sums[:, first : first + BLOCK]


def _by_document(rows: DataFrame, names: list[str], n: int) -> DataFrame:
    """``(u, *names)`` from the blocks of all tasks."""
    k, size = len(names), BLOCK

    def run(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, block in enumerate(batch.column("block").to_pylist()):
                values = _values(batch, "sums", i, "<i8").reshape(k, -1)
                found[block] = found[block] + values if block in found else values
        for block, values in found.items():
            u = pa.array(np.arange(block * size, block * size + values.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays([u, *map(pa.array, values)], names=["u", *names])

    tasks = max(1, min(n, rows.sparkSession.sparkContext.defaultParallelism))
    dealt = rows.select("block", "sums").where("block IS NOT NULL").repartition(tasks, "block")
    return dealt.mapInArrow(run, ", ".join(["u int", *[f"{c} bigint" for c in names]]))


def _sizes(pieces: DataFrame, n: int) -> DataFrame:
    def run(batches):
        sums = np.zeros(n, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                sums += _added(_values(batch, "u", i, "<i4"), _values(batch, "c", i, "<i4"), n)
        for block, values in _blocks(sums[None]):
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), _blob(values, "<i8")], names=["block", "sums"])

    return _by_document(pieces.select("u", "c").mapInArrow(run, "block int, sums binary"), ["n"], n // BLOCK + 1)


def _round(share: np.ndarray, residuals: np.ndarray, l2: float, weight: int, residual: int):
    """Moves the weights of pieces against the residuals of all documents, and gives the sums of the new ones."""
    k, n = residuals.shape

    def run(batches):
        sums, part = np.zeros((k, n), np.int64), None
        for batch in batches:
            for i in range(batch.num_rows):
                first, u = _values(batch, "first", i, "<i4"), _values(batch, "u", i, "<i4")
                c = _values(batch, "c", i, "<i4").astype(np.int64)
                old = batch.column("w")[i]
                w = np.frombuffer(old.as_buffer(), "<i8").reshape(k, -1) if old.is_valid else np.zeros((k, len(first)), np.int64)
                curvature = np.add.reduceat(c * share[u], first) / (2.0 * residual) + l2
                moved, times = np.empty_like(w), np.diff(np.append(first, len(u)))
                for j in range(k):
                    slope = np.add.reduceat(c * residuals[j][u], first) / residual + w[j] * (l2 / weight)
                    moved[j] = w[j] - np.floor(slope / curvature * weight + 0.5).astype(np.int64)
                    sums[j] += _added(u, c * np.repeat(moved[j], times), n)
                part = batch.column("part")[i].as_py()
                none = pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([part]), batch.column("lead").slice(i, 1), _blob(moved, "<i8"), *none], names=["part", "lead", "w", "block", "sums"])
        for block, values in _blocks(sums) if part is not None else ():
            row = [pa.array([part]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([block], pa.int32()), _blob(values, "<i8")]
            yield pa.RecordBatch.from_arrays(row, names=["part", "lead", "w", "block", "sums"])

    return run


def _rows(names: list[str]):
    """The features of pieces as rows."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                feature, total = _values(batch, "feature", i, "<i8"), _values(batch, "total", i, "<i8")
                old = batch.column("w")[i]
                w = np.frombuffer(old.as_buffer(), "<i8").reshape(len(names), -1) if old.is_valid else np.zeros((len(names), len(feature)), np.int64)
                yield pa.RecordBatch.from_arrays([*map(pa.array, (feature, total, *w))], names=["feature", "total", *names])

    return run


def _numbered(table: DataFrame) -> DataFrame:
    """A stored table with its rows numbered from 0 as ``u``, stored: by place in a task, after the rows of the tasks before."""
    placed = materialize(table.withColumn("_place", F.monotonically_increasing_id()))
    task = F.shiftright("_place", 33).cast("int")
    sizes = sorted(map(tuple, placed.groupBy(task).agg(F.count(F.lit(1))).collect()))
    before = np.cumsum([0, *[c for _, c in sizes]]).tolist()
    offsets = table.sparkSession.createDataFrame([(t, o) for (t, _), o in zip(sizes, before)], "_task int, _before bigint")
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    met = placed.withColumn("_task", task).join(F.broadcast(offsets), "_task")
    return materialize(met.withColumn("u", (F.col("_before") + within).cast("int")).drop("_task", "_before", "_place"))


def train(
    labelled: DataFrame, units: DataFrame, key: str, names: list[str], rule, residuals: Callable[[], list[Column]], weight: int, residual: int
) -> DataFrame:
    """``(feature, total, *names)``, stored: the weights after all rounds.

    ``labelled`` is stored, ``units`` are its distinct ``(key, _y)``, stored; rows of one are one document. ``residuals`` are of the columns ``z_0 …``, ``n`` and ``_y``.
    """
    session, count = units.sparkSession, units.count()
    units = _numbered(units)
    known_unit = F.broadcast(units)  # of documents that every task may know
    texts = labelled.join(known_unit, [key, "_y"], "left").select(F.coalesce("u", F.lit(-1)).alias("_u"), F.lower("text").alias("_text"))
    size = labelled.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, min(session.sparkContext.defaultParallelism, -(-size // PART_BYTES)))
    fine = n * max(1, -(-size // (n * GATHER_BYTES)))
    pieces = _pieces(_dealt(texts, fine, C.STRETCH), n, rule.min_count)
    known = materialize(units.join(_sizes(pieces, count), "u"))
    same_key = Window.partitionBy(key)
    repeated = known.select(key).distinct().count() < count

    def arrays(table: DataFrame, columns: list[Column]) -> np.ndarray:
        """Numbers by document; those of a key that has several labels are added up."""
        shown = [(F.sum(c).over(same_key) if repeated else c).alias(f"v{i}") for i, c in enumerate(columns)]
        found = table.select("u", *shown).toArrow()
        out = np.zeros((len(columns), count), np.int64)
        out[:, found["u"].to_numpy()] = [found[f"v{i}"].to_numpy() for i in range(len(columns))]
        return out

    n_words = arrays(known, [F.col("n")])[0]
    share = np.floor(residual / np.maximum(n_words, 1) + 0.5).astype(np.int64)
    state, z = None, [f"z_{i}" for i in range(len(names))]
    margins = known.select("*", *[F.lit(0).cast("long").alias(c) for c in z])
    for _ in range(rule.rounds):
        step = _round(share, arrays(margins, residuals()), rule.l2, weight, residual)
        read = _with_weights(pieces.select("part", "lead", "first", "u", "c"), state)
        stored = materialize_by(read.mapInArrow(step, "part bigint, lead bigint, w binary, block int, sums binary"), "part", n, dealt=True)
        state = stored.where("w IS NOT NULL").select("part", "lead", "w")
        sums = _by_document(stored, z, count // BLOCK + 1)
        margins = known.join(sums, "u", "left").select(*known.columns, *[F.coalesce(c, F.lit(0)).alias(c) for c in z])
    schema = ", ".join(f"{c} bigint" for c in ("feature", "total", *names))
    return materialize(_with_weights(pieces.select("part", "lead", "feature", "total"), state).mapInArrow(_rows(names), schema))


def _with_weights(pieces: DataFrame, state: DataFrame | None) -> DataFrame:
    if state is None:
        return pieces.withColumn("w", F.lit(None).cast("binary"))
    # rows are dealt by the part alone, and to meet by more keys would shuffle them; a part has few pieces
    same = F.col("lead").between(F.col("_lead"), F.col("_lead"))
    return pieces.join(state.withColumnRenamed("lead", "_lead").hint("shuffle_hash"), "part").where(same).drop("_lead")
