"""Removal of long repeated byte strings by a logarithmic family of suffix indexes.

A byte is removed if it is covered by a string of ``MATCH`` bytes that also starts anywhere else. Suffixes are sampled at
anchors: of each window of ``MATCH`` bytes, the place whose first ``GRAM`` bytes have the least hash. Equal windows choose
equal anchors, wherever they stand, so windows need to be compared only if their anchors begin alike, and a corpus has
about one anchor in 70 bytes.

* The anchors of a batch of documents, in order of their first bytes' hash, are the batch's suffix array. A new batch is
  scanned together with the levels of the index, which finds the anchors that begin alike; then it becomes a level, and
  levels of equal size merge (:class:`SuffixIndex`). Anchors in ``n`` batches are so rewritten ``log n`` times.
* What begins alike is told apart in three steps, each on what the last left open: all windows around an anchor at once
  (equal surroundings), blocks of ``BLOCK`` windows, single windows. A step only groups by hashes, with partial
  aggregation; of equal surroundings one anchor stands for all in the next step. So no group is expanded into pairs, and
  no group has to fit into a task.

Texts are needed four times, so they are stored in buckets by id first and shuffled only for that; whatever is asked about
them is shuffled to the buckets.

Decisions rest on 128 bits of hashes. Defined results: null texts are empty; matches never cross documents; a text of fewer
than ``MATCH`` bytes loses nothing; equal texts of at least ``MATCH`` bytes lose everything. Keys must be unique, except for
rows that are equal; rows with a null key are left out.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwork.llm.batches import BASE, list_array, mix, random_values, views, with_text_columns
from siftwork.llm.tables import saved, saved_by
from siftwork.llm.tables import small_side as bounded_side

MATCH, GRAM, BLOCK = 200, 40, 17
#: Batches a corpus is added in.
BATCHES = 3
#: Bytes of a side table that is broadcast; the driver holds several copies of one while it sends it.
SIDE_BYTES = 32 << 20
_PLACE = 31  # bits of a position in a view
_REACH = MATCH - GRAM  # the largest distance of a window's start to its anchor
_INT32 = "p int, lo int, hi int"


def small_side(df: DataFrame) -> DataFrame:
    return bounded_side(df, SIDE_BYTES)


class _Sums:
    """Hashes of any spans of a view by running sums; one per task."""

    def __init__(self, seed: int, base: int = BASE):
        self.values, self.base = random_values(256, seed), base
        self.up = self.down = np.ones(1, np.uint64)

    def load(self, data: np.ndarray) -> None:
        n = len(data) + 1
        if len(self.up) < n:
            size = max(n, (1 << 21) + 1)
            for name, base in (("up", self.base), ("down", pow(self.base, -1, 1 << 64))):
                powers = np.full(size, base, np.uint64)
                powers[0] = 1
                setattr(self, name, np.cumprod(powers, dtype=np.uint64))
        self.total = np.zeros(n, np.uint64)
        np.cumsum(self.values[data] * self.up[: n - 1], out=self.total[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.down[start])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[: len(values) - have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _cut(start, end, first, last, sums: _Sums) -> np.ndarray:
    """Hash of a span that is cut at the ends of its document; how much is cut counts as content."""
    left, right = np.maximum(start, first), np.minimum(end, last)
    cut = (left - start) * 4096 + (end - right)
    return mix(sums.of(left, right) + cut.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def anchors(docs: DataFrame) -> DataFrame:
    """``(id, p, lo, hi, key, ctx)`` from ``(id, _text)``: anchors, the starts of the windows they stand for, and hashes of
    their first bytes and of everything around them that these windows hold."""

    def make():
        sums = _Sums(9)

        def run(data, offsets):
            n, width = len(offsets) - 1, MATCH - GRAM + 1
            empty = np.zeros(0, np.int64)
            place, owner = empty, empty
            lo = hi = empty
            keys = around = np.zeros(0, np.uint64)
            if len(data) >= MATCH:
                sums.load(data)
                at = np.arange(len(data) - GRAM + 1, dtype=np.int64)
                hashes = sums.of(at, at + GRAM)
                packed = ((hashes >> np.uint64(_PLACE)) << np.uint64(_PLACE)) | at.view(np.uint64)
                chosen = (_least(packed, width) & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
                last = np.repeat(offsets[1:], np.diff(offsets))
                start = np.flatnonzero(at[: len(chosen)] + MATCH <= last[: len(chosen)])
                chosen = chosen[start]
                new = np.ones(len(start), bool)
                new[1:] = (chosen[1:] != chosen[:-1]) | (start[1:] != start[:-1] + 1)
                i = np.flatnonzero(new)
                if len(i):
                    place, lo, hi = chosen[i], start[i], start[np.append(i[1:], len(start)) - 1]
                    owner = np.searchsorted(offsets, place, "right") - 1
                    first, end = offsets[owner], offsets[owner + 1]
                    keys, around = hashes[place], _cut(place - _REACH, place + MATCH, first, end, sums)
                    place, lo, hi = place - first, lo - first, hi - first
            starts = np.searchsorted(owner, np.arange(n + 1))
            fields = [*(pa.array(a.astype(np.int32)) for a in (place, lo, hi)), _signed(keys), _signed(around)]
            rows = pa.StructArray.from_arrays(fields, names=["p", "lo", "hi", "key", "ctx"])
            return [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), rows)]

        return run

    found = with_text_columns(docs, "_text", make, f"_a array<struct<p: int, lo: int, hi: int, key: bigint, ctx: bigint>>")
    return found.select("id", F.inline("_a"))


class SuffixIndex:
    """Levels of ``(key, ctx, n)``: each first bytes' hash, whether its surroundings differ (``ctx`` null) and its number."""

    def __init__(self):
        self.levels: list[tuple[int, DataFrame]] = []

    @staticmethod
    def _merged(*parts: DataFrame) -> DataFrame:
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        differ = (F.min("ctx") != F.max("ctx")) | (F.count("ctx") < F.count(F.lit(1)))
        return rows.groupBy("key").agg(F.when(~differ, F.min("ctx")).alias("ctx"), F.sum("n").alias("n"), F.max("fresh").alias("fresh"))

    def add(self, batch: DataFrame, more: bool = True) -> DataFrame:
        """Scan the anchors of a batch (``key, ctx``) with all levels: ``(key, mixed)`` of its keys with several anchors.

        Unless this is the last batch, the batch becomes a level: merged with the levels of equal size, the new level has
        twice their size, and so on.
        """
        new = batch.select("key", "ctx", F.lit(1).cast("long").alias("n"), F.lit(1).alias("fresh"))
        old = [level.withColumn("fresh", F.lit(0)) for _, level in self.levels]
        size, merging = 0, []
        while self.levels and more and self.levels[-1][0] == size:
            size, merging = size + 1, [*merging, self.levels.pop()[1]]
        scan = self._merged(new, *old)
        if more and len(merging) == len(old):  # the scan is the new level
            scan = saved(scan.sortWithinPartitions("key"), "level")
            self.levels.append((size, scan.drop("fresh")))
        elif more:
            level = self._merged(new, *[m.withColumn("fresh", F.lit(0)) for m in merging]).drop("fresh")
            self.levels.append((size, saved(level.sortWithinPartitions("key"), "level")))
        return saved(scan.where("fresh = 1 and n > 1").select("key", F.col("ctx").isNull().alias("mixed")), "alike")


def _told_apart(rows: DataFrame, alike: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows (id, p, lo, hi, key, ctx, w)`` whose key is in ``alike (key, mixed)``.

    Returns ``(id, lo, hi)`` of the rows whose surroundings occur several times, and of each surroundings in a mixed group
    one row to look at more closely, with its number (2 for more).
    """
    met = saved(rows.join(small_side(alike), "key"), "met")
    groups = saved(
        met.groupBy("key", "ctx").agg(
            F.sum("w").alias("n"), F.min(F.struct("id", "p", "lo", "hi")).alias("first"), F.first("mixed").alias("mixed")
        ),
        "groups",
    )
    several = saved(groups.where("n > 1").select("key", "ctx"), "several")
    repeated = met.join(small_side(several), ["key", "ctx"]).select("id", "lo", "hi")
    closer = groups.where("mixed").select("first.*", F.least("n", F.lit(2)).cast("int").alias("w"))
    return repeated, closer


def _alike(rows: DataFrame) -> DataFrame:
    found = rows.groupBy("key").agg((F.min("ctx") != F.max("ctx")).alias("mixed"), F.sum("w").alias("n"))
    return saved(found.where("n > 1").select("key", "mixed"), "alike")


def _by_document(rows: DataFrame) -> DataFrame:
    """``(id, _r)``: the rows of a document as an array."""
    return saved(rows.groupBy("id").agg(F.collect_list(F.struct("p", "lo", "hi", "w")).alias("_r")), "requests")


def _requests(batch: pa.RecordBatch, first: int, end: int, offsets: np.ndarray):
    """Document, ends of the document, and columns of the requests of rows ``first`` to ``end`` of a batch."""
    lists = batch.column("_r").slice(first, end - first)
    owner = np.repeat(np.arange(end - first), lists.value_lengths().to_numpy(zero_copy_only=False))
    rows = lists.flatten()
    columns = [rows.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("p", "lo", "hi", "w")]
    return owner, offsets[owner], offsets[owner + 1], *columns


def _blocks(docs: DataFrame, closer: DataFrame) -> DataFrame:
    """Rows for blocks of windows: ``key`` is what all windows of a block share, ``ctx`` all that they cover together."""
    kind = dict(docs.dtypes)["id"]

    def run(batches):
        sums = _Sums(9)
        for batch in batches:
            for first, end, data, offsets in views(batch.column("_text")):
                sums.load(data)
                owner, begins, ends, p, lo, hi, w = _requests(batch, first, end, offsets)
                low, high = (p - hi) // BLOCK, (p - lo) // BLOCK
                each = np.repeat(np.arange(len(p)), high - low + 1)
                block = np.arange(len(each)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1) + low[each]
                p, lo, hi, w, owner, begins, ends = (a[each] for a in (p, lo, hi, w, owner, begins, ends))
                near, far = block * BLOCK, np.minimum(block * BLOCK + BLOCK - 1, _REACH)
                at = p + begins
                shared = mix(sums.of(at - near, at - far + MATCH) + block.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                covered = _cut(at - far, at - near + MATCH, begins, ends, sums)
                spans = (p, np.maximum(lo, p - far), np.minimum(hi, p - near))
                columns = [batch.column("id").slice(first, end - first).take(pa.array(owner))]
                columns += [*(pa.array(a.astype(np.int32)) for a in spans), _signed(shared), _signed(covered), pa.array(w)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "p", "lo", "hi", "key", "ctx", "w"])

    wanted = docs.join(small_side(_by_document(closer)), "id")
    return wanted.select("id", "_text", "_r").mapInArrow(run, f"id {kind}, {_INT32}, key bigint, ctx bigint, w bigint")


def _windows(docs: DataFrame, closer: DataFrame) -> DataFrame:
    """``(id, s, k0, k1, w)``: single windows by their start, and 128 bits of their content."""
    kind = dict(docs.dtypes)["id"]

    def run(batches):
        sums, other = _Sums(9), _Sums(10, 0xC2B2AE3D27D4EB4F)
        for batch in batches:
            for first, end, data, offsets in views(batch.column("_text")):
                sums.load(data)
                other.load(data)
                owner, begins, _, _, lo, hi, w = _requests(batch, first, end, offsets)
                count = hi - lo + 1
                each = np.repeat(np.arange(len(lo)), count)
                s = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count) + lo[each]
                at = s + begins[each]
                columns = [
                    batch.column("id").slice(first, end - first).take(pa.array(owner[each])), pa.array(s.astype(np.int32)),
                    _signed(sums.of(at, at + MATCH)), _signed(other.of(at, at + MATCH)), pa.array(w[each]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "s", "k0", "k1", "w"])

    wanted = docs.join(small_side(_by_document(closer)), "id")
    return wanted.select("id", "_text", "_r").mapInArrow(run, f"id {kind}, s int, k0 bigint, k1 bigint, w bigint")


def _united(spans: DataFrame) -> DataFrame:
    """``(id, starts, ends)``: maximal runs of bytes covered by the windows that start in ``(id, lo, hi)``."""
    kind = dict(spans.dtypes)["id"]
    grouped = spans.groupBy("id").agg(F.collect_list(F.struct("lo", "hi")).alias("_r"))

    def run(batches):
        for batch in batches:
            starts, ends = [], []
            for rows in batch.column("_r"):
                lo = rows.values.field("lo").to_numpy(zero_copy_only=False).astype(np.int64)
                hi = rows.values.field("hi").to_numpy(zero_copy_only=False) + np.int64(MATCH)
                order = np.argsort(lo, kind="stable")
                lo, reached = lo[order], np.maximum.accumulate(hi[order])
                new = np.concatenate([[True], lo[1:] > reached[:-1]])
                starts.append(lo[new])
                ends.append(reached[np.append(np.flatnonzero(new)[1:], len(lo)) - 1])
            places = np.concatenate([[0], np.cumsum([len(s) for s in starts])]).astype(np.int32)
            lists = [list_array(np.concatenate(a) if a else np.zeros(0, np.int64), places) for a in (starts, ends)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *lists], names=["id", "starts", "ends"])

    return saved(grouped.mapInArrow(run, f"id {kind}, starts array<bigint>, ends array<bigint>"), "spans")


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", batches: int = BATCHES) -> DataFrame:
    """``(id, starts, ends)`` of the documents with repeated strings: the byte spans to remove, ends exclusive."""
    return _spans(_texts(docs, key, text), batches)


def _spans(texts: DataFrame, batches: int) -> DataFrame:
    """:func:`repeated_spans` of texts as stored by :func:`_texts`."""
    found = saved(anchors(texts).withColumn("batch", F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int")), "anchors")
    index, alike = SuffixIndex(), None
    for b in range(batches):
        one = index.add(found.where(F.col("batch") == b), more=b + 1 < batches)
        alike = one if alike is None else alike.unionByName(one)
    alike = saved(alike.groupBy("key").agg(F.max("mixed").alias("mixed")), "alike")
    repeated, closer = _told_apart(found.drop("batch").withColumn("w", F.lit(1).cast("long")), alike)
    blocks = saved(_blocks(texts, closer), "blocks")
    more, closer = _told_apart(blocks, _alike(blocks))
    windows = saved(_windows(texts, closer), "windows")
    several = saved(windows.groupBy("k0", "k1").agg(F.sum("w").alias("n")).where("n > 1").select("k0", "k1"), "several")
    single = windows.join(small_side(several), ["k0", "k1"]).select("id", F.col("s").alias("lo"), F.col("s").alias("hi"))
    return _united(repeated.unionByName(more).unionByName(single))


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(id, _text)`` in buckets by id: texts are shuffled once, and requests and spans come to them."""
    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.coalesce(text, F.lit("")).alias("_text"))
    return saved_by(rows, "id", "texts")


def removed(docs: DataFrame, key: str = "doc_id", text: str = "text", batches: int = BATCHES) -> DataFrame:
    """``(key, n_bytes, n_removed, n_spans, kept)`` of every document; ``kept`` is what is left, as binary, since a span may
    begin or end inside a character."""
    return _applied(docs, key, text, batches, lambda kept: kept, "binary", "kept")


def removed_digests(docs: DataFrame, key: str = "doc_id", text: str = "text", batches: int = BATCHES) -> DataFrame:
    """As :func:`removed`, with ``kept_sha256`` in place of the bytes."""
    return _applied(docs, key, text, batches, lambda kept: hashlib.sha256(kept).hexdigest(), "string", "kept_sha256")


def _applied(docs: DataFrame, key: str, text: str, batches: int, last, kind: str, name: str) -> DataFrame:
    texts = _texts(docs, key, text)
    joined = texts.join(small_side(_spans(texts, batches)), "id", "left")
    id_kind = dict(joined.dtypes)["id"]

    def run(batches):
        for batch in batches:
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], name: []}
            texts = batch.column("_text").cast(pa.large_binary())
            for t, s, e in zip(texts, batch.column("starts"), batch.column("ends")):
                data = memoryview(t.as_buffer())
                if s.is_valid:
                    s, e = s.values.to_pylist(), e.values.to_pylist()
                else:
                    s = e = []
                parts = [data[a:b] for a, b in zip([0, *e], [*s, len(data)])]
                for k, v in zip(out, (len(data), sum(e) - sum(s), len(s), last(b"".join(parts)))):
                    out[k].append(v)
            columns = [pa.array(v) for v in out.values()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=[key, *out])

    schema = f"{key} {id_kind}, n_bytes bigint, n_removed bigint, n_spans bigint, {name} {kind}"
    return joined.select("id", "_text", "starts", "ends").mapInArrow(run, schema)
