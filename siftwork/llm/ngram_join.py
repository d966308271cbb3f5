"""Join of documents whose word n-gram sets are similar: MinHash banding, then verification on the full sets.

The numbers of bands and rows follow from the target recall at the threshold (:func:`banding`). Only band hashes are
shuffled to find candidates; a pair counts when the Jaccard similarity of its full n-gram sets reaches the threshold.

Documents with equal n-gram sets are folded into the least of them. Every two of the others that share a bucket are compared
on their full n-gram sets, and no others, so a link is missed with the chance of banding only, whichever documents and however
many are in the bucket. Pairs are never rows of a table:

1. documents connected by buckets are a group, which is cut into blocks of about ``BLOCK`` n-grams; a task meets two blocks of
   one group, compares their documents in memory, and tells for each document how many links it has there and one document
   it is connected to. A group that fits one block is shuffled once;
2. a group of more than ``MOST`` blocks is brought together bucket by bucket instead, each cut into blocks, and a pair counts in
   the first bucket that it shares. This is another way to the same links.

Rows between tasks grow with documents times blocks of their group. Comparisons grow with the square of a group, as the links
to be counted may; documents too different in size are skipped.

Defined results: a document without words (null, empty, marks only) is in a class of its own with no links; one of fewer
than ``n`` words has a single n-gram of all of them; equal texts and repeated keys are in one class; rows with a null key
are left out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siftwork.llm.batches import WordReader, distinct_grams, list_array, random_values, views, with_text_columns
from siftwork.llm.links import connected
from siftwork.llm.tables import saved, small_side, unused
from siftwork.operators.skew import salted_join

BUCKET = ["band", "bucket"]
#: N-grams of the documents that a task holds of one block; each document counts as ``EACH`` more.
BLOCK, EACH = 250_000, 50
#: Blocks of a group of connected buckets; a larger one is compared by buckets.
MOST = 16


@cache
def banding(threshold: float, recall: float, most: int = 96) -> tuple[int, int]:
    """``(bands, rows)`` with the least chance of a false candidate among those that reach ``recall`` at ``threshold``.

    A pair of similarity ``s`` shares a bucket with probability ``1 - (1 - s^rows)^bands``. Of all choices of at most
    ``most`` hashes that give the recall, the one with the smallest area under this curve below the threshold is taken.
    """
    best = None
    for rows in range(1, most + 1):
        chance = threshold**rows
        bands = 1 if chance >= recall else math.ceil(math.log1p(-recall) / math.log1p(-chance))
        if bands * rows <= most:
            area = sum(1 - (1 - (threshold * i / 100) ** rows) ** bands for i in range(100))
            if best is None or area < best[0]:
                best = (area, bands, rows)
    if best is None:
        raise ValueError(f"{most} hashes do not reach a recall of {recall} at {threshold}")
    return best[1], best[2]


@dataclass(frozen=True)
class JoinRule:
    ngram: int = 5
    threshold: float = 0.8
    recall: float = 0.999

    @property
    def bands(self) -> tuple[int, int]:
        return banding(self.threshold, self.recall)


def _signatures(docs: DataFrame, rule: JoinRule) -> DataFrame:
    """``(id, k0, k1, size, bands)``: name and size of the n-gram set, and a hash for each band."""
    (bands, rows), n_words = rule.bands, rule.ngram

    def make():
        read = WordReader()
        factors = random_values(bands * rows, 1) | np.uint64(1)
        shifts = random_values(bands * rows, 2)
        weights = random_values(rows, 3) | np.uint64(1)

        def run(data, offsets):
            grams, starts = distinct_grams(*read(data, offsets).shingles(n_words, whole=True))
            n = len(starts) - 1
            some = np.flatnonzero(np.diff(starts))
            out = np.zeros((bands, n), np.uint64)
            names = np.zeros((2, n), np.uint64)
            if len(some):
                first = starts[some]
                spread = grams * np.uint64(0x9E3779B97F4A7C15)
                spread ^= spread >> np.uint64(29)
                for i, factor in enumerate((0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)):
                    named = spread * np.uint64(factor)
                    named ^= named >> np.uint64(31)
                    names[i, some] = np.add.reduceat(named * np.uint64(factor), first)
                for band in range(bands):
                    for row in range(rows):
                        k = band * rows + row
                        least = np.minimum.reduceat(spread * factors[k] + shifts[k], first)
                        out[band, some] += (least ^ (least >> np.uint64(32))) * weights[row]
            lists = pa.FixedSizeListArray.from_arrays(pa.array(out.T.ravel().view(np.int64)), bands)
            return [names[0].view(np.int64), names[1].view(np.int64), np.diff(starts), lists.cast(pa.list_(pa.int64()))]

        return run

    found = with_text_columns(docs, "_text", make, "k0 bigint, k1 bigint, size int, bands array<bigint>")
    return found.drop("_text")


def gram_sets(docs: DataFrame, n: int, text: str = "_text") -> DataFrame:
    """``docs`` with the text replaced by the ids of its distinct word n-grams."""

    def make():
        read = WordReader()

        def run(data, offsets):
            grams, starts = distinct_grams(*read(data, offsets).shingles(n, whole=True))
            return [list_array(grams.view(np.int64), starts)]

        return run

    return with_text_columns(docs, text, make, "grams array<bigint>").drop(text)


def _stars(
    sizes: np.ndarray, grams: np.ndarray, starts: np.ndarray, copies: np.ndarray, side: np.ndarray, bands: np.ndarray, band: int,
    threshold: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Of each document of two blocks (sides 0 and 1) or one (side -1): a document it is connected to, and its links.

    ``grams`` are numbers from 0 on. A link counts once for each copy of the other end. Pairs share one of their ``bands``; unless
    ``band`` is -1, it is the first one.
    """
    component, links = np.arange(len(sizes)), np.zeros(len(sizes), np.int64)
    order = np.argsort(sizes, kind="stable")
    whole = side[0] < 0
    left, right = (order, order) if whole else (order[side[order] == 0], order[side[order] == 1])
    wide = sizes[right]
    at = np.concatenate([[0], np.cumsum(wide)])
    flat = grams[np.repeat(starts[right] - at[:-1], wide) + np.arange(at[-1])]
    marks = np.zeros(int(grams.max()) + 1, np.int32)
    for k, i in enumerate(left.tolist()):
        size = int(sizes[i])
        first = int(np.searchsorted(wide, size * threshold - 1e-6))
        end = k if whole else int(np.searchsorted(wide, size / threshold + 1e-6, "right"))
        if first >= end:
            continue
        own = grams[starts[i] : starts[i] + size]
        marks[own] = 1
        common = np.add.reduceat(marks[flat[at[first] : at[end]]], at[first:end] - at[first])
        marks[own] = 0
        met = right[first:end][common / (size + wide[first:end] - common) >= threshold]
        same = bands[met] == bands[i]
        met = met[same.any(axis=1) & (band < 0 or same.argmax(axis=1) == band)]
        if len(met):
            links[i] += copies[met].sum()
            links[met] += copies[i]
            if (component[met] != component[i]).any():
                joined = np.unique(np.append(component[met], component[i]))
                component[np.isin(component, joined)] = joined[0]
    return component, links


def _compared(rows: DataFrame, threshold: float) -> DataFrame:
    """``(a, b, n)``: ``b`` has ``n`` links in one of its groups, by which it is connected to ``a`` (maybe itself).

    ``rows`` are ``group, side, band, id, copies, bands, grams``; ``band`` is -1 where a group holds all buckets of its documents.
    """
    kind = dict(rows.dtypes)["id"]

    def told(parts):
        batch = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        side, band, copies = (batch.column(k).to_numpy() for k in ("side", "band", "copies"))
        if len(side) < 2:
            return None
        lists = batch.column("grams")
        sizes = lists.value_lengths().to_numpy().astype(np.int64)
        _, grams = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        bands = batch.column("bands").flatten().to_numpy().reshape(len(side), -1)
        component, links = _stars(
            sizes, grams, np.concatenate([[0], np.cumsum(sizes)]), copies, side, bands, int(band[0]), threshold
        )
        some = np.flatnonzero(links)
        if not len(some):
            return None
        ids = batch.column("id")
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(component[some])), ids.take(pa.array(some)), pa.array(links[some])], names=["a", "b", "n"]
        )

    def run(batches):
        parts, group = [], None
        for batch in batches:
            groups = batch.column("group").to_numpy()
            if not len(groups):
                continue
            cuts = [0, *(np.flatnonzero(groups[1:] != groups[:-1]) + 1).tolist(), len(groups)]
            for first, end in zip(cuts, cuts[1:]):
                if parts and groups[first] != group:
                    if (found := told(parts)) is not None:
                        yield found
                    parts = []
                group = groups[first]
                parts.append(batch.slice(first, end - first))
        if parts and (found := told(parts)) is not None:
            yield found

    # a fixed number of partitions: few bytes may be many comparisons
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(tasks, "group").sortWithinPartitions("group")
    return dealt.mapInArrow(run, f"a {kind}, b {kind}, n bigint")


def _blocks(placed: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(band, name, blocks)``: how many blocks the groups ``(band, name)`` of ``placed`` are cut into."""
    weight = F.sum(F.col("size") + EACH) / BLOCK
    return placed.join(sizes, "id").groupBy("band", "name").agg(F.ceil(weight).cast("int").alias("blocks"))


def _places(buckets: DataFrame, reps: DataFrame) -> DataFrame:
    """``(id, band, name, blocks)``, stored: the groups a document is compared in."""
    sizes = reps.select("id", "size")
    near = buckets.where("leader <> id").select(F.col("leader").alias("a"), F.col("id").alias("b"))
    placed = saved(
        connected(near).select(F.col("node").alias("id"), F.lit(-1).alias("band"), F.xxhash64("component").alias("name")), "placed"
    )
    blocks = saved(_blocks(placed, sizes), "blocks")
    joined = saved(placed.join(blocks, ["band", "name"]), "places")
    large = saved(joined.where(F.col("blocks") > MOST).select("id"), "large")
    if large.isEmpty():
        return joined
    split = saved(buckets.join(large, "id").select("id", F.col("band").cast("int").alias("band"), F.col("bucket").alias("name")), "split")
    cut = saved(_blocks(split, sizes), "blocks")
    by_bucket = salted_join(
        split, cut, ["band", "name"], F.col("id"), counts=split.groupBy("band", "name").agg(F.count(F.lit(1)).alias("n"))
    )
    kept = joined.where(F.col("blocks") <= MOST)
    return saved(kept.unionByName(by_bucket.select(*kept.columns)), "places")


def _labelled(rows: DataFrame, labels: DataFrame, column: str, name: str) -> DataFrame:
    found = rows.join(labels.select(F.col("node").alias(column), F.col("component").alias(name)), column, "left")
    return found.withColumn(name, F.coalesce(name, column))


@dataclass
class Joined:
    """Stored results: ``members`` (id, rep, copies), ``links`` (a, b, n) of representatives, ``labels``.

    A row of ``links`` stands for ``n`` links of ``b``, a link to each copy of the other text, in a class with ``a``.
    """

    members: DataFrame
    links: DataFrame
    labels: DataFrame


def similar(docs: DataFrame, rule: JoinRule = JoinRule(), key: str = "doc_id", text: str = "text") -> Joined:
    """The verified links between representatives of equal n-gram sets, and the classes they make."""
    texts = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.coalesce(text, F.lit("")).alias("_text"))
    signed = saved(_signatures(texts, rule), "signatures")
    sets = signed.where("size > 0").groupBy("k0", "k1", "size").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    copied = saved(sets.where("copies > 1"), "copied")
    members = saved(
        salted_join(
            signed.where("size > 0").select("id", "k0", "k1", "size"), copied, ["k0", "k1", "size"],
            F.monotonically_increasing_id(), "left", copied.withColumnRenamed("copies", "n"),
        ).select("id", F.coalesce("rep", "id").alias("rep"), F.coalesce("copies", F.lit(1)).alias("copies")),
        "members",
    )
    firsts = members.where("rep = id").select("id", "copies").dropDuplicates(["id"])
    reps = saved(signed.where("size > 0").drop("k0", "k1").join(firsts, "id").dropDuplicates(["id"]), "reps")
    banded = reps.select("id", F.posexplode("bands").alias(*BUCKET))
    shared = banded.groupBy(*BUCKET).agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = saved(shared, "shared")
    buckets = saved(salted_join(banded, shared.drop("n"), BUCKET, F.col("id"), counts=shared), "buckets")
    places = _places(buckets, reps)
    sharing = saved(places.select("id").distinct(), "sharing")
    grams = gram_sets(texts.join(small_side(sharing), "id", "left_semi"), rule.ngram).dropDuplicates(["id"])
    known = reps.select("id", "copies", "bands")
    block, other = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"), F.col("_other")
    met = grams.join(places.join(known, "id"), "id").withColumn("_block", block).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    rows = met.select(
        F.xxhash64("band", "name", F.least("_block", other), F.greatest("_block", other)).alias("group"),
        F.when(F.col("_block") == other, -1).when(F.col("_block") < other, 0).otherwise(1).alias("side"),
        "band", "id", "copies", "bands", "grams",
    )
    links = saved(_compared(rows, rule.threshold), "links")
    return Joined(members, links, connected(links))


def classes(docs: DataFrame, rule: JoinRule = JoinRule(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, class_id, n_links)`` of every document: the least key of its class, and its verified links.

    A document has a link to every similar document, those with its own n-gram set included.
    """
    joined = similar(docs, rule, key, text)
    ends = joined.links.groupBy(F.col("b").alias("rep")).agg(F.sum("n").alias("_links"))
    named = joined.labels.select(F.col("node").alias("rep"), F.col("component").alias("class_id"))
    reps = saved(named.join(ends, "rep", "left"), "classes")
    found = salted_join(
        joined.members, reps, ["rep"], F.col("id"), "left", joined.members.groupBy("rep").agg(F.count(F.lit(1)).alias("n"))
    ).select(
        F.col("id").alias(key), F.coalesce("class_id", "rep").alias("class_id"),
        (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    keys = docs.where(F.col(key).isNotNull()).select(key).distinct()
    return keys.join(found.dropDuplicates([key]), key, "left").select(
        key, F.coalesce("class_id", key).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    )


def keep_first(docs: DataFrame, rule: JoinRule = JoinRule(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents whose class has a lesser key, and with one row per key. Rows with a null key stay."""
    joined = similar(docs, rule, key, text)
    named = _labelled(joined.members.select("id", "rep"), joined.labels, "rep", "_class")
    dropped = saved(named.where("id <> _class").select(F.col("id").alias(key)).distinct(), "dropped")
    kept = docs.join(small_side(dropped), key, "left_anti")
    counts = docs.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    repeated = saved(counts.where("_n > 1").select(key), "repeated")
    if repeated.isEmpty():
        return kept
    side = small_side(repeated)
    order = Window.partitionBy(key).orderBy(F.col(text).desc_nulls_last())
    row = unused(docs, "row")
    firsts = kept.join(side, key, "left_semi").withColumn(row, F.row_number().over(order)).where(F.col(row) == 1).drop(row)
    return kept.join(side, key, "left_anti").unionByName(firsts.select(*kept.columns))
