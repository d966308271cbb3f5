"""Near-duplicate documents: MinHash signatures, LSH buckets, verified Jaccard, clusters.

Two documents are linked when they share a bucket and the Jaccard similarity of their gram sets reaches the
threshold; clusters are the connected components of the links, and the smallest key of each is kept.

For the clusters, pairs of a bucket are never enumerated. They are found in three exact steps:

1. Documents with equal gram sets (copies) are folded into one representative by a plain aggregation.
2. In every bucket, each representative is compared with the smallest one only (a star). The links found this way
   are turned into components. A bucket whose members are then all in one component is finished: no further link
   inside it could change a cluster.
3. The members of the buckets left go through a set-similarity join on their rarest grams (:mod:`similarity_join`), which
   finds all similar pairs between different components; those that share a bucket are links.

The list of all links is the same join over all representatives that share a bucket. Only the list of candidates has all pairs of
each bucket as rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.functions import text as T
from siftwork.functions.hashing import PRIME, SEED, minhash_family
from siftwork.operators.components import components
from siftwork.operators.similarity_join import candidate_pairs
from siftwork.operators.skew import salted_join
from siftwork.session import materialize


BUCKET = ["band", "b0", "b1"]
#: Members of a bucket that meet those of another block, or each other, in one task.
BLOCK = 2_000


@dataclass(frozen=True)
class MinHashParameters:
    """Signature and banding parameters, checked when created."""

    num_hashes: int = 40
    num_bands: int = 10
    ngrams: int = 5
    threshold: float = 0.8
    seed: int = SEED

    def __post_init__(self):
        for name in ("num_hashes", "num_bands", "ngrams"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} is {getattr(self, name)}; at least 1 is needed")
        if self.num_hashes % self.num_bands:
            raise ValueError(f"{self.num_hashes} hashes cannot be shared out evenly among {self.num_bands} bands")

    @property
    def rows_per_band(self) -> int:
        return self.num_hashes // self.num_bands


def _gram_ids(n: int, names: list[str]):
    """Puts in place of a normalised text, the last column, the ids of its distinct runs of ``n`` words, in order of appearance:
    :func:`gram_id` of the words joined by a separator that no word contains. Empty for fewer than ``n`` words."""

    def ids(texts: pa.Array) -> pa.Array:
        found, sizes = [], []
        for text in texts.to_pylist():
            if not text:
                sizes.append(None if text is None else 0)
                continue
            data = text.replace(" ", "\x1f").encode()
            gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 0x1F).tolist()
            starts, ends = [0, *[g + 1 for g in gaps]], [*gaps, len(data)]
            digests = b"".join([md5(data[i:j], usedforsecurity=False).digest() for i, j in zip(starts, ends[n - 1:])])
            # the leading 15 of the 32 hexadecimal digits
            values = (np.frombuffer(digests, ">u8")[::2].astype(np.uint64) >> np.uint64(4)).view(np.int64)
            values = values[np.sort(np.unique(values, return_index=True)[1])]
            found.append(values)
            sizes.append(len(values))
        offsets = np.concatenate([[0], np.cumsum([s or 0 for s in sizes])]).astype(np.int32)
        flat = pa.array(np.concatenate(found) if found else np.zeros(0, np.int64))
        return pa.ListArray.from_arrays(pa.array(offsets), flat, mask=pa.array([s is None for s in sizes], pa.bool_()))

    def run(batches):
        for batch in batches:
            last = batch.num_columns - 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], ids(batch.column(last))], names=names)

    return run


def with_grams(df: DataFrame, n: int, text: str = "text", grams: str = "grams") -> DataFrame:
    """``df`` with the ids of the distinct word n-grams of the normalised text as an array, in place of the text."""
    kept = [c for c in df.columns if c != text]
    schema = df.select(*kept, F.lit(None).cast("array<bigint>").alias(grams)).schema
    return df.select(*kept, T.normalize_text(F.col(text)).alias("_normal")).mapInArrow(_gram_ids(n, schema.names), schema)


def gram_counts(df: DataFrame, n: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    return with_grams(df.select(key, text), n, text).select(key, F.size("grams").alias("n_grams"))


def signatures(df: DataFrame, p: MinHashParameters, keys: list[str], grams: str = "grams") -> DataFrame:
    """``(*keys, sig_0 … sig_k)`` from a gram array column.

    The minima of a document are taken inside its row, so the shuffle carries one row of minima per document. Documents
    without grams have no signature.
    """
    full = df.where(F.size(grams) > 0).select(*keys, F.col(grams).alias("_minima"))
    minima = full.mapInArrow(_minima(p), full.schema)
    each = [f"_minima[{i}] AS sig_{i}" for i in range(p.num_hashes)]
    return minima.selectExpr(*keys, *each).groupBy(*keys).agg(*[F.min(f"sig_{i}").alias(f"sig_{i}") for i in range(p.num_hashes)])


def _minima(p: MinHashParameters):
    """Puts in place of an array of gram ids that is not empty, the last column, the least value of every function of the family."""
    family = minhash_family(p.num_hashes, p.seed)

    def least(arrays: pa.Array) -> pa.Array:
        sizes = arrays.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        hashes = arrays.flatten().to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(28)  # as base_hash
        out = np.empty((len(arrays), len(family)), np.int64)
        low, first = np.uint64(PRIME), 0
        while first < len(arrays):  # as many rows as fit a cache
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + (1 << 15), "right")) - 1)
            h = hashes[ends[first]:ends[last]]
            for i, (a, b) in enumerate(family):
                x = h * np.uint64(a) + np.uint64(b)
                for _ in range(2):  # modulo 2^31 - 1
                    x = (x & low) + (x >> np.uint64(31))
                x[x == low] = 0
                out[first:last, i] = np.minimum.reduceat(x, ends[first:last] - ends[first])
            first = last
        return pa.ListArray.from_arrays(pa.array(np.arange(len(arrays) + 1, dtype=np.int32) * len(family)), pa.array(out.ravel()))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                last = batch.num_columns - 1
                yield pa.RecordBatch.from_arrays([*batch.columns[:last], least(batch.column(last))], names=batch.schema.names)

    return run


def band_rows(signature: DataFrame, p: MinHashParameters, key: str) -> DataFrame:
    """``(band, b0, b1, key)``: one row per document and band; ``b0, b1`` are 128 bits of the band's values."""
    r, bands = p.rows_per_band, []
    for b in range(p.num_bands):
        values = ", ".join(f"sig_{i}" for i in range(b * r, b * r + r))
        bands.append(f"struct({b} AS band, xxhash64({values}) AS b0, xxhash64('second half', {values}) AS b1)")
    return signature.selectExpr(key, f"inline(array({', '.join(bands)}))").select(*BUCKET, key)


@dataclass
class _Prepared:
    """Intermediate tables, each written once to the checkpoint folder."""

    documents: DataFrame  # _id, rep
    grams: DataFrame  # rep, grams, n_grams of the representatives that share a bucket
    buckets: DataFrame  # band, b0, b1, rep, first (smallest rep of the bucket), size


def _prepare(df: DataFrame, p: MinHashParameters, key: str, text: str) -> _Prepared:
    source = df.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    set_key = ["_k0", "_k1", "_size"]
    sets = with_grams(source, p.ngrams, "_text").withColumn("grams", F.array_sort("grams"))
    keyed = sets.select(
        "_id",
        F.xxhash64("grams").alias("_k0"),
        F.xxhash64(F.lit("second half"), "grams").alias("_k1"),
        F.size("grams").alias("_size"),
        "grams",
    )
    signed = materialize(signatures(keyed, p, ["_id", *set_key]))
    smallest = signed.groupBy(*set_key).agg(F.min("_id").alias("rep"), F.count(F.lit(1)).alias("n"))
    documents = salted_join(
        signed.select("_id", *set_key), smallest.drop("n"), set_key, F.col("_id"), counts=smallest
    ).select("_id", "rep")
    unique = signed.join(smallest.select(F.col("rep").alias("_id")), "_id", "left_semi")
    bands = band_rows(unique.withColumnRenamed("_id", "rep"), p, "rep")
    shared = bands.groupBy(*BUCKET).agg(F.min("rep").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = materialize(
        salted_join(bands, shared.withColumnRenamed("n", "size"), BUCKET, F.col("rep"), counts=shared)
    )
    sharing = buckets.select(F.col("rep").alias("_id")).distinct()
    grams = with_grams(source.join(sharing.hint("shuffle_hash"), "_id", "left_semi"), p.ngrams, "_text").select(
        F.col("_id").alias("rep"), "grams", F.size("grams").alias("n_grams")
    )
    return _Prepared(documents, materialize(grams), buckets)


def _jaccard(pairs: DataFrame, grams: DataFrame) -> DataFrame:
    """Adds ``jaccard`` to distinct pairs ``(a, b)``; a document that meets very many others is salted."""
    left = grams.select(F.col("rep").alias("a"), F.col("grams").alias("_ga"), F.col("n_grams").alias("_na"))
    right = grams.select(F.col("rep").alias("b"), F.col("grams").alias("_gb"), F.col("n_grams").alias("_nb"))
    met = salted_join(pairs, left, ["a"], F.col("b"))
    met = salted_join(met, right, ["b"], F.col("a"), counts=pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n")))
    both = F.size(F.array_intersect("_ga", "_gb"))
    return met.withColumn("_both", both).select(
        "a", "b", (F.col("_both") / (F.col("_na") + F.col("_nb") - F.col("_both"))).alias("jaccard")
    )


def _star_pairs(buckets: DataFrame) -> DataFrame:
    """Distinct ``(a, b)``: the smallest representative of a bucket and each other member."""
    return buckets.where("rep <> first").select(F.col("first").alias("a"), F.col("rep").alias("b")).distinct()


def _bucket_sets(buckets: DataFrame) -> DataFrame:
    """``(rep, places)``: the buckets of a representative as one array of their hashes."""
    return buckets.groupBy("rep").agg(F.collect_set(F.xxhash64(*BUCKET)).alias("places"))


def _sharing_a_bucket(pairs: DataFrame, buckets: DataFrame) -> DataFrame:
    """The pairs ``(a, b, …)`` whose ends share a bucket."""
    places = materialize(_bucket_sets(buckets))
    left = places.select(F.col("rep").alias("a"), F.col("places").alias("_pa"))
    right = places.select(F.col("rep").alias("b"), F.col("places").alias("_pb"))
    met = salted_join(salted_join(pairs, left, ["a"], F.col("b")), right, ["b"], F.col("a"))
    return met.where(F.arrays_overlap("_pa", "_pb")).drop("_pa", "_pb")


def _mixed(buckets: DataFrame, labels: DataFrame) -> DataFrame | None:
    """``(rep, component)`` of the members of buckets that still hold several components; None when there are none."""
    node = labels.select(F.col("node").alias("rep"), "component")
    labelled = materialize(buckets.join(node, "rep", "left").withColumn("component", F.coalesce("component", "rep")))
    mixed = labelled.groupBy(*BUCKET).agg(
        F.min("component").alias("_lo"), F.max("component").alias("_hi"), F.count(F.lit(1)).alias("n")
    ).where("_lo <> _hi").select(*BUCKET, "n")
    active = salted_join(labelled, mixed.drop("n"), BUCKET, F.col("rep"), "left_semi", counts=mixed)
    active = materialize(active.select("rep", "component").distinct())
    return None if active.isEmpty() else active


def _clusters(df: DataFrame, p: MinHashParameters, key: str, text: str) -> tuple[_Prepared, DataFrame]:
    """Prepared tables and the components of the representatives."""
    prepared = _prepare(df, p, key, text)

    def links(pairs: DataFrame) -> DataFrame:
        return _jaccard(pairs, prepared.grams).where(F.col("jaccard") >= p.threshold).select("a", "b")

    labels = components(links(_star_pairs(prepared.buckets)), "a", "b")
    active = _mixed(prepared.buckets, labels)
    if active is not None:
        sets = prepared.grams.join(active, "rep")
        pairs = materialize(candidate_pairs(sets, p.threshold, "component"))
        more = materialize(links(_sharing_a_bucket(pairs, prepared.buckets)))
        if not more.isEmpty():
            known = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
            labels = components(known.union(more), "a", "b")
    return prepared, labels


def candidate_links(
    df: DataFrame, p: MinHashParameters, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(a, b)``, ``a < b``: every two documents that share a bucket, once.

    All documents take part (copies are not folded), so the rows grow with the square of a bucket. Its members are dealt to
    blocks of about ``BLOCK``, and every two blocks meet under a key of their own, so no task holds a bucket of any size. A pair is
    listed in the first bucket that it shares: its ends carry their buckets along, and pairs are not shuffled.
    """
    known = df.where(F.col(key).isNotNull()).select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    signed = materialize(signatures(with_grams(known, p.ngrams, "_text"), p, ["_id"]))
    bands = band_rows(signed, p, "_id")
    shared = bands.groupBy(*BUCKET).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = salted_join(bands, shared.withColumnRenamed("n", "size"), BUCKET, F.col("_id"), counts=shared)
    every = range(p.num_bands)
    places = materialize(
        members.groupBy("_id").agg(*[F.max(F.when(F.col("band") == i, F.col(c))).alias(f"{c}_{i}") for i in every for c in ("b0", "b1", "size")])
    )
    before = [c for i in every[:-1] for c in (f"b0_{i}", f"b1_{i}")]
    own = F.array(*[F.struct(F.lit(i).alias("band"), *[F.col(f"{c}_{i}").alias(c) for c in ("b0", "b1", "size")]) for i in every])
    rows = places.select("_id", *before, F.inline(own)).where("size IS NOT NULL").withColumn("_blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("_id"), F.col("_blocks")).cast("int")).drop("size")
    low = rows.withColumn("_low", F.col("_block")).withColumn("_high", F.explode(F.sequence("_block", F.col("_blocks") - 1)))
    high = rows.withColumn("_high", F.col("_block")).withColumn("_low", F.explode(F.sequence(F.lit(0), "_block")))
    unit = [*BUCKET, "_low", "_high"]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # by number: little is read, but the pairs are many
    left, right = (
        side.select(*unit, *[F.col(c).alias(f"{name}_{c}") for c in ("_id", *before)]).repartition(n, *unit)
        for name, side in (("x", low), ("y", high))
    )
    met = left.join(right, unit)
    earlier = F.lit(False)
    for i in every[:-1]:
        same = [F.col(f"x_{c}_{i}") == F.col(f"y_{c}_{i}") for c in ("b0", "b1")]
        earlier = earlier | F.coalesce((F.col("band") > i) & same[0] & same[1], F.lit(False))
    once = (F.col("_low") < F.col("_high")) | (F.col("x__id") < F.col("y__id"))
    return met.where(once & ~earlier).select(F.least("x__id", "y__id").alias("a"), F.greatest("x__id", "y__id").alias("b"))


def lsh_buckets(df: DataFrame, p: MinHashParameters, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, band, leader, n)``: the bucket of a document in each band that it shares with others.

    A bucket is named by its smallest document, so all candidate pairs are in the result, as membership instead of as rows.
    """
    bands = materialize(band_rows(signatures(with_grams(df.select(key, text), p.ngrams, text), p, [key]), p, key))
    shared = bands.groupBy(*BUCKET).agg(F.min(key).alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    met = salted_join(bands, shared.withColumnRenamed("n", "_size"), BUCKET, F.col(key), counts=shared)
    return met.select(key, "band", "leader", F.col("_size").alias("n"))


def verified_links(
    df: DataFrame, p: MinHashParameters, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(a, b, jaccard)``: every pair that shares a bucket and reaches the threshold, in terms of representatives.

    Of documents with equal gram sets the smallest key stands for all; each copy is a row with its representative and the
    similarity 1, so copies are not expanded into pairs. The components of the rows are the duplicate clusters.
    """
    prepared = _prepare(df, p, key, text)
    pairs = materialize(candidate_pairs(prepared.grams.select("rep", "grams"), p.threshold))
    found = materialize(_jaccard(pairs, prepared.grams).where(F.col("jaccard") >= p.threshold))
    copies = prepared.documents.where("_id <> rep").select(F.col("rep").alias("a"), F.col("_id").alias("b"), F.lit(1.0).alias("jaccard"))
    return _sharing_a_bucket(found, prepared.buckets).select("a", "b", "jaccard").unionByName(copies)


def duplicate_clusters(
    df: DataFrame, p: MinHashParameters, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(key, cluster_id)`` of every document that has duplicates; ``cluster_id`` is the smallest key."""
    prepared, labels = _clusters(df, p, key, text)
    of_rep = prepared.documents.groupBy("rep").agg(F.count(F.lit(1)).alias("n"))
    named = salted_join(
        prepared.documents, labels.withColumnRenamed("node", "rep"), ["rep"], F.col("_id"), "left", counts=of_rep
    ).select(F.col("_id").alias(key), F.coalesce("component", "rep").alias("cluster_id"))
    sizes = named.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return salted_join(named, sizes.drop("n"), ["cluster_id"], F.col(key), "left_semi", counts=sizes).select(
        key, "cluster_id"
    )


def drop_near_duplicates(
    df: DataFrame, p: MinHashParameters, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Documents without the later members of each cluster; their content is not changed."""
    clusters = duplicate_clusters(df, p, key, text)
    return df.join(clusters.where(F.col(key) != F.col("cluster_id")).select(key), key, "left_anti")
