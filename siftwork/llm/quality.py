"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of every whole text are computed in the tasks (:mod:`statistics`). The trees are fitted by numpy on a bounded
sample of labelled rows, ``MOST_ROWS`` by order of a hash, and flattened into arrays; scoring passes a matrix of documents
through all trees level by level.

Defined results: null and empty texts have the statistics of no text and get a score like any other; repeated rows get
equal scores; without labelled rows, or with one class only, every score is the smoothed share of that class.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.llm.statistics import NAMES, with_statistics
from siftwork.llm.tables import saved

#: Labelled rows the trees are fitted on, at most; they are collected.
MOST_ROWS = 20_000


@dataclass(frozen=True)
class Boosting:
    trees: int = 60
    depth: int = 5
    rate: float = 0.2
    bins: int = 64
    smoothing: float = 1.0
    least_weight: float = 2.0


@dataclass(frozen=True)
class Forest:
    """Complete trees as arrays: node ``i`` has the children ``2i+1`` (not above the threshold) and ``2i+2``."""

    base: float
    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray
    leaf: np.ndarray  # (trees, leaves)

    def score(self, rows: np.ndarray) -> np.ndarray:
        inner = self.feature.shape[1]
        trees = np.arange(len(self.feature))[None, :]
        at = np.zeros((len(rows), len(self.feature)), np.int64)
        here = np.arange(len(rows))[:, None]
        while inner and at.size and at[0, 0] < inner:
            above = rows[here, self.feature[trees, at]] > self.threshold[trees, at]
            at = 2 * at + 1 + above
        margin = self.base + self.leaf[trees, at - inner].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit(rows: np.ndarray, labels: np.ndarray, how: Boosting = Boosting()) -> Forest:
    """Trees for ``P(label = 1)`` by second-order boosting on histograms of quantile bins."""
    n, width = rows.shape
    inner, leaves = 2**how.depth - 1, 2**how.depth
    share = (labels.sum() + 1) / (n + 2)
    base = float(np.log(share / (1 - share)))
    if n == 0 or labels.min() == labels.max():
        return Forest(base, np.zeros((1, inner), np.int64), np.full((1, inner), np.inf), np.zeros((1, leaves)))
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, how.bins + 1)[1:-1]).astype(np.float32)) for f in range(width)]
    binned = np.column_stack([np.searchsorted(c, rows[:, f], "left") for f, c in enumerate(cuts)])
    margin = np.full(n, base)
    features, thresholds, values = [], [], []
    for _ in range(how.trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = p - labels, np.maximum(p * (1 - p), 1e-6)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        at = np.zeros(n, np.int64)
        for level in range(how.depth):
            first, nodes = 2**level - 1, 2**level
            slot = (at - first) * how.bins
            best = np.full(nodes, 1e-9)
            for f in range(width):
                place = slot + binned[:, f]
                g = np.bincount(place, gradient, nodes * how.bins).reshape(nodes, how.bins).cumsum(axis=1)
                h = np.bincount(place, weight, nodes * how.bins).reshape(nodes, how.bins).cumsum(axis=1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                fits = (h >= how.least_weight) & (h_all - h >= how.least_weight)
                gain = np.where(
                    fits,
                    g**2 / (h + how.smoothing) + (g_all - g) ** 2 / (h_all - h + how.smoothing)
                    - g_all**2 / (h_all + how.smoothing),
                    0,
                )[:, : len(cuts[f])]
                if not gain.shape[1]:
                    continue
                where = gain.argmax(axis=1)
                top = gain[np.arange(nodes), where]
                better = top > best
                best[better] = top[better]
                feature[first + np.flatnonzero(better)] = f
                threshold[first + np.flatnonzero(better)] = cuts[f][where[better]]
            at = 2 * at + 1 + (rows[np.arange(n), feature[at]] > threshold[at])
        leaf = at - inner
        step = -how.rate * np.bincount(leaf, gradient, leaves) / (np.bincount(leaf, weight, leaves) + how.smoothing)
        margin += step[leaf]
        features.append(feature), thresholds.append(threshold), values.append(step)
    return Forest(base, np.array(features), np.array(thresholds), np.array(values))


def labelled_sample(labels: DataFrame, key: str, most: int = MOST_ROWS) -> DataFrame:
    """At most ``most`` rows of a table of labels, by order of a hash of the key."""
    return labels.orderBy(F.xxhash64(F.lit("sample"), key), key).limit(most)


def train(features: DataFrame, labels: DataFrame, key: str, label: str, how: Boosting = Boosting()) -> Forest:
    """Fit on a sample of ``labels`` (``key``, ``label``) joined with stored ``features``."""
    sample = labelled_sample(labels.select(key, label).where(F.col(label).isNotNull()), key)
    found = features.join(F.broadcast(sample), key).select(F.col("features"), F.col(label).cast("double").alias("y"))
    # rows arrive in any order; sorted, the same labels give the same trees
    table = found.toArrow()
    x = table["features"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, len(NAMES))
    y = table["y"].to_numpy()
    order = np.lexsort([*x.T, y])
    return fit(x[order], y[order], how)


def scored(features: DataFrame, forest: Forest, name: str = "score") -> DataFrame:
    """``features`` with the array column replaced by the score."""
    import pyarrow as pa
    from pyspark.sql.types import DoubleType, StructField, StructType

    kept = [c for c in features.columns if c != "features"]
    schema = StructType([features.schema[c] for c in kept] + [StructField(name, DoubleType())])

    def run(batches):
        for batch in batches:
            rows = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(NAMES))
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(forest.score(rows))], names=schema.names)

    return features.select(*kept, "features").mapInArrow(run, schema)


def classify(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    how: Boosting = Boosting(),
) -> DataFrame:
    """``(key, score)`` of all ``docs``; the trees are fitted on ``labels``. The texts are read once."""
    features = saved(with_statistics(docs.select(key, text), text).select(key, "features"), "statistics")
    return scored(features, train(features, labels, key, label, how))


def held_out(key: Column, parts: int, part: int) -> Column:
    """Rows whose key falls into one of ``parts`` by the CRC-32 of its decimal text."""
    return F.pmod(F.crc32(key.cast("string")), F.lit(parts)) == part
