"""A linear softmax classifier over averaged features, trained by full gradient rounds that are grouped sums.

A document is the mean of its features (words, neighbouring pairs, and a bias), as in shallow text classifiers; a class has one
weight per feature. Each round scores all documents, and moves every weight by the gradient divided by a bound of the
curvature: features of a document average to one, so ``sum(x) / 2`` over the documents bounds it, and no round can raise the loss.
There is no step size to choose.

Weights, residuals and gradients are integers (units ``WEIGHT`` and ``RESIDUAL``), so sums do not depend on the order of rows.
Training moves its rows once, to buckets by feature. Weights are stored in the same buckets, so a round joins and groups by feature
without a shuffle; only sums per document travel, and a feature has one row per document at most, so none is hot. Words of up to
``DOCUMENTS`` documents are kept as arrays (:mod:`softmax_arrays`).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.operators import softmax_arrays
from siftwork.operators.classifiers import WORDS, FeatureSet, WordIds, weight_sums, word_bags
from siftwork.operators.skew import lookup_join
from siftwork.session import materialize, materialize_by

WEIGHT = 1_000_000
RESIDUAL = 1 << 30
#: Bytes of text for each bucket of features, as long as there are fewer of them than shuffles have partitions.
BUCKET_BYTES = 2 << 20
#: Documents whose residuals are sent to every task; of more, training takes rows, which they meet by a shuffle.
DOCUMENTS = 4_000_000


@dataclass(frozen=True)
class SoftmaxRule:
    rounds: int = 10
    #: Pull of the weights towards 0, in documents.
    l2: float = 1e-3
    #: Occurrences of a feature that get it a weight.
    min_count: int = 2


@dataclass(frozen=True)
class Softmax:
    """``weights``: a row per feature with ``total``, its occurrences in training, and ``w_0 …``, one per class in order."""

    weights: DataFrame
    classes: tuple[str, ...]
    features: FeatureSet = WORDS


def _whole(value: Column) -> Column:
    return F.floor(value + 0.5).cast("long")


def _weights(k: int) -> list[str]:
    return [f"w_{i}" for i in range(k)]


def _margins(rows: DataFrame, weights: DataFrame, k: int, keep: list[str]) -> DataFrame:
    """``(*keep, n, z_0 …)``: sums of the weights of a document's known features, and how many those are."""
    counts = weights.select("feature", F.col("total").alias("n"))
    return _sums(lookup_join(rows, weights.select("feature", *_weights(k)), ["feature"], F.col(keep[0]), counts=counts), k, keep)


def _sums(known: DataFrame, k: int, keep: list[str]) -> DataFrame:
    sums = [F.sum(F.col("c") * F.col(w)).alias(f"z_{i}") for i, w in enumerate(_weights(k))]
    return known.groupBy(*keep).agg(F.sum("c").alias("n"), *sums)


def _masses(k: int) -> list[Column]:
    means = [F.col(f"z_{i}").cast("double") / (F.col("n") * WEIGHT) for i in range(k)]
    return [F.exp(m - F.greatest(*means)) for m in means]


def _bags(df: DataFrame, features: FeatureSet, text: str, *keep: str) -> DataFrame:
    """``(*keep, feature, c)``: occurrences of each feature in each document, for words a row per text and feature."""
    if isinstance(features, WordIds):
        return word_bags(df, text, *keep)
    return features.explode(df, text, *keep).groupBy(*keep, "feature").agg(F.count(F.lit(1)).alias("c"))


def _buckets(df: DataFrame) -> int:
    """Into how many buckets features are dealt: as many as shuffles have partitions, fewer for a few texts."""
    session = df.sparkSession
    size = df.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(int(session.conf.get("spark.sql.shuffle.partitions")), max(session.sparkContext.defaultParallelism, size // BUCKET_BYTES))


def _of_documents(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``rows`` with the numbers of their documents, which are stored; by broadcast up to a bound, so that rows stay where they are."""
    return rows.join(F.broadcast(table) if table.count() <= DOCUMENTS else table, key)


def train_softmax(
    df: DataFrame, label: str, classes: tuple[str, ...], key: str = "doc_id", text: str = "text",
    rule: SoftmaxRule = SoftmaxRule(), features: FeatureSet = WORDS,
) -> Softmax:
    """Fit on the rows of ``df`` whose ``label`` is one of ``classes``; others are not used. Keys must be unique."""
    k = len(classes)
    number = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)) - 1
    # stored, as joining texts with labels may shuffle the texts
    labelled = materialize(df.select(key, F.col(text).alias("text"), number.alias("_y")).where("_y >= 0"))

    def residuals() -> list[Column]:
        masses = _masses(k)
        whole = sum(masses[1:], masses[0])
        return [_whole((m / whole - (F.col("_y") == i).cast("double")) * RESIDUAL / F.col("n")).alias(f"r_{i}") for i, m in enumerate(masses)]

    units = materialize(labelled.select(key, "_y").where(F.col(key).isNotNull()).distinct())
    if isinstance(features, WordIds) and units.count() <= DOCUMENTS:
        weights = softmax_arrays.train(labelled, units, key, _weights(k), rule, residuals, WEIGHT, RESIDUAL)
    else:
        weights = _train_rows(labelled, key, k, rule, features, residuals)
    return Softmax(weights, tuple(classes), features)


def _train_rows(labelled: DataFrame, key: str, k: int, rule: SoftmaxRule, features: FeatureSet, residuals) -> DataFrame:
    """The weights after all rounds, as rows: for features by name, and for more documents than a task may know."""
    n = _buckets(labelled)
    found = _bags(labelled, features, "text", key, "_y").repartition(n, "feature")
    bags = materialize_by(found.groupBy(key, "_y", "feature").agg(F.sum("c").alias("c")), "feature", n, dealt=True)
    total = bags.groupBy("feature").agg(F.sum("c").alias("total")).where((F.col("total") >= rule.min_count) | F.expr(features.is_bias))
    rows = materialize_by(bags.join(total.select("feature").hint("shuffle_hash"), "feature"), "feature", n, dealt=True)
    sizes = materialize(rows.groupBy(key).agg(F.sum("c").alias("n")))
    part = F.col("c") * _whole(F.lit(float(RESIDUAL)) / F.col("n"))
    mass = _of_documents(rows, sizes, key).groupBy("feature").agg(F.sum(part).alias("mass"))
    state = mass.join(total.hint("shuffle_hash"), "feature").select(
        "feature", "total", "mass", *[F.lit(0).cast("long").alias(w) for w in _weights(k)]
    )
    state = materialize_by(state, "feature", n, dealt=True)
    for _ in range(rule.rounds):
        known = rows.join(state.select("feature", *_weights(k)).hint("shuffle_hash"), "feature")
        margins = _sums(known, k, [key, "_y"])
        errors = materialize(margins.select(key, *residuals()))
        sums = [F.sum(F.col("c") * F.col(f"r_{i}")).alias(f"g_{i}") for i in range(k)]
        gradient = _of_documents(rows, errors, key).groupBy("feature").agg(*sums)
        curvature = F.col("mass") / (2.0 * RESIDUAL) + rule.l2

        def moved(i: int) -> Column:
            slope = F.col(f"g_{i}").cast("double") / RESIDUAL + F.col(f"w_{i}") * (rule.l2 / WEIGHT)
            return (F.col(f"w_{i}") - _whole(slope / curvature * WEIGHT)).alias(f"w_{i}")

        following = state.join(gradient.hint("shuffle_hash"), "feature").select("feature", "total", "mass", *[moved(i) for i in range(k)])
        state = materialize_by(following, "feature", n, dealt=True)
    return state


def softmax_scores(df: DataFrame, model: Softmax, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, label, score)``: the class of largest probability, the first one of equals, and that probability.

    A document without known features but the bias is judged by the bias alone.
    """
    k = len(model.classes)
    if isinstance(model.features, WordIds):
        sums = weight_sums(df, model.weights, _weights(k), model.features, [key], text)
        margins = sums.select(key, F.col("_n").alias("n"), *[F.col(w).alias(f"z_{i}") for i, w in enumerate(_weights(k))])
    else:
        margins = _margins(_bags(df.select(key, text), model.features, text, key), model.weights, k, [key])
    masses = _masses(k)
    zs = [F.col(f"z_{i}") for i in range(k)]
    label = F.coalesce(*[F.when(z == F.greatest(*zs), c) for z, c in zip(zs, model.classes)])
    return margins.select(key, label.alias("label"), F.round(F.lit(1.0) / sum(masses[1:], masses[0]), 6).alias("score"))
