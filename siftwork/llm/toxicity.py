"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts and unlabelled texts train a linear classifier on the presence of words. The risk of the unlabelled
texts is corrected by the class prior, ``prior * R+(toxic) + max(0, R-(unlabelled) - prior * R-(toxic))``: unlabelled
text holds toxic text too, and where the corrected part turns negative, the step works against it instead of overfitting.

Training uses a bounded sample, ``MOST_ROWS`` labelled rows by order of a hash: the toxic ones are the confirmed ones, and
all of them together are the unlabelled ones, whose labels are used for nothing but the prior. Features are words and
beginnings of words, hashed into ``SLOTS`` weights. In how many texts a feature occurs is counted in Spark; it gets a
weight if its share of toxic texts differs from its share of all by ``SIGMAS`` standard errors. Only these features are
collected for the numpy fit. Scoring reads whole texts and needs no shuffle.

Defined results: null and empty texts have no words and the score of the intercept; a word counts once, however often a
text repeats it; without confirmed examples every score is the smoothed prior.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwork.llm.batches import WordReader, list_array, views, with_text_columns
from siftwork.llm.quality import labelled_sample
from siftwork.llm.tables import saved

#: Labelled rows that training reads, at most.
MOST_ROWS = 20_000
SLOTS = 1 << 22
#: Lengths in bytes of the beginnings of words that are features.
BEGINNINGS = (4, 5, 6, 7, 8)
SIGMAS = 4.0
LEAST_TEXTS = 3


@dataclass(frozen=True)
class Model:
    intercept: float
    slots: np.ndarray
    weights: np.ndarray


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Presence:
    """Distinct word slots of each document of a view, of those in ``wanted`` (all if None)."""

    def __init__(self, wanted: np.ndarray | None = None):
        self.read, self.wanted = WordReader(), wanted

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words = self.read(data, offsets)
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(words.of))
        found = []
        for length in (0, *BEGINNINGS):
            place, hashes = words.prefixes(length) if length else (np.arange(len(owner)), words.hashes)
            slots = ((hashes + np.uint64(length * 0x51ED27)) & np.uint64(SLOTS - 1)).astype(np.int64)
            if self.wanted is not None:
                kept = self.wanted[slots]
                slots, place = slots[kept], place[kept]
            found.append(owner[place] * SLOTS + slots)
        both = np.unique(np.concatenate(found))
        return both % SLOTS, np.searchsorted(both // SLOTS, np.arange(len(offsets)))


def fit(
    column: np.ndarray, starts: np.ndarray, toxic: np.ndarray, width: int, steps: int = 400, rate: float = 0.1,
    decay: float = 1e-4,
) -> tuple[float, np.ndarray]:
    """Intercept and weights from documents given as feature columns and the places where each document's start."""
    n, n_toxic = len(toxic), int(toxic.sum())
    prior = (n_toxic + 1) / (n + 2)
    w, b = np.zeros(width), float(np.log(prior / (1 - prior)))
    if n_toxic == 0 or n_toxic == n:
        return b, w
    row = np.repeat(np.arange(n), np.diff(starts))
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        z = b + np.bincount(row, w[column], n)
        p = _sigmoid(z)
        negative = np.logaddexp(0, z)  # loss of calling a text clean
        clean_risk = negative.mean() - prior * negative[toxic].mean()
        g = np.where(toxic, -prior * p / n_toxic, 0) + p / n  # gradient of the corrected risk of the unlabelled
        if clean_risk < 0:
            g = -g
        else:
            g = g + np.where(toxic, prior * (p - 1) / n_toxic, 0)
        gradient = np.append(np.bincount(column, g[row], width) + decay * w, g.sum())
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        change = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - change[:-1], b - change[-1]
    return float(b), w


def _feature_counts(texts: DataFrame) -> DataFrame:
    """``(slot, in_all, in_toxic)``: texts that have a feature, counted in each batch before the shuffle."""

    def run(batches):
        compute = Presence()
        for batch in batches:
            toxic = batch.column("_y").to_numpy(zero_copy_only=False) == 1
            for first, end, data, offsets in views(batch.column("_text")):
                slots, starts = compute(data, offsets)
                of_toxic = np.repeat(toxic[first:end], np.diff(starts))
                names, place = np.unique(slots, return_inverse=True)
                counts = np.bincount(place, minlength=len(names)), np.bincount(place[of_toxic], minlength=len(names))
                yield pa.RecordBatch.from_arrays([pa.array(names), *map(pa.array, counts)], names=["slot", "all", "toxic"])

    counted = texts.mapInArrow(run, "slot bigint, all bigint, toxic bigint")
    return counted.groupBy("slot").agg(F.sum("all").alias("in_all"), F.sum("toxic").alias("in_toxic"))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fit on a sample of ``labels`` (``key``, ``label``). The sample is bounded, so it may be broadcast to the texts."""
    sample = labelled_sample(labels.select(key, F.col(label).alias("_y")).where(F.col(label).isNotNull()), key, MOST_ROWS)
    texts = docs.select(key, F.coalesce(text, F.lit("")).alias("_text")).join(F.broadcast(sample), key)
    texts = saved(texts.select(key, "_text", "_y"), "toxicity-sample")
    sizes = texts.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("_y") == 1).cast("int")).alias("toxic")).first()
    n, n_toxic = sizes["n"], sizes["toxic"] or 0
    names = np.zeros(0, np.int64)
    if 0 < n_toxic < n:
        share = F.col("in_all") / n
        error = F.sqrt(F.greatest(share * (1 - share), F.lit(1 / n)) / n_toxic)
        differs = (F.abs(F.col("in_toxic") / n_toxic - share) >= SIGMAS * error) & (F.col("in_all") >= LEAST_TEXTS)
        names = np.sort(_feature_counts(texts).where(differs).select("slot").toArrow()["slot"].to_numpy())

    def make():
        wanted = np.zeros(SLOTS, bool)
        wanted[names] = True
        compute = Presence(wanted)
        return lambda data, offsets: [list_array(*(a.astype(np.int32) for a in compute(data, offsets)))]

    table = with_text_columns(texts, "_text", make, "_slots array<int>").select(key, "_y", "_slots").toArrow()
    order = np.argsort(table[key].to_numpy(), kind="stable")  # the same rows give the same model
    lists = table["_slots"].combine_chunks().take(pa.array(order))
    slots = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    intercept, w = fit(np.searchsorted(names, slots), starts, table["_y"].to_numpy()[order] == 1, len(names))
    return Model(intercept, names, w)


def with_score(df: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``df`` with the probability that a text is toxic."""

    def make():
        weights = np.zeros(SLOTS, np.float32)
        weights[model.slots] = model.weights
        compute = Presence(weights != 0)

        def run(data, offsets):
            slots, starts = compute(data, offsets)
            total = np.concatenate([[0.0], np.cumsum(weights[slots], dtype=np.float64)])
            return [_sigmoid(model.intercept + total[starts[1:]] - total[starts[:-1]])]

        return run

    return with_text_columns(df, text, make, f"{name} double")
