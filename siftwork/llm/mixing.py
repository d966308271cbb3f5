"""Mixing documents to target domain weights.

A classifier fitted on a labelled table (a bounded sample of it, ``MOST_ROWS``) gives each document soft memberships, its
posteriors over the domains. A document of ``n`` tokens taken at the rate ``r`` adds ``r * n * p_k`` expected tokens to
domain ``k``. The rates are the non-negative least-squares solution of "expected tokens of each domain = target", found
by projected gradient steps from rate 1: each step sums the domains' tokens over all documents, and moves every rate
along its memberships, scaled by the inverse of the domains' Gram matrix of the documents whose rate is not 0, then
clips it at 0. Only sums of the size of the domains reach the driver. The rate of a document follows from its memberships
and the steps, so no rates are stored between steps, and any table with memberships can be given rates later.

Defined results: a null or empty text has no tokens, but memberships and a rate like any other; equal texts get equal
rates; with no labels every membership is uniform; targets that cannot be met with non-negative rates are met as closely as
possible in the least-squares sense.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.llm.batches import with_text_columns
from siftwork.llm.quality import labelled_sample
from siftwork.llm.statistics import LETTERS, NAMES, Statistics
from siftwork.llm.tables import saved

#: Labelled rows the classifier is fitted on, at most; their statistics are collected.
MOST_ROWS = 10_000
WIDTH = len(NAMES) + LETTERS


@dataclass(frozen=True)
class DomainModel:
    """Softmax over standardised statistics."""

    domains: tuple[str, ...]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # (statistics + 1, domains)


def fit_domains(rows: np.ndarray, labels: np.ndarray, domains: list[str], steps: int = 300, rate: float = 0.2, decay: float = 1e-3) -> DomainModel:
    """Softmax regression by Adam; ``labels`` are places in ``domains``."""
    k, n = len(domains), len(rows)
    mean = rows.mean(axis=0) if n else np.zeros(WIDTH)
    scale = rows.std(axis=0) + 1e-6 if n else np.ones(WIDTH)
    x = np.column_stack([np.clip((rows - mean) / scale, -8, 8), np.ones(n)])
    w = np.zeros((x.shape[1], k))
    if n:
        w[-1] = np.log((np.bincount(labels, minlength=k) + 1) / (n + k))
    hot, m, v = np.eye(k)[labels], np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1 if n else 1):
        z = x @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        gradient = x.T @ (p - hot) / n + decay * np.vstack([w[:-1], np.zeros(k)])
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        w -= rate * 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return DomainModel(tuple(domains), mean, scale, w)


def train_domains(docs: DataFrame, labelled: DataFrame, domains: list[str], key: str = "doc_id", text: str = "text", domain: str = "domain") -> DomainModel:
    """Fit on a bounded sample of the labelled table (``key``, ``domain``); rows with other domains are left out."""
    known = labelled.select(key, F.col(domain).alias("_domain")).where(F.col("_domain").isin(list(domains)))
    sample = labelled_sample(known, key, MOST_ROWS)
    texts = docs.select(key, F.col(text).alias("_text")).join(F.broadcast(sample), key)

    def make():
        compute = Statistics()
        return lambda data, offsets: [
            pa.FixedSizeListArray.from_arrays(pa.array(compute(data, offsets, letters=True).ravel()), WIDTH).cast(pa.list_(pa.float32()))
        ]

    table = with_text_columns(texts, "_text", make, "_features array<float>").select(key, "_domain", "_features").toArrow()
    order = np.argsort(table[key].to_numpy(), kind="stable")
    rows = np.array(table["_features"].combine_chunks().flatten().to_numpy(zero_copy_only=False), np.float64).reshape(table.num_rows, WIDTH)[order]
    places = {d: i for i, d in enumerate(domains)}
    labels = np.array([places[d] for d in table["_domain"].to_pylist()], np.int64)[order]
    return fit_domains(rows, labels, list(domains))


def with_memberships(df: DataFrame, model: DomainModel, text: str = "text") -> DataFrame:
    """``df`` with ``n_tokens`` (words) and ``p_0 … p_k``, the posteriors of the model's domains."""
    k = len(model.domains)

    def make():
        compute = Statistics()

        def run(data, offsets):
            rows = compute(data, offsets, letters=True).astype(np.float64)
            x = np.column_stack([np.clip((rows - model.mean) / model.scale, -8, 8), np.ones(len(rows))])
            z = x @ model.weights
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            words = np.rint(np.expm1(rows[:, NAMES.index("log_words")])).astype(np.int64)
            return [words, *p.T]

        return run

    fields = "n_tokens bigint, " + ", ".join(f"p_{i} double" for i in range(k))
    return with_text_columns(df, text, make, fields)


def rate_after(steps: list[np.ndarray], k: int) -> Column:
    """The rate of a row with ``p_0 … p_k`` after the steps, starting from 1 and clipped at 0 each time."""
    rate: Column = F.lit(1.0)
    for step in steps:
        moved = sum((F.col(f"p_{i}") * float(step[i]) for i in range(k)), F.lit(0.0))
        rate = F.greatest(F.lit(0.0), rate - moved)
    return rate


def fit_rates(memberships: DataFrame, targets: np.ndarray, most_steps: int = 25, tolerance: float = 1e-6) -> list[np.ndarray]:
    """Steps whose rates bring the domains' expected tokens to ``targets`` (tokens per domain)."""
    k = len(targets)
    steps: list[np.ndarray] = []
    best, best_error = [], np.inf
    p = [F.col(f"p_{i}") for i in range(k)]
    size = max(float(np.abs(targets).sum()), 1.0)
    for _ in range(most_steps):
        rows = memberships.withColumn("_rate", rate_after(steps, k))
        moving = F.when(F.col("_rate") > 0, F.col("n_tokens")).otherwise(F.lit(0))
        sums = [F.sum(F.col("_rate") * F.col("n_tokens") * p[i]).alias(f"t{i}") for i in range(k)]
        gram = [F.sum(moving * p[i] * p[j]).alias(f"g{i}_{j}") for i in range(k) for j in range(i, k)]
        found = rows.agg(*sums, *gram).first()
        missing = np.array([found[f"t{i}"] or 0.0 for i in range(k)]) - targets
        error = float(np.abs(missing).sum()) / size
        if error < best_error:
            best, best_error = list(steps), error
        if error < tolerance:
            break
        g = np.zeros((k, k))
        for i in range(k):
            for j in range(i, k):
                g[i, j] = g[j, i] = found[f"g{i}_{j}"] or 0.0
        steps.append(np.linalg.solve(g + np.eye(k) * max(1e-9 * np.trace(g), 1e-9), missing))
    return best


def mixed(
    docs: DataFrame, labelled: DataFrame, weights: dict[str, float], key: str = "doc_id", text: str = "text",
    domain: str = "domain",
) -> DataFrame:
    """``docs`` with ``n_tokens``, the posteriors ``p_0 …`` in the order of ``weights``, and ``rate``.

    The target of a domain is its share of ``weights`` of all tokens of ``docs``. The texts are read to store memberships,
    which all steps use, and once more for the result.
    """
    if not weights or min(weights.values()) < 0 or sum(weights.values()) <= 0:
        raise ValueError(f"weights must be non-negative and not all zero: {weights}")
    model = train_domains(docs, labelled, list(weights), key, text, domain)
    narrow = with_memberships(docs.select(F.col(text).alias("text")), model).drop("text")
    stored = saved(narrow, "memberships")
    tokens = stored.agg(F.sum("n_tokens")).first()[0] or 0
    shares = np.array(list(weights.values()), float) / sum(weights.values())
    steps = fit_rates(stored, shares * tokens)
    return with_memberships(docs, model, text).withColumn("rate", rate_after(steps, len(weights)))
