"""From labelled pages to a quality classifier: select, balance, split, train, evaluate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.functions import html
from siftwork.functions import text as T
from siftwork.operators import classifiers as C
from siftwork.operators import language as L
from siftwork.operators import reports, rules, sampling
from siftwork.session import materialize

POSITIVE, NEGATIVE = "wiki", "cc"
MIN_CLEAN_SCORE = 0.7


def response_reason(status: Column, content_type: Column) -> Column:
    """Why a crawl response is not used: ``no_http_headers``, ``http_<status>``, ``non_html``, or null."""
    return (
        F.when(status.isNull(), "no_http_headers")
        .when(status != 200, F.concat(F.lit("http_"), status.cast("string")))
        .when(~F.contains(F.lower(F.coalesce(content_type, F.lit(""))), F.lit("text/html")), "non_html")
    )


def is_confidently_clean(label: Column, score: Column, harmful: str) -> Column:
    """Neither harmful at any score nor clean with a low score."""
    return (label != harmful) & (score >= MIN_CLEAN_SCORE)


def responses_to_texts(responses: DataFrame) -> DataFrame:
    """``reason``, ``error`` and ``text`` (flattened page text) in place of status, content type and body of crawl responses.

    A response that cannot be read has the reason ``errors`` and a message; it never fails the job.
    """
    with_reason = responses.withColumn("reason", response_reason(F.col("status"), F.col("content_type")))
    usable = F.col("reason").isNull()
    decoded = with_reason.withColumn("_page", html.try_decode_html(F.when(usable, F.col("body"))))
    error = F.when(usable & F.col("body").isNull(), "no body").otherwise(F.col("_page.error"))
    read = decoded.withColumn("error", error).withColumn("text", T.flatten_ws(html.extract_text(F.col("_page.text"))))
    reason = F.coalesce("reason", F.when(F.col("error").isNotNull(), "errors"), F.when(F.col("text") == "", "empty"))
    return read.withColumn("reason", reason).drop("_page", "status", "content_type", "body")


@dataclass(frozen=True)
class Quarantined:
    """Rows read in one pass and stored: those without a ``reason``, those with one, and counters over both."""

    good: DataFrame
    bad: DataFrame
    counters: DataFrame


def quarantine(rows: DataFrame, *keys: str) -> Quarantined:
    """Split rows with a ``reason`` column. The counters have a row per reason, ``seen`` for all rows and ``kept`` for the good."""
    stored = materialize(rows)
    counted = stored.withColumn("reason", F.explode(F.array(F.lit("seen"), F.coalesce("reason", F.lit("kept")))))
    return Quarantined(stored.where("reason IS NULL").drop("reason", "error"), stored.where("reason IS NOT NULL"), reports.reason_counts(counted, *keys))


def examples_of_responses(
    responses: DataFrame, languages: L.LanguageModel, harm: DataFrame, harm_heads: tuple[C.Head, ...], key: str, label: str = "label"
) -> tuple[DataFrame, DataFrame]:
    """``(key, label, reason)`` of all responses, and ``(key, text)`` of those that hold a page; pages are read once."""
    pages = quarantine(responses_to_texts(responses), label)
    chosen = select_examples(pages.good, languages, harm, harm_heads, key, label)
    return chosen.unionByName(pages.bad.select(key, label, "reason")), pages.good.select(key, "text")


def build_statistics(examples: DataFrame, label: str = "label") -> DataFrame:
    """``(label, reason, n)`` of all examples: how many were ``seen``, why they were not used, and how many were ``kept``."""
    counted = examples.withColumn("reason", F.explode(F.array(F.lit("seen"), F.coalesce("reason", F.lit("kept")))))
    return reports.reason_counts(counted, label)


def select_examples(
    docs: DataFrame,
    languages: L.LanguageModel,
    harm: DataFrame,
    harm_heads: tuple[C.Head, ...],
    key: str = "doc_id",
    label: str = "label",
    text: str = "text",
) -> DataFrame:
    """``(key, label, reason)`` of labelled documents; null reason = usable example.

    All must be English. Positive examples must also pass the quality rules and be confidently free of harm. Only
    narrow verdict tables are joined.
    """
    flat = docs.select(key, label, T.flatten_ws(F.col(text)).alias("_flattened"))
    flat = flat.withColumn("_is_empty", F.col("_flattened") == "")
    measured = rules.with_rule_measures(flat, "_flattened", "_flattened", F.col(label) == POSITIVE)
    verdict = measured.select(key, label, F.col("_is_empty").alias("_empty"), rules.failed_rule().isNotNull().alias("_fails"))
    spoken = L.identify(flat, languages, key, "_flattened")
    harmless = C.scores(flat.where(F.col(label) == POSITIVE), harm, harm_heads, C.WORDS, key, "_flattened")
    joined = verdict.join(spoken.withColumnsRenamed({"label": "_lang", "score": "_lang_score"}), key).join(
        harmless, key, "left"
    )
    reason = (
        F.when(F.col("_empty"), "empty")
        .when(~L.is_confident_english(F.col("_lang"), F.col("_lang_score")), "non_english")
        .when((F.col(label) == POSITIVE) & F.col("_fails"), "gopher_rejected")
    )
    for head in harm_heads:
        clean = is_confidently_clean(F.col(f"{head.label}_label"), F.col(f"{head.label}_score"), head.classes[1])
        reason = reason.when((F.col(label) == POSITIVE) & ~clean, f"{head.label}_rejected")
    return joined.select(key, label, reason.alias("reason"))


def build_set(examples: DataFrame, key: str = "doc_id", label: str = "label", cap: int = 3000) -> DataFrame:
    """Balanced classes, shuffled, 90 % ``train`` and 10 % ``valid``: ``(key, label, split)``."""
    usable = examples.where("reason is null").select(key, label)
    return sampling.split_examples(sampling.balance_classes(usable, key, label, (POSITIVE, NEGATIVE), cap), key)


def labelled_lines(examples: DataFrame, docs: DataFrame, key: str = "doc_id", label: str = "label", text: str = "text") -> DataFrame:
    """``__label__<label> <text>`` per example. The balanced set is bounded by its cap, so it is broadcast."""
    joined = docs.select(key, text).join(F.broadcast(examples), key)  # at most the cap of each class
    line = F.concat(F.lit("__label__"), F.col(label), F.lit(" "), T.flatten_ws(F.col(text)))
    return joined.select(key, "split", line.alias("line"))


def train_and_evaluate(examples: DataFrame, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on the training split, report precision and recall on the validation split."""
    texts = docs.select(key, T.flatten_ws(F.col(text)).alias("text")).join(
        F.broadcast(examples.withColumnRenamed("label", "quality")), key
    )
    model = C.train(texts.where("split = 'train'"), (C.QUALITY,), C.WORDS)
    valid = texts.where("split = 'valid'")
    predicted = C.scores(valid, model, (C.QUALITY,), C.WORDS, key)
    return C.evaluate(predicted.join(valid.select(key, "quality"), key), "quality", "quality_label")
