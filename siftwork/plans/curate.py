"""Curation of a corpus: reject by rules and classifiers, mask personal data, describe what is kept."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwork.functions import text as T
from siftwork.functions.pii import with_masked
from siftwork.operators import classifiers as C
from siftwork.operators import domains, rules


@dataclass(frozen=True)
class Models:
    """A trained table and the heads it holds. Without an ``nsfw`` head that stage rejects nothing."""

    table: DataFrame
    heads: tuple[C.Head, ...]

    def label(self, name: str):
        return F.col(f"{name}_label") if any(h.label == name for h in self.heads) else None


def screened(docs: DataFrame, text: str = "text", flat_text: str | None = None) -> DataFrame:
    """Adds ``stripped`` and the ``reason`` given by the length and quality rules."""
    return rules.with_rule_reason(docs.withColumn("stripped", T.strip(F.col(text))), flat_text=flat_text)


def judge(
    docs: DataFrame, models: Models, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), counts: bool = True
) -> DataFrame:
    """``(key, *keep, reason, n_email, n_phone, n_ip)`` without text: what the reports need.

    One scan and one shuffle of a few numbers per document. Rules, masking counts and feature extraction run in
    the scan task; later and dearer steps see only texts that passed the earlier ones. Without ``counts``, nothing is masked.
    """
    found = screened(docs.select(key, *keep, text), text, "_flat").withColumnRenamed("reason", "_rule")
    masked = ["n_email", "n_phone", "n_ip"] if counts else []
    if counts:
        found = found.withColumn("_passed", F.when(F.col("_rule").isNull(), F.col("stripped")))
        found = with_masked(found, "_passed", "_masked_text")
    small = [key, *keep, "_rule", *masked]
    sums = C.score_sums(found, models.table, models.heads, C.FLAT_WORDS, small, "_flat", F.col("_rule").isNull())
    judged = sums.select(*small, *C.verdicts(models.heads))
    reason = rules.final_reason(F.col("_rule"), models.label("quality"), models.label("nsfw"), models.label("toxic"))
    return judged.select(key, *keep, reason.alias("reason"), *masked)


def rejected(docs: DataFrame, judged: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rejected documents with their ``rejection_reason``."""
    named = judged.where("reason is not null").select(key, F.col("reason").alias("rejection_reason"))
    return docs.join(named.hint("shuffle_hash"), key)


def mask_kept(docs: DataFrame, text: str = "text") -> DataFrame:
    """Masks the stripped text in place and counts its words after masking."""
    masked = with_masked(docs.withColumn("_stripped", T.strip(F.col(text))), "_stripped", "_masked")
    return (
        masked.withColumn(text, F.col("_masked"))
        .withColumn("word_count", T.word_count(F.col(text)))
        .drop("_stripped", "_masked")
    )


def curate(
    docs: DataFrame, models: Models | None, key: str = "doc_id", text: str = "text", judged: DataFrame | None = None,
    suffixes: domains.Suffixes | None = None,
) -> DataFrame:
    """The kept documents, masked, with ``word_count`` and (if there is a ``url``) ``domain`` by the rules of ``suffixes``.

    The verdicts are a narrow table; the text is shuffled once, to meet them, with a hash join that does not sort it. Masking
    runs on kept documents only. Pass ``judged`` to share verdicts with the reports.
    """
    if judged is None:
        judged = judge(docs, models, key, text, counts=False)
    kept = judged.where("reason is null").select(key)
    result = mask_kept(docs.join(kept.hint("shuffle_hash"), key, "left_semi"), text)
    if "url" in docs.columns:
        result = domains.with_registered_domain(result, suffixes or domains.suffixes(docs.sparkSession))
    return result


def curated_record(df: DataFrame) -> DataFrame:
    """Columns of a curated crawl document, in the order they are published."""
    return df.select("url", "domain", "date", "record_id", "word_count", "text")
