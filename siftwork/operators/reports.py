"""Counters, rates, funnels and studies over judged documents.

Judged documents have one row per document with ``source``, ``reason`` (null = kept), ``n_email``, ``n_phone`` and
``n_ip``; none of the reports touches text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.operators.rules import REASONS

LENGTH_REASONS = ("empty", "too_short", "too_long")
#: Stages of the funnel, in order, with the reasons they produce.
STAGES = (
    ("length", LENGTH_REASONS),
    ("rules", ("gopher",)),
    ("quality", ("low_quality",)),
    ("nsfw", ("nsfw",)),
    ("toxic", ("toxic",)),
)


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.when(whole > 0, 100 * part / whole).otherwise(F.lit(0.0)), 6)


def _ratio(part: Column, whole: Column) -> Column:
    return F.round(F.when(whole > 0, part / whole).otherwise(F.lit(0.0)), 6)


#: A kept document and its number of masked places, for the counters below.
_KEPT, _HITS = "reason IS NULL", "(n_email + n_phone + n_ip)"
COUNTERS = (
    "count(1) AS total",
    f"count_if({_KEPT}) AS kept",
    *[f"count_if(reason <=> '{r}') AS rejected_{r}" for r in REASONS],
    *[
        f"cast(coalesce(sum(if({_KEPT}, {column}, 0)), 0) AS bigint) AS {name}"
        for column, name in (("n_email", "masked_emails"), ("n_phone", "masked_phone_numbers"), ("n_ip", "masked_ips"))
    ],
    f"count_if({_KEPT} AND {_HITS} > 0) AS modified_pii_documents",
)


def _counters() -> list[Column]:
    return [F.expr(c) for c in COUNTERS]


def filter_report(judged: DataFrame) -> DataFrame:
    """One row of totals with the keep ratio."""
    return judged.agg(*_counters()).withColumn("keep_ratio", _ratio(F.col("kept"), F.col("total")))


def filter_report_by_source(judged: DataFrame, source: str = "source") -> DataFrame:
    """Totals (``source`` = ``ALL``) and one row per source from a single aggregation."""
    return (
        judged.withColumn("_source", F.col(source))
        .rollup("_source")
        .agg(F.grouping("_source").alias("_all"), *_counters())
        .withColumn(source, F.when(F.col("_all") == 1, "ALL").otherwise(F.col("_source")))
        .withColumn("keep_ratio", _ratio(F.col("kept"), F.col("total")))
        .drop("_source", "_all")
    )


def source_counters(judged: DataFrame, source: str = "source") -> DataFrame:
    """The counters per source, without totals or ratios: rows of several runs can be added up."""
    return judged.groupBy(source).agg(*_counters())


def merged_report(counters: DataFrame, source: str = "source") -> DataFrame:
    """The report by source from counters of any number of runs; the same as of one run over all their documents."""
    names = [c for c in counters.columns if c != source]
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]
    return (
        counters.withColumn("_source", F.col(source))
        .rollup("_source")
        .agg(F.grouping("_source").alias("_all"), *sums)
        .withColumn(source, F.when(F.col("_all") == 1, "ALL").otherwise(F.col("_source")))
        .withColumn("keep_ratio", _ratio(F.col("kept"), F.col("total")))
        .drop("_source", "_all")
    )


def filter_funnel(judged: DataFrame) -> DataFrame:
    """stage_no, stage, removed, remaining and the share of all removals, in pipeline order."""
    removed = [F.count_if(F.col("reason").isin(*reasons)).alias(name) for name, reasons in STAGES]
    totals = judged.agg(F.count(F.lit(1)).alias("_total"), F.count_if(F.col("reason").isNotNull()).alias("_all"), *removed)
    rows, remaining = [], F.col("_total")
    for number, (name, _) in enumerate(STAGES, 1):
        remaining = remaining - F.col(name)
        rows.append(
            F.struct(
                F.lit(number).alias("stage_no"),
                F.lit(name).alias("stage"),
                F.col(name).alias("removed"),
                remaining.alias("remaining"),
                _ratio(F.col(name), F.col("_all")).alias("share"),
            )
        )
    return totals.select(F.inline(F.array(*rows)))


def baseline_vs_final(judged: DataFrame) -> DataFrame:
    """Kept documents with the length rule alone and with all filters."""
    totals = judged.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~F.coalesce(F.col("reason").isin(*LENGTH_REASONS), F.lit(False))).alias("baseline"),
        F.count_if(F.col("reason").isNull()).alias("final"),
    )
    rows = [
        F.struct(
            F.lit(name).alias("version"),
            F.col("total").alias("total"),
            F.col(name).alias("kept"),
            _ratio(F.col(name), F.col("total")).alias("keep_ratio"),
        )
        for name in ("baseline", "final")
    ]
    return totals.select(F.inline(F.array(*rows)))


def kept_text_share(df: DataFrame, n_chars: Column, kept: Column) -> DataFrame:
    """Characters in total, characters kept, and 100 * kept / total (0 for no text)."""
    totals = df.agg(
        F.coalesce(F.sum(n_chars), F.lit(0)).alias("total_chars"),
        F.coalesce(F.sum(F.when(kept, n_chars)), F.lit(0)).alias("kept_chars"),
    )
    return totals.withColumn("kept_percent", percent(F.col("kept_chars"), F.col("total_chars")))


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(truth, predicted, n): distribution of predictions per true label."""
    return df.groupBy(truth, predicted).agg(F.count(F.lit(1)).alias("n"))


def threshold_curve(df: DataFrame, score: Column, right: Column, buckets: int = 20) -> DataFrame:
    """Right and wrong predictions per score bucket ``[i / buckets, (i + 1) / buckets)``; score 1 is in the last."""
    bucket = F.least(F.floor(score * buckets), F.lit(buckets - 1)).cast("int")
    return (
        df.withColumn("bucket", bucket)
        .groupBy("bucket")
        .agg(F.count_if(right).alias("n_right"), F.count_if(~right).alias("n_wrong"))
        .withColumn("from_score", F.round(F.col("bucket") / buckets, 6))
    )


def reason_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Number of documents per reason (and per further keys)."""
    return df.groupBy(*keys, "reason").agg(F.count(F.lit(1)).alias("n"))
