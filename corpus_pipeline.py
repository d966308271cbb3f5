"""A corpus pipeline of five stages over ``documents``, each written and read again before the next.

Every stage takes ``(spark, docs, sf_dir)`` and works on all documents its predecessor kept; all but the last return the
columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.llm import decontamination, mixing, ngram_join, secret_scan, toxicity
from siftwork.llm.queries import MIX, label_domains
from siftwork.llm.tables import read_texts, saved, small_side, unused


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7, trained on all labels: documents with a score of 0.5 or more go."""
    model = toxicity.train(read_texts(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = unused(docs, "toxicity")
    scored = toxicity.with_score(docs, model, "text", name)
    return scored.where(F.col(name) < 0.5).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of each class of near copies the document with the least id stays."""
    return ngram_join.keep_first(docs).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents with a window of a benchmark item go."""
    found = decontamination.report(docs.select("doc_id", "text"), read_texts(spark, sf_dir, "benchmark", "item_id"))
    leaked = saved(found.where("contaminated").select("doc_id"), "leaked")
    return docs.join(small_side(leaked), "doc_id", "left_anti").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: values of secrets are masked, and ``n_chars`` follows the text."""
    new = unused(docs, "masked")
    masked = docs.withColumn(new, secret_scan.redacted(F.coalesce("text", F.lit(""))))
    changed = F.col(new) != F.coalesce("text", F.lit(""))
    return masked.select(
        *[
            F.when(changed, F.col(new)).otherwise(F.col("text")).alias("text") if c == "text"
            else F.when(changed, F.length(new)).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
            else F.col(c)
            for c in docs.columns
        ]
    )


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: tokens, domain memberships and the rate at which to take each document; those with rate 0 go."""
    return mixing.mixed(docs, label_domains(spark, sf_dir), MIX).where("rate > 0")


STAGES = [
    ("toxicity", drop_toxic), ("ngram_join", drop_near_copies), ("decontamination", drop_contaminated),
    ("secret_scan", mask_secrets), ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


#: Two stages fit classifiers, which SQL cannot repeat; the stages are tested against brute force instead.
ORACLE_SQL = None
