"""English pre-filter of crawl documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.operators import language as L
from siftwork.operators import reports
from siftwork.session import materialize
from siftwork.sources.tables import spread
from siftwork.sources.warc import read_wet


def english_documents(docs: DataFrame, model: L.LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents identified as English with a score of at least 0.7."""
    found = L.identify(docs, model, key, text)
    english = found.where(L.is_confident_english(F.col("label"), F.col("score"))).select(key)
    return docs.join(english.hint("shuffle_hash"), key, "left_semi")


def filter_crawl(spark: SparkSession, path: str, model: L.LanguageModel, output: str) -> DataFrame:
    """Write the English records of WET files as Parquet and return the share of text kept.

    The archive is unpacked once, into a stored table that the verdicts and the output are made from. Records without an id
    are named by file and place, so the id serves as key. Few gzip files are spread over the cluster.
    """
    docs = materialize(spread(read_wet(spark, path)))
    found = materialize(L.identify(docs, model, "record_id"))
    english = L.is_confident_english(F.col("label"), F.col("score"))
    docs.join(found.where(english).select("record_id").hint("shuffle_hash"), "record_id", "left_semi").write.mode("overwrite").parquet(output)
    sized = docs.select("record_id", F.length("text").alias("n")).join(found, "record_id")
    return reports.kept_text_share(sized, F.col("n"), english)
