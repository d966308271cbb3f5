"""One query per operator of this subpackage, over whole tables, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.llm import (
    chat, decontamination, fingerprints, languages, mixing, ngram_join, passages, quality, secret_scan, spelling, sql,
    suffix_index, toxicity, vector_codes,
)
from siftwork.llm.tables import read_texts

Query = Callable[[SparkSession, str], DataFrame]


def op1_passages(spark: SparkSession, sf: str) -> DataFrame:
    """Class of every document by passages of 50 words and more that it shares with others."""
    return passages.classes(read_texts(spark, sf))


def op2_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are."""
    paired = fingerprints.with_next(
        read_texts(spark, sf), "doc_id", ["text", "lanes"], prepare=lambda rows: fingerprints.with_fingerprint(rows, "text", "lanes")
    )
    n, half = F.length("text"), F.floor(F.length("text") / 2)
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = paired.select(
        "doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "lanes", "next_lanes"
    )
    rows = fingerprints.with_fingerprint(rows, "edited", "edited_lanes")
    rows = fingerprints.with_likeness(rows, "lanes", "edited_lanes", "near_edited")
    rows = fingerprints.with_likeness(rows, "lanes", "next_lanes", "near_next")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.text_of(F.col("lanes")).alias("fingerprint"),
        fingerprints.text_of(F.col("edited_lanes")).alias("edited_fingerprint"), "near_edited", "near_next",
    )


#: Shares of all tokens that the mix of op3 aims at: good text by language, and text of low quality.
MIX = {"en": 0.5, "de": 0.18, "fr": 0.18, "es": 0.12, "poor": 0.02}


def label_domains(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, domain)`` of the labelled documents: ``poor``, or else the language."""
    languages = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    domain = F.when(F.col("quality") == 0, "poor").otherwise(F.col("lang"))
    return labels.join(languages, "doc_id").select("doc_id", domain.alias("domain"))


def op3_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Rates of all documents that bring the expected domain tokens to ``MIX``."""
    return mixing.mixed(read_texts(spark, sf), label_domains(spark, sf), MIX).drop("text")


def op4_chat(spark: SparkSession, sf: str) -> DataFrame:
    """All conversations and one whose texts hold control strings, formatted and read back."""
    turns = spark.read.parquet(f"{sf}/conversations.parquet").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    )
    hard = r"\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], turns.schema)
    return chat.read_back(chat.format_turns(turns.unionByName(probe)))


def op5_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality scores of every text; a third of the labels is held out."""
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    learned = labels.where(~quality.held_out(F.col("doc_id"), 3, 1))
    return _predicted(quality.classify(read_texts(spark, sf), learned), 3, 1)


def _predicted(scored: DataFrame, parts: int, part: int) -> DataFrame:
    return scored.select(
        "doc_id", quality.held_out(F.col("doc_id"), parts, part).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op6_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Which words of every document belong to a window of a benchmark item."""
    found = decontamination.report(read_texts(spark, sf), read_texts(spark, sf, "benchmark", "item_id"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op7_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity scores of every text; a fifth of the labels is held out."""
    docs = read_texts(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").where(~quality.held_out(F.col("doc_id"), 5, 0))
    return _predicted(toxicity.with_score(docs, toxicity.train(docs, labels)), 5, 0)


def op8_secrets(spark: SparkSession, sf: str) -> DataFrame:
    """Spans of secrets in every text."""
    found = secret_scan.with_spans(read_texts(spark, sf))
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secret_scan.listed("assign", "access", "hex"), 256).alias("base_sha256"),
        secret_scan.listed("assign", "access", "hex", "entropy").alias("spans"),
    )


def op9_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of every text without the byte strings that repeat."""
    return suffix_index.removed_digests(read_texts(spark, sf))


def op10_ngram_join(spark: SparkSession, sf: str) -> DataFrame:
    """Class of every document by similar word 5-gram sets, and its verified links."""
    return ngram_join.classes(read_texts(spark, sf))


def op11_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every text; a quarter of the documents is held out."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    held = quality.held_out(F.col("doc_id"), 4, 2)
    model = languages.train(docs.where(~held))
    return languages.with_language(docs.drop("lang"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


#: One word occurrence in so many gets a deletion, by a hash of document and word.
DELETED_IN = 199


def _with_deletion(word: Column, key: Column) -> Column:
    h, n = F.crc32(F.concat(key, F.lit(":"), word)), F.length(word)
    at = F.pmod(h, n).cast("int")
    shorter = F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, n))
    return F.when(h % DELETED_IN == 0, shorter).otherwise(word)


def op12_spelling(spark: SparkSession, sf: str) -> DataFrame:
    """Words of all texts, with the frequent word that a rare one is a variant of."""
    words = spelling.word_counts(read_texts(spark, sf), change=_with_deletion)
    return spelling.forms(words).select("word", "form", "root", "n", "n_near", "form_n")


def op13_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Codes of all vectors and their errors."""
    return vector_codes.report(spark.read.parquet(f"{sf}/embeddings.parquet"))


QUERIES: dict[str, Query] = {
    "op1_passages": op1_passages,
    "op2_fingerprints": op2_fingerprints,
    "op3_mixing": op3_mixing,
    "op4_chat": op4_chat,
    "op5_quality": op5_quality,
    "op6_decontamination": op6_decontamination,
    "op7_toxicity": op7_toxicity,
    "op8_secrets": op8_secrets,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_ngram_join": op10_ngram_join,
    "op11_language_id": op11_language_id,
    "op12_spelling": op12_spelling,
    "op13_vector_codes": op13_vector_codes,
}

#: SQL for the queries whose whole result SQL can express; the others are tested against brute force or held-out labels.
ORACLE: dict[str, str] = {"op12_spelling": sql.SPELLING, "op13_vector_codes": sql.VECTOR_CODES}
