"""Exact duplicates: repeated lines and repeated documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwork.functions.hashing import fingerprint
from siftwork.functions.text import normalize_exact
from siftwork.operators.skew import salted_join


def _with_lines(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``_lines``: lines with their terminator; a final empty piece after the last newline is not a line.

    The pieces pass through a generator of one row, so the lambda reads them instead of splitting the text for every line.
    """
    split = df.withColumn("_pieces", F.explode(F.array(F.split(F.col(text), "\n"))))
    with_ends = F.transform(
        "_pieces", lambda x, i: F.when(i < F.size("_pieces") - 1, F.concat(x, F.lit("\n"))).otherwise(x)
    )
    return split.withColumn("_lines", F.explode(F.array(F.filter(with_ends, lambda x: x != "")))).drop("_pieces")


def drop_repeated_lines(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Remove every copy of a line that occurs more than once in all documents together.

    Lines are compared with their terminator, so a last line without newline differs from the same line with
    one. Emptied documents stay, as ``''``. Only fingerprints and positions of lines are shuffled; the text itself
    moves once, to meet the positions that must go. A line that makes up much of the corpus (a blank line, a menu
    entry) is counted by partial aggregation and looked up with salt.
    """
    with_lines = _with_lines(df.where(F.col(text).isNotNull()), text)
    prints = with_lines.select(key, F.posexplode("_lines").alias("_pos", "_line")).select(
        key, "_pos", *[c.alias(f"_h{i}") for i, c in enumerate(fingerprint(F.col("_line")))]
    )
    repeated = prints.groupBy("_h0", "_h1").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    doomed = salted_join(
        prints, repeated.select("_h0", "_h1"), ["_h0", "_h1"], F.col(key), "left_semi", counts=repeated
    )
    # one entry per line of the document at most
    positions = doomed.groupBy(key).agg(F.collect_set("_pos").alias("_gone"))
    joined = _with_lines(df, text).join(positions.hint("shuffle_hash"), key, "left")
    # by hashing, so time grows with the lines and not with lines times removed lines
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    kept = F.array_join(F.transform(left, lambda i: F.get("_lines", i)), "")
    return joined.withColumn(text, F.when(F.col("_gone").isNull(), F.col(text)).otherwise(kept)).drop("_lines", "_gone")


def first_of_each_text(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Keys of the documents to keep: the smallest key of each normalised text.

    Copies are combined in the map tasks, so a text held by a third of all documents arrives as one row per task.
    """
    hashed = df.select(key, F.unhex(F.sha2(normalize_exact(F.col(text)), 256)).alias("_hash"))
    return hashed.groupBy("_hash").agg(F.min(key).alias(key)).select(key)


def drop_repeated_documents(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents kept by :func:`first_of_each_text`."""
    return df.join(first_of_each_text(df, key, text), key, "left_semi")


def document_dedup_report(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """documents, kept and removed as one row."""
    kept = first_of_each_text(df, key, text).agg(F.count(F.lit(1)).alias("kept"))
    total = df.agg(F.count(F.lit(1)).alias("documents"))
    return (
        total.withColumn("_one", F.lit(1))
        .join(kept.withColumn("_one", F.lit(1)), "_one")
        .select("documents", "kept", (F.col("documents") - F.col("kept")).alias("removed"))
    )
