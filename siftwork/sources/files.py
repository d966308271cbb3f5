"""Text-like sources and sinks: curated documents, line lists, dumps, document folders, reports."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as P

from siftwork.functions import urls as U
from siftwork.functions.html import unescape
from siftwork.functions.text import strip

#: Schema of a curated document; JSON is never inferred.
CURATED = P.StructType(
    [
        P.StructField("url", P.StringType()),
        P.StructField("domain", P.StringType()),
        P.StructField("date", P.StringType()),
        P.StructField("record_id", P.StringType()),
        P.StructField("word_count", P.IntegerType()),
        P.StructField("text", P.StringType()),
    ]
)


def write_curated(df: DataFrame, path: str, by: str | None = None) -> None:
    """JSON lines, one folder per input with ``by``; published by the commit protocol, never half written."""
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false")
    (writer.partitionBy(by) if by else writer).json(path)


def read_curated(spark: SparkSession, path: str, errors: str = "FAILFAST") -> DataFrame:
    """Curated documents with their ``LINE_ORDER``. ``PERMISSIVE`` turns broken lines into rows with ``_corrupt_record``."""
    schema = CURATED
    if errors == "PERMISSIVE":
        schema = P.StructType([*CURATED.fields, P.StructField("_corrupt_record", P.StringType())])
    reader = spark.read.schema(schema).option("mode", errors).option("recursiveFileLookup", "true")
    return with_line_order(reader.json(path))


#: Columns that order the lines of a folder as they stand: by file, part of a file, line.
LINE_ORDER = ["file", "block", "ord"]


def with_line_order(df: DataFrame) -> DataFrame:
    """Adds the columns of ``LINE_ORDER``; ``ord`` is unique. Use right after a scan."""
    return df.withColumns(
        {
            "file": F.col("_metadata.file_path"),
            "block": F.col("_metadata.file_block_start"),
            "ord": F.monotonically_increasing_id(),
        }
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Line list (URLs, paths): stripped, blank lines dropped; gzip and bzip2 are read as they are."""
    return spark.read.text(path).select(strip(F.col("value")).alias("value")).where("value <> ''")


def write_lines(df: DataFrame, column: str, path: str) -> None:
    df.select(F.col(column).cast("string")).write.mode("overwrite").text(path)


def read_path_listing(spark: SparkSession, path: str) -> DataFrame:
    """Single-column CSV without header."""
    return spark.read.schema("path string").csv(path)


def read_dump_urls(spark: SparkSession, path: str) -> DataFrame:
    """URLs of the references in a wiki dump, with repetitions. bzip2 dumps are split between tasks."""
    lines = spark.read.text(path).select(F.make_valid_utf8("value").alias("line"))
    return lines.select(F.explode(U.reference_urls(F.col("line"))).alias("url"))


def distinct_urls(*parts: DataFrame) -> DataFrame:
    """Sorted set union of URL lists."""
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.distinct().orderBy("url")


def clean_urls(df: DataFrame) -> DataFrame:
    """Distinct valid URLs after stripping and unescaping HTML entities."""
    cleaned = df.select(unescape(strip(F.col("url"))).alias("url")).where("url <> ''").distinct()
    return cleaned.where(U.is_valid_url(F.col("url")))


def read_document_folder(spark: SparkSession, path: str) -> DataFrame:
    """``(name, text)``: one row per file, bytes as they are.

    Spark gives empty files no row, so their names are added from the file listing it holds already.
    """
    files = spark.read.format("binaryFile").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    found = files.select(name.alias("name"), F.col("content").cast("string").alias("text"))
    listed = [(unquote(file.rsplit("/", 1)[-1]),) for file in files.inputFiles()]
    empty = spark.createDataFrame(listed, "name string").join(found.select("name"), "name", "left_anti")
    return found.unionByName(empty.withColumn("text", F.lit("")))


def write_documents(df: DataFrame, path: str, name: str = "name", text: str = "text") -> None:
    """Documents with their exact bytes as Parquet rows ``(name, content)``; emptied documents are written too.

    One file per document does not scale, and a text sink ends lines on its own; the rows keep every byte.
    """
    content = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    df.select(F.col(name).alias("name"), content.alias("content")).write.mode("overwrite").parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(name, text)`` written by :func:`write_documents`."""
    return spark.read.parquet(path).select("name", F.col("content").cast("string").alias("text"))


def write_labelled(df: DataFrame, path: str) -> None:
    """``line`` column of labelled examples, one folder per split."""
    df.select("split", "line").write.mode("overwrite").partitionBy("split").text(path)


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """``(label, text)`` of ``__label__<label> <text>`` lines."""
    parts = F.split("value", " ", 2)
    return spark.read.text(path).select(
        F.substring(parts[0], 10, 1 << 20).alias("label"), F.coalesce(F.get(parts, F.lit(1)), F.lit("")).alias("text")
    )


def write_report(df: DataFrame, path: str) -> None:
    """Report rows (bounded: totals and one row per source) as JSON in a single file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def review_blocks(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """A bounded sample as numbered blocks for a reader: URL, prediction, score, first characters."""
    number = F.row_number().over(Window.orderBy(key))
    block = F.concat_ws(
        "\n",
        F.concat(F.lit("=" * 20 + " "), number.cast("string"), F.lit(" " + "=" * 20)),
        F.concat(F.lit("URL: "), F.coalesce("url", F.lit(""))),
        F.concat(F.lit("prediction: "), F.col("label"), F.lit("  score: "), F.format_number("score", 3)),
        F.substring(F.col(text), 1, 800),
    )
    return df.select(number.alias("number"), block.alias("block"))
