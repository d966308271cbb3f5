"""Crawl archives: text records (WET) and HTTP responses (WARC).

Records are split by the text source itself with the record separator as line separator: one row per record, so
memory is bounded by one record and no file is read as a whole. Payloads stay raw bytes until they are decoded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.sources.archive import read_archive

# Fixed value: end of a record's payload and version line of the next record.
SEPARATOR = "\r\n\r\nWARC/1.0\r\n"


def _header(headers: Column, name: str) -> Column:
    return F.regexp_extract(headers, rf"(?im)^{name}:[ \t]*([^\r\n]*?)[ \t]*$", 1)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``(type, url, date, record_id, payload, file)`` of every record; one without an id is named by its file and place.

    A payload is cut to its Content-Length. One that contains the separator arrives in pieces, the first of which is
    shorter than announced; records of another format version are not separated, so more follows than announced.
    Both fail the job; :func:`read_records_exact` reads such files.
    """
    raw = spark.read.option("lineSep", SEPARATOR).text(path).select(
        # the header ends at the first blank line; it is found in the bytes, without decoding the payload
        F.substring_index("value", "\r\n\r\n", 1).alias("_head"),
        F.col("value").cast("binary").alias("_bytes"),
        F.col("_metadata.file_path").alias("file"),
    )
    length = "try_cast(nullif(regexp_extract(_head, r'(?im)^Content-Length:[ \t]*([0-9]+)', 1), '') AS int) AS _length"
    fields = raw.select(
        _header(F.col("_head"), "WARC-Type").alias("type"),
        _header(F.col("_head"), "WARC-Target-URI").alias("url"),
        _header(F.col("_head"), "WARC-Date").alias("date"),
        F.coalesce(
            F.nullif(_header(F.col("_head"), "WARC-Record-ID"), F.lit("")),
            F.concat("file", F.lit("@"), F.monotonically_increasing_id().cast("string")),
        ).alias("record_id"),
        F.expr(length),
        (F.octet_length("_head") + 4).alias("_skip"),
        "_bytes",
        "file",
    )
    payload = F.substring(F.col("_bytes"), F.col("_skip") + 1, F.col("_length"))
    records = fields.where("length(_bytes) > 0").withColumn("payload", payload)
    rest = F.length("_bytes") - F.col("_skip") - F.col("_length")
    # the last record of a file keeps its final blank lines
    broken = F.col("_length").isNull() | ~rest.between(0, 4)
    message = F.concat(F.lit("record split by a separator in its payload, or of another version, in "), F.col("file"))
    records = records.withColumn("payload", F.when(broken, F.raise_error(message).cast("binary")).otherwise(F.col("payload")))
    return records.select("type", "url", "date", "record_id", "payload", "file")


def read_records_exact(spark: SparkSession, path: str) -> DataFrame:
    """The same records, read by Content-Length, and by many tasks where a file is compressed record by record."""
    return read_archive(spark, path)


def read_wet(spark: SparkSession, path: str, exact: bool = False) -> DataFrame:
    """``(url, date, record_id, text, file)`` of the ``conversion`` records; invalid UTF-8 becomes U+FFFD."""
    records = read_records_exact(spark, path) if exact else read_records(spark, path)
    text = F.make_valid_utf8(F.col("payload").cast("string"))
    return records.where("type = 'conversion'").select("url", "date", "record_id", text.alias("text"), "file")


def with_http_fields(records: DataFrame, payload: str = "payload") -> DataFrame:
    """``status``, ``content_type`` and ``body`` in place of an HTTP payload; status is null without HTTP headers."""
    headed = records.withColumn("_head", F.substring_index(F.col(payload).cast("string"), "\r\n\r\n", 1))
    status = F.expr(r"try_cast(nullif(regexp_extract(_head, '^HTTP/[0-9.]+ +([0-9]{3})', 1), '') as int)")
    return headed.withColumns({
        "status": status, "content_type": _header(F.col("_head"), "Content-Type"),
        "body": F.substring(F.col(payload), F.octet_length("_head") + 5, F.length(payload)),
    }).drop("_head", payload)


def read_responses(spark: SparkSession, path: str, exact: bool = False) -> DataFrame:
    """``(url, status, content_type, body, file)`` of the ``response`` records; status is null without HTTP headers."""
    records = read_records_exact(spark, path) if exact else read_records(spark, path)
    found = with_http_fields(records.where("type = 'response'").select("url", "payload", "file"))
    return found.select("url", "status", "content_type", "body", "file")
