"""Reading inputs and cutting lineage by tables in the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwork.operators.skew import salted_join

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a local session may fall back to a temporary one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if "folder" not in _LOCAL:
        _LOCAL["folder"] = tempfile.mkdtemp(prefix="siftwork-llm-")
    return _LOCAL["folder"]


def saved(df: DataFrame, name: str = "table", codec: str = "zstd") -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def saved_by(df: DataFrame, key: str, name: str = "table", codec: str = "zstd") -> DataFrame:
    """``df`` stored below the shared folder in buckets by ``key``, as many as the session's shuffles have partitions.

    Joins on ``key`` alone then shuffle only their other side, however often and however large. The table's name stays in the
    session's catalog as long as its files are needed.
    """
    spark = df.sparkSession
    n, table = int(spark.conf.get("spark.sql.shuffle.partitions")), f"llm_{name}_{uuid.uuid4().hex}"
    writer = df.repartition(n, key).write.format("parquet").bucketBy(n, key)  # each task has one bucket, and writes one file
    writer.option("compression", codec).option("path", f"{shared_folder(spark)}/llm/{table}").saveAsTable(table)
    return spark.table(table)


def read_texts(spark: SparkSession, folder: str, table: str = "documents", key: str = "doc_id") -> DataFrame:
    """``(key, text)`` of a table, a null text being the empty one."""
    return spark.read.parquet(f"{folder}/{table}.parquet").select(key, F.coalesce("text", F.lit("")).alias("text"))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


#: Bytes of a stored side table that may be sent to every executor.
BROADCAST_BYTES = 256 << 20


def value_bytes(value: Column, kind: T.DataType) -> Column:
    """About how many bytes a value takes in memory."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value) + 24
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType)):
        size = F.aggregate(value, F.lit(24), lambda s, x: s + value_bytes(x, kind.elementType).cast("int"))
    elif isinstance(kind, T.ArrayType):
        size = F.size(value) * 8 + 24
    elif isinstance(kind, T.StructType):
        size = sum((value_bytes(value[f.name], f.dataType) for f in kind.fields), F.lit(8))
    else:
        size = F.lit(8)
    return F.coalesce(size, F.lit(8)).cast("long")


def is_small(df: DataFrame, most: int = BROADCAST_BYTES) -> bool:
    """Whether a stored table takes at most ``most`` bytes in memory, as summed over its rows."""
    row = sum((value_bytes(F.col(f.name), f.dataType) for f in df.schema), F.lit(16).cast("long"))
    return (df.agg(F.sum(row)).first()[0] or 0) <= most


def small_side(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (stored, so that measuring it reads one table) with a broadcast hint if it is small enough, else as it is."""
    return F.broadcast(df) if is_small(df, most) else df


def keyed_join(rows: DataFrame, table: DataFrame, keys: list[str], salt_on: Column, how: str = "inner") -> DataFrame:
    """``rows`` joined with a stored table of unique keys: by broadcast if that is small, else with the rows of hot keys salted."""
    if is_small(table):
        return rows.join(F.broadcast(table), keys, how)
    return salted_join(rows, table, keys, salt_on, how)
