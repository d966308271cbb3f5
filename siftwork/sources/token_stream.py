"""Token stream files: little-endian uint16, documents one after the other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.operators.tokens import check_uint16
from siftwork.sources.archive import qualified


def _sink():
    """The data source class. It is made here so that it travels to the executors by value."""
    from dataclasses import dataclass

    from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

    @dataclass
    class Written(WriterCommitMessage):
        part: int
        file: str

    class Writer(DataSourceWriter):
        """Tasks write attempts below ``_writing``; the job moves one attempt per part to its name, or removes them all."""

        def __init__(self, path: str):
            self.path = path

        def _folder(self):
            from pyarrow import fs

            return fs.FileSystem.from_uri(self.path)

        def write(self, rows):
            import uuid

            import numpy as np

            store, base = self._folder()
            part, stream, file = -1, None, f"{base}/_writing/{uuid.uuid4().hex}"
            for row in rows:
                if stream is None:
                    part = row["part"]
                    store.create_dir(f"{base}/_writing", recursive=True)
                    stream = store.open_output_stream(file)
                stream.write(np.asarray(row["tokens"], "<u2").tobytes())
            if stream is not None:
                stream.close()
            return Written(part, file)

        def commit(self, messages):
            store, base = self._folder()
            for m in messages:
                if m is not None and m.part >= 0:
                    store.move(m.file, f"{base}/part-{m.part:05d}.bin")
            self._clean()

        def abort(self, messages):
            self._clean()

        def _clean(self):
            from pyarrow import fs

            store, base = self._folder()
            if store.get_file_info(f"{base}/_writing").type != fs.FileType.NotFound:
                store.delete_dir(f"{base}/_writing")

    class TokenStream(DataSource):
        @classmethod
        def name(cls):
            return "token_stream"

        def schema(self):
            return "part int, tokens array<int>"

        def writer(self, schema, overwrite):
            return Writer(self.options["path"])

    return TokenStream


def write_token_stream(tokenized: DataFrame, order: list[str], path: str) -> None:
    """Write ``part-NNNNN.bin`` files that concatenate, in name order, to the ordered stream.

    Each task writes its range as an attempt; the job gives the finished ones their names when all are complete. So neither a
    retried or speculative task nor a failed job leaves a part. ``path`` is on the file system that the cluster names, and
    must hold no parts yet, or old ones could mix with new ones.
    """
    spark = tokenized.sparkSession
    target = qualified(spark, path)
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/part-*.bin")
    if pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern):
        raise FileExistsError(f"{path} holds parts of a token stream already")
    spark.dataSource.register(_sink())
    checked = tokenized.withColumn("tokens", check_uint16(F.col("tokens")))
    placed = checked.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    placed.select("part", "tokens").write.format("token_stream").mode("append").save(target)


def read_token_stream(spark: SparkSession, path: str) -> DataFrame:
    """``(part, tokens)`` of every part file."""

    def decode(batches):
        import numpy as np

        for batch in batches:
            batch["tokens"] = [np.frombuffer(c, dtype="<u2").astype("int32") for c in batch["content"]]
            yield batch[["part", "tokens"]]

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.bin").load(path)
    number = F.regexp_extract("path", r"part-(\d+)\.bin$", 1).cast("int")
    return files.select(number.alias("part"), "content").mapInPandas(decode, "part int, tokens array<int>")
