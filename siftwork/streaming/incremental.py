"""Incremental curation: new files are curated once, in micro-batches, with restart after failure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as P

from siftwork.operators.reports import merged_report, source_counters
from siftwork.plans.curate import Models, curate, judge
from siftwork.session import materialize

DOCUMENTS = P.StructType(
    [
        P.StructField("doc_id", P.LongType()),
        P.StructField("text", P.StringType()),
        P.StructField("source", P.StringType()),
    ]
)


def curate_incrementally(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    checkpoint_path: str,
    models: Models,
    schema: P.StructType = DOCUMENTS,
    files_per_batch: int = 1000,
    input_format: str = "json",
):
    """Process all files not seen yet and stop; returns the finished streaming query.

    The streaming checkpoint remembers finished input files, which replaces "skip outputs that exist". A batch
    writes to folders named by its id, so running a batch again after a failure replaces its output instead of
    adding to it. Curation looks at one document at a time, so batches can be read back as one table. So do the counters
    of all batches, which :func:`streamed_report` adds up: totals are state that is kept per batch id, and a batch that
    runs twice counts once.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        judged = materialize(judge(batch, models, keep=("source",)))
        curate(batch, None, judged=judged).write.mode("overwrite").json(f"{output_path}/documents/batch={batch_id}")
        counters = materialize(source_counters(judged))
        counters.coalesce(1).write.mode("overwrite").parquet(f"{output_path}/counters/batch={batch_id}")
        merged_report(counters).coalesce(1).write.mode("overwrite").json(f"{output_path}/reports/batch={batch_id}")

    query = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .format(input_format)
        .load(input_path)
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def streamed_report(spark: SparkSession, output_path: str) -> DataFrame:
    """The report by source over all batches of ``output_path`` so far: that of one batch run over all their documents."""
    return merged_report(spark.read.parquet(f"{output_path}/counters").drop("batch"))
