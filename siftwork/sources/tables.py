"""Reading tables and spreading small or unsplittable inputs over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread(df: DataFrame) -> DataFrame:
    """Repartition only if the scan has fewer tasks than the session has cores (a small table, a few gzip files).

    A large splittable input is returned as it is: moving it would cost a shuffle of all text.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df


def read_table(spark: SparkSession, folder: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df
