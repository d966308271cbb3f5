"""Session settings and lineage cutting shared by all plans."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the plans rely on. Partition counts and sizes are left to AQE and the cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The call site of every column function is not needed; recording it costs more than building the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Checkpoints of finished steps are deleted once nothing refers to them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Texts can be long: keep Arrow batches small enough for a Python worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
}


def build_session(master: str | None = None, app: str = "siftwork", **extra: str) -> SparkSession:
    """Session with the settings above; ``extra`` overrides (dots written as ``__``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named by ``spark.checkpoint.dir``.

    Only a local session (tests) may fall back to a temporary folder: a cluster needs a shared one, or
    a lost executor would take its checkpoints with it.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return
    if configured:
        context.setCheckpointDir(configured)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="siftwork-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder, which all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below the checkpoint folder and continue from there with an empty lineage.

    ``checkpoint()`` would compute the rows twice, once to run the job and once to store them, and keep them as unpacked rows.
    """
    path = scratch_path(df.sparkSession, "step")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_by(df: DataFrame, key: str, n: int, dealt: bool = False) -> DataFrame:
    """``df`` as by :func:`materialize`, in ``n`` buckets by ``key``: tables of as many buckets join and group by ``key`` without a shuffle.

    ``dealt`` says that the rows of ``df`` are partitioned so already, as those of such tables are. The table's name stays in the
    session's catalog as long as its files are needed.
    """
    spark, name = df.sparkSession, f"step_{uuid.uuid4().hex}"
    rows = df if dealt else df.repartition(n, key)
    rows.write.format("parquet").bucketBy(n, key).option("compression", "zstd").option("path", scratch_path(spark, "step")).saveAsTable(name)
    return spark.table(name)
