"""Session settings and the shared scratch folder."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # texts and pages go to Python whole, so batches are kept short
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def build(app="riskweave", master=None, **extra):
    """A session with adaptive execution on; shuffle partitions are left to the cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark):
    """The folder all executors see: `spark.checkpoint.dir`. Only a local master gets a local one where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if named is None:
        named = spark.sparkContext.getCheckpointDir()
    if named is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="riskweave-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark, label):
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark):
    """Point `checkpoint()` at the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def written(spark, df, label, **options):
    """Cut lineage through a parquet table in the shared folder, so a lost executor costs no rework."""
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_with(spark, df, label, **facts):
    """As `written`, with aggregates over all rows of the written table: (table, {name: value}).

    They are read from the table and not observed while it is written: a session that has observed once holds a part that
    cannot be serialised, and later jobs that ship the session fail.
    """
    table = written(spark, df, label)
    return table, table.agg(*[column.alias(name) for name, column in facts.items()]).first().asDict()


TASK_BYTES = 32 << 20


def tasks_for(rows, bytes_per_row):
    return max(1, -(-rows * bytes_per_row // TASK_BYTES))


def packed(df, rows, bytes_per_row):
    """The frame in no more partitions than its size calls for, so that many short jobs over it start few tasks."""
    return df.coalesce(tasks_for(rows, bytes_per_row))
