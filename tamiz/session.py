"""A session with the settings the engine is written for. On a cluster the master and sizes come from spark-submit."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # calls to outside services must not run twice because a task is slow
    "spark.speculation": "false",
}


def session(app: str = "tamiz", master: str | None = None, **settings: str) -> SparkSession:
    """A session; ``settings`` (dots as double underscores) win over SETTINGS."""
    builder = SparkSession.builder.appName(app).config(map=SETTINGS | {k.replace("__", "."): v for k, v in settings.items()})
    return (builder.master(master) if master else builder).getOrCreate()


def spread(df: DataFrame) -> DataFrame:
    """df in at least as many partitions as there are cores: a table of few files would keep most of them idle.

    A table of many files, as large ones are, stays as it is and is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def cut(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder of the cluster (``spark.checkpoint.dir``) and read again: they outlive an executor."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; a temporary one of the machine only where driver and executors are one process."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
    return tempfile.mkdtemp(prefix="tamiz-")
