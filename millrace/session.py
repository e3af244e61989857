"""Session settings, the shared work folder and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", partitions: int = 8, name: str = "millrace") -> SparkSession:
    """A session for tests and benches. On a cluster, pass your own session instead."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read, taken from ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one process, may fall back to a
    temporary folder; a cluster without the setting is an error.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to storage that all executors share")
    folder = tempfile.mkdtemp(prefix="millrace-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path inside the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts lineage in a way that survives the loss of executors, keeps column pruning and
    filter pushdown for later reads, and gives Catalyst real file sizes to plan with.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
