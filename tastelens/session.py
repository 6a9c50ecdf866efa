"""Session helpers: shared scratch folder and a local session for tests and benches."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Where that is unset, a folder in the warehouse of a session without other executors; on a
    cluster that may be a folder of the driver's machine alone, so there it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df):
    """Materialise ``df`` in the shared folder and continue from there."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint(eager=True)


def local_session(
    cpus: int | str = "*",
    partitions: int = 8,
    memory: str = "8g",
    scratch: str | None = None,
) -> SparkSession:
    """A local session; ``scratch`` is its folder for checkpoints and stored stages."""
    builder = SparkSession.builder.master(f"local[{cpus}]")
    if scratch:
        builder = builder.config("spark.checkpoint.dir", scratch)
    return (
        builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .appName("tastelens")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # no call site for every column expression, which costs more than building it
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
