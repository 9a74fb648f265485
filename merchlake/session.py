"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

MB = 1024 * 1024


def build_session(app: str = "merchlake", master: str | None = None, partitions: int | None = None):
    """A session with the library's settings; `master` and `partitions` are for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    spark = (
        builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("MERCHLAKE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    return tune(spark)


def tune(spark: SparkSession, broadcast_mb: int | None = None) -> SparkSession:
    """UTC, adaptive execution and run-time splitting of skewed join partitions.

    `broadcast_mb` sets the automatic broadcast threshold; without it the
    cluster's own threshold stays.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # Rows go to Python in small batches: long texts would otherwise fill both processes of an executor.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    }
    if broadcast_mb is not None:
        settings["spark.sql.autoBroadcastJoinThreshold"] = str(broadcast_mb * MB)
    for key, value in settings.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir` of the session.

    A temporary folder is made and set as the checkpoint folder only where
    driver and executors are one process; a cluster has to name a shared one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="merchlake-"))
    return spark.sparkContext.getCheckpointDir()


# Scratch paths handed out by this process, with what is needed to remove them after the session has been stopped.
_HANDED_OUT: list[tuple] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch root; what lies there is removed when the process ends."""
    path = f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
    _HANDED_OUT.append((spark._jvm, spark._jsc.hadoopConfiguration(), path))
    return path


@atexit.register
def remove_scratch() -> None:
    """Delete what was written below the scratch paths, as far as the JVM still runs."""
    while _HANDED_OUT:
        jvm, configuration, path = _HANDED_OUT.pop()
        try:
            root = jvm.org.apache.hadoop.fs.Path(path)
            root.getFileSystem(configuration).delete(root, True)
        except (Py4JError, OSError, AttributeError, TypeError):  # the JVM is gone
            _HANDED_OUT.clear()



def stored(df: DataFrame, label: str = "part") -> DataFrame:
    """The rows as a table in the scratch folder, read back: computed once, and not again when executors are lost.

    Unlike `checkpoint()`, which runs a plan twice, once to count and once to write.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
