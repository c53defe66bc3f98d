"""SparkSession construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "skuflow") -> SparkSession:
    """Build (or reuse) a session tuned for the analytics in this package.

    On a cluster the master, memory and shuffle width come from the launcher;
    only the settings the operators rely on are forced here: AQE (runtime
    coalescing, skew-join splitting, broadcast demotion from *measured* sizes),
    UTC session time and the UI switched off.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master and master.startswith("local"):
        # local mode runs every task inside the driver JVM
        builder = builder.config("spark.driver.memory", os.environ.get("SKUFLOW_DRIVER_MEMORY", "12g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory the cluster configured.

    ``spark.checkpoint.dir`` names a shared folder on a cluster and is used as
    is.  Only when it is unset (local tests) is a private scratch folder
    created; elsewhere the call fails, since executors could not read each
    other's local folders.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="skuflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


#: Rows of a fact table that one task of a shuffle gets: their sort stays far below a task's memory.
ROWS_PER_TASK = 250_000


def shuffle_width(spark: SparkSession, rows: int) -> int:
    """Shuffle partitions for a table of ``rows`` rows: those configured, more if tasks grew beyond ROWS_PER_TASK."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS_PER_TASK))


@contextmanager
def shuffles_for(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is run inside shuffles into ``shuffle_width`` partitions, so that tasks do not grow with the input and spill."""
    key = "spark.sql.shuffle.partitions"
    configured = spark.conf.get(key)
    spark.conf.set(key, str(shuffle_width(spark, rows)))
    try:
        yield
    finally:
        spark.conf.set(key, configured)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is run inside are deleted when its action ends, not when the driver's memory happens to be collected."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    configured = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, configured)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of this library, in whatever file system it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def dealt(df: DataFrame, rows: int, key: str) -> DataFrame:
    """``df``, of about ``rows`` rows, dealt by ``key``; a number of partitions is set only where the configured one is too low."""
    width = shuffle_width(df.sparkSession, rows)
    return df.repartition(width, key) if width > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df.repartition(key)
