"""Spark session helpers.

The library never creates a session on its own inside an operator; callers pass
one in.  ``get_spark`` is for tests, the bench and the driver entry point.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "charloom") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(os.environ.get("CHARLOOM_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Rankings checkpoint their sorted keys; drop the files once unreferenced.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("CHARLOOM_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    allow_python_join_keys(spark)
    ensure_checkpoint_dir(spark)
    return spark


def allow_python_join_keys(spark: SparkSession) -> None:
    """Spark's runtime bloom-filter injection copies a join key's producing plan into an
    aggregate; when that key comes from a Python function (Unicode normalisation here)
    the copy cannot be code-generated and the query fails.  The filter is only an
    optimisation; callers that own the session switch it off with this."""
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "false")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator sets it to a shared file system, and a missing setting
    is an error there; only on a local master is a fresh scratch folder picked.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="charloom-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def spread(df, factor: int = 2):
    """Give a scan that arrives in fewer partitions than the cluster has cores
    (one small Parquet file) enough tasks.  A scan that is already wide (any real
    corpus) is returned unchanged, so no shuffle is added at scale."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores * factor)
