"""Spark session construction and shared-storage helpers.

Everything in the library takes a ``SparkSession`` from the caller; this
module only builds one for tests / bench runs and resolves the shared
checkpoint folder.  On a cluster the folder comes from
``spark.checkpoint.dir``; a private one is made only when it is unset
(local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Dimension-sized sides only; bigger sides are joined by shuffle.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "wagelens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    builder = builder.master(master or os.environ.get("WAGELENS_MASTER", "local[8]"))
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("WAGELENS_DRIVER_MEMORY", "16g")
    if extra:
        conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only when
    the session has none configured (local runs and tests)."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="wagelens-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def materialize(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder.

    Used after expensive, reused intermediate results (e.g. ranked splits)
    so a lost executor recomputes from the checkpoint, not from the scan.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique sub-folder of the shared checkpoint folder for table sinks."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def spread(df: DataFrame, key: str | None = None, min_partitions: int | None = None) -> DataFrame:
    """Give a CPU-heavy narrow stage at least the cluster's parallelism.

    A source that arrives as a few large splits (one Parquet row group per
    file) runs all of its per-row work (regexes, hashing) in that many
    tasks.  When the scan has fewer partitions than the default
    parallelism, hash-partition it on ``key`` (deterministic on retry);
    otherwise - the normal case for a large table - return it unchanged.
    The check reads the planned partition count only, it runs no job."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, key) if key else df.repartition(target)
