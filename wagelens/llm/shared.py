"""Small helpers for the operators: tables, batch sizes, written stages."""

from __future__ import annotations

import ctypes
import gc
import math
import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wagelens.session import materialize, scratch_path  # noqa: F401  (re-exported for the operators)

#: Rows in one Arrow batch sent to a Python worker.  A batch of very long
#: documents stays within a worker's memory; the size has no effect on results.
BATCH_ROWS = 512
BATCH_BYTES = 4 << 20


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


#: Spark deletes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write an intermediate table in the shared folder and read it back, so
    its consumers share one computation and a lost executor costs a reread."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    # The write's own shuffle files are of no use once the table is there.
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    # Those of other jobs (counts, lists) go once the driver's JVM has collected
    # their handles; without this they pile up on the executors.
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def worker_memory() -> dict:
    """A dict that lives as long as the Python worker, so tasks that follow one
    another there can share what they learned.  Results never depend on it."""
    return sys.modules.setdefault("wagelens_worker_memory", types.ModuleType("wagelens_worker_memory")).__dict__


def free_worker() -> None:
    """Drop what tasks of earlier operators keep in this worker (tables, indexes):
    a query of several operators would hold all of them side by side."""
    worker_memory().clear()
    give_back()


def give_back() -> None:
    """Return what this worker has freed to the system: arrays of less than 32 MB
    stay on its heap otherwise, in every worker of an executor."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def opened(folder: str):
    """(pyarrow file system, path) of a folder that tasks and driver share."""
    from pyarrow import fs

    if folder.startswith("file:"):
        folder = "/" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


def mapped(store, path: str, dtype: str):
    """One part as an array: memory-mapped where the store is a local or mounted folder."""
    import numpy as np
    from pyarrow import fs

    if store.get_file_info(path).size == 0:
        return np.zeros(0, dtype)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype, mode="r")
    with store.open_input_file(path) as file:
        return np.frombuffer(file.read_buffer(), dtype)


def read_whole(path: str, columns: list[str] | None):
    """A stored table of bounded size as one Arrow table, read by a task or the
    driver itself: a model that every worker needs never passes the driver."""
    import pyarrow.dataset as ds

    store, folder = opened(path)
    return ds.dataset(folder, filesystem=store, format="parquet").to_table(columns=columns).combine_chunks()


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns that the text operators read; other columns are pruned."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def blocks_for(total: float | None, limit: float) -> int:
    return max(1, math.ceil((total or 0) / limit))


def least_hashed(df: DataFrame, key: Column, k: int) -> DataFrame:
    """Rows of ``df`` whose 64-bit hash ``key`` is among the about ``k`` least
    different ones, and at least ``k`` if there are so many.  The limit comes
    from a count, so no task sends ``k`` rows of its own anywhere."""
    different = df.agg(F.approx_count_distinct(key, 0.02)).first()[0]
    share = (1.2 * k + 100) / max(1, different)
    while share < 1:
        low = df.where(key < F.lit(int(share * 2**64) - 2**63))
        if low.agg(F.count_distinct(key)).first()[0] >= k:
            return low
        share *= 4
    return df


#: Ids that a join may broadcast (8 bytes each); more are shuffled.
BROADCAST_IDS = 1_000_000


def by_ids(df: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Semi or anti join of ``df`` with a stored table of ``doc_id``s: the ids
    are counted, and only a list within the bound is broadcast."""
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return df.join(ids, "doc_id", how)


def discard(stored: DataFrame) -> None:
    """Delete a table written by ``store`` whose consumers are stored themselves."""
    spark = stored.sparkSession
    for file in stored.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
