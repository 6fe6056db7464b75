"""Exact ranks, stratified splits and fold assignment.

A ``Window.partitionBy(stratum)`` over five countries would run as five tasks,
and a stratum holding a third of the data would be sorted by one task.  Two
forms give every row its 1-based position inside its stratum without that:

``hash_rank_within`` for orders that begin with a hash of the row (splits,
folds, permutations).  The first digits of the hash cut a stratum into equal
buckets whose order is known beforehand, so counts per (stratum, prefix) give
each bucket its offset, and the rank inside a bucket is local.  The rows are
exchanged once, by (stratum, prefix), and nothing is stored.

``rank_within`` for any order: range-partition on (stratum, order), number the
sorted rows, and add the offsets of the (partition, stratum) runs.  The
numbered frame is checkpointed so both consumers of the numbers agree and a
lost executor recomputes from there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagelens.rules import CV_FOLDS, RANDOM_STATE, TEST_SIZE
from wagelens.session import materialize


def hash_order(key: str | Column, seed: int = RANDOM_STATE) -> Column:
    """Portable pseudo-random order key: md5 of '<key>#<seed>'."""
    k = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(k.cast("string"), F.lit("#"), F.lit(str(seed))))


def hash_unit(key: str | Column, seed: int = RANDOM_STATE) -> Column:
    """Uniform [0, 1) value from the first 32 bits of md5('<key>#<seed>')."""
    hx = F.substring(hash_order(key, seed), 1, 8)
    return F.conv(hx, 16, 10).cast("double") / F.lit(4294967296.0)


def rank_within(df: DataFrame, strata: list[str], order: list[Column], name: str = "rank",
                num_partitions: int | None = None, checkpoint: bool = True) -> DataFrame:
    """1-based rank of each row in its stratum under ``order`` (must be a
    total order: end it with a unique key)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(s) for s in strata] + list(order)
    tagged = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    if checkpoint:
        tagged = materialize(tagged)
    runs = tagged.groupBy("_pid", *strata).agg(F.count(F.lit(1)).alias("_cnt"), F.min("_mid").alias("_start"))
    w = Window.partitionBy(*strata).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    return (tagged.join(runs.select("_pid", *strata, "_off", "_start"), ["_pid", *strata])
            .withColumn(name, (F.col("_off") + F.col("_mid") - F.col("_start") + 1).cast("bigint"))
            .drop("_pid", "_mid", "_off", "_start"))


#: Hex digits of a hash that make a bucket: 4,096 buckets a stratum.
PREFIX_DIGITS = 3


def hash_rank_within(df: DataFrame, strata: list[str], order: Column, tie: list[Column], name: str = "rank",
                     size: str | None = None, digits: int = PREFIX_DIGITS) -> DataFrame:
    """1-based rank of each row in its stratum under (``order``, ``tie``),
    ``order`` being a hexadecimal hash column; null strata are strata of their
    own.  ``size`` names a column for the rows of the stratum."""
    # The hash travels as 16 bytes, which sort like its 32 digits.
    tagged = df.withColumn("_prefix", F.substring(order, 1, digits)).withColumn("_hash", F.unhex(order))
    tagged = tagged.withColumn("_stratum", F.struct(*strata))
    counts = tagged.groupBy("_stratum", "_prefix").agg(F.count(F.lit(1)).alias("_in"))
    whole = Window.partitionBy("_stratum")
    before = whole.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_stratum", "_prefix", F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_before"),
                            F.sum("_in").over(whole).alias("_size"))
    local = Window.partitionBy("_stratum", "_prefix").orderBy("_hash", *tie)
    ranked = tagged.withColumn("_local", F.row_number().over(local)).join(offsets, ["_stratum", "_prefix"])
    ranked = ranked.withColumn(name, F.col("_before") + F.col("_local"))
    if size:
        ranked = ranked.withColumn(size, F.col("_size"))
    return ranked.drop("_hash", "_stratum", "_prefix", "_local", "_before", "_size")


def stratified_split(df: DataFrame, strata: list[str], key: str, test_size: float = TEST_SIZE,
                     seed: int = RANDOM_STATE, name: str = "split") -> DataFrame:
    """exact per-stratum holdout of round(n * test_size) rows, chosen by
    md5 order (portable and reproducible).  Adds ``split`` in
    {'development', 'test'}."""
    ranked = hash_rank_within(df, strata, hash_order(key, seed), [F.col(key)], "_rank", "_stratum_n")
    n_test = F.floor(F.col("_stratum_n") * test_size + 0.5)
    return ranked.withColumn(name, F.when(F.col("_rank") <= n_test, "test").otherwise("development")).drop("_rank", "_stratum_n")


def stratified_split_folds(df: DataFrame, strata: list[str], key: str, test_size: float = TEST_SIZE,
                           k: int = CV_FOLDS, seed: int = RANDOM_STATE) -> DataFrame:
    """F4 + F5 from one distributed rank: the first round(n * test_size)
    rows of each stratum (md5 order) are the holdout; the remaining rows
    keep the same order, so their fold is (rank - n_test - 1) mod k - the
    same assignment as re-ranking the development rows alone."""
    ranked = hash_rank_within(df, strata, hash_order(key, seed), [F.col(key)], "_rank", "_stratum_n")
    n_test = F.floor(F.col("_stratum_n") * test_size + 0.5)
    dev = F.col("_rank") > n_test
    return (ranked.withColumn("split", F.when(dev, "development").otherwise("test"))
            .withColumn("fold", F.when(dev, ((F.col("_rank") - n_test - 1) % k).cast("int")))
            .drop("_rank", "_stratum_n"))


def stratified_folds(df: DataFrame, strata: list[str], key: str, k: int = CV_FOLDS,
                     seed: int = RANDOM_STATE, name: str = "fold") -> DataFrame:
    """fold = (rank in stratum - 1) mod k, so each stratum is spread
    evenly over the folds (sizes differ by at most one per stratum)."""
    ranked = hash_rank_within(df, strata, hash_order(key, seed), [F.col(key)], "_rank")
    return ranked.withColumn(name, ((F.col("_rank") - 1) % k).cast("int")).drop("_rank")


def hash_folds(df: DataFrame, key: str, k: int = CV_FOLDS, seed: int = RANDOM_STATE,
               name: str = "fold") -> DataFrame:
    """plain k-fold by hash bucket - narrow, no shuffle; fold sizes are
    only approximately equal."""
    hx = F.substring(hash_order(key, seed), 1, 8)
    return df.withColumn(name, F.pmod(F.conv(hx, 16, 10).cast("bigint"), F.lit(k)).cast("int"))


def split_balance(df: DataFrame, stratum: str, split: str = "split") -> DataFrame:
    """rows per stratum and split (long form)."""
    return df.groupBy(stratum, split).agg(F.count(F.lit(1)).alias("rows"))


def reattach(ids: DataFrame, table: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """F8: bring columns back to a split by row identity (equi-join on key)."""
    return ids.join(table.select(key, *columns), key, "inner")


def group_split(df: DataFrame, unit: str, test_size: float = TEST_SIZE, seed: int = RANDOM_STATE,
                name: str = "split") -> DataFrame:
    """group-aware split - every row of a unit (e.g. a posting
    fingerprint) lands on the same side; sizes are approximate."""
    return df.withColumn(name, F.when(hash_unit(unit, seed) < test_size, "test").otherwise("development"))
