"""Exact quantiles of many columns and groups at once, and checked broadcasts.

``percentile`` gathers a value -> count map of every group in one task; with
a few groups and continuous values that map is a good part of the table.
Here ranks are found by counting, in three steps over one table of value
counts (equal values are counted map-side, all columns stacked in it, and it
is exchanged once):

1. counts per coarse bucket of the values, with a running sum, tell which
   buckets hold a wanted rank;
2. the same in finer buckets, inside those only;
3. a running sum over the values of the wanted fine buckets picks the ranks.

A bucket is ``floor(scale * t)`` of ``t = sign(v) * ln(1 + |v|)``, which never
falls as the value grows, so no sampling and no sort of the values is needed.
A task holds the values of a fine bucket, those within one part in 2**24 of
each other; everything else it sees is bucket counts.  Nothing is stored and
nothing runs while a plan is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagelens.session import materialize

#: Rows of a group table that may be broadcast.
SMALL_TABLE = 100_000
#: Buckets per unit of ``ln(1 + |value|)``.
COARSE, FINE = 2**8, 2**24


def checked_broadcast(table: DataFrame, limit: int = SMALL_TABLE) -> DataFrame:
    """The stored table, marked for broadcast only where it is small; beyond
    the limit it is joined by shuffle."""
    table = materialize(table)
    return F.broadcast(table) if table.limit(limit + 1).count() <= limit else table


def value_counts(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """(groups, value, _w): rows per distinct non-null value."""
    return df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_w"))


def stacked_counts(df: DataFrame, groups: list[str], columns: list[str]) -> DataFrame:
    """(_column, groups, _v, _w): value counts of several columns in one table."""
    pairs = F.array(*[F.struct(F.lit(c).alias("_column"), F.col(c).cast("double").alias("_v")) for c in columns])
    return value_counts(df.select(*groups, F.inline(pairs)), ["_column", *groups], "_v")


def bucket(v: Column, scale: int) -> Column:
    return F.coalesce(F.floor(F.signum(v) * F.log1p(F.abs(v)) * F.lit(float(scale))), F.lit(0))


def running(keys: list[str], order: str) -> Column:
    """Weights of the rows before this one."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_w").over(w), F.lit(0))


def quantiles_of_counts(counts: DataFrame, groups: list[str], value: str, probs: list[float], names: list[str]) -> DataFrame:
    """One row per group (null groups too): ``names`` hold the quantiles
    ``probs`` with linear interpolation, ``_n`` the rows."""
    # Columns that cannot be null draw no filters from the joins below, so all
    # three steps read one and the same exchange of counts.
    v = F.coalesce(F.col(value).cast("double"), F.lit(0.0))
    key = F.struct(*[F.col(g) for g in groups]) if groups else F.struct(F.lit(0).alias("_all"))
    base = counts.select(key.alias("_k"), v.alias("_v"), "_w", bucket(v, COARSE).alias("_b"), bucket(v, FINE).alias("_f"))
    at = lambda p: (F.col("_n") - 1) * F.lit(float(p))
    ranks = [r for p in probs for r in (F.floor(at(p)), F.ceil(at(p)))]

    def wanted(df: DataFrame) -> DataFrame:
        """Buckets in which a rank lies: ranks [_before, _before + _w)."""
        inside = F.lit(False)
        for r in ranks:
            inside = inside | ((r >= F.col("_before")) & (r < F.col("_before") + F.col("_w")))
        return df.where(inside)

    coarse = base.groupBy("_k", "_b").agg(F.sum("_w").alias("_w"))
    coarse = wanted(coarse.select("_k", "_b", "_w", running(["_k"], "_b").alias("_before"),
                                  F.sum("_w").over(Window.partitionBy("_k")).alias("_n")))
    fine = (base.join(coarse.select("_k", "_b", "_n", "_before"), ["_k", "_b"])
            .groupBy("_k", "_b", "_f", "_n", "_before").agg(F.sum("_w").alias("_w")))
    fine = wanted(fine.select("_k", "_b", "_f", "_n", "_w", (F.col("_before") + running(["_k", "_b"], "_f")).alias("_before")))
    last = (base.join(fine.select("_k", "_b", "_f", "_n", "_before"), ["_k", "_b", "_f"])
            .select("_k", "_v", "_n", "_w", (F.col("_before") + running(["_k", "_b", "_f"], "_v")).alias("_before")))
    picks = [F.max(F.when((r >= F.col("_before")) & (r < F.col("_before") + F.col("_w")), F.col("_v"))).alias(f"_r{i}")
             for i, r in enumerate(ranks)]
    found = last.groupBy("_k", "_n").agg(*picks)
    between = []
    for i, (p, name) in enumerate(zip(probs, names)):
        lo, hi = F.col(f"_r{2 * i}"), F.col(f"_r{2 * i + 1}")
        between.append((lo + (hi - lo) * (at(p) - F.floor(at(p)))).alias(name))
    return found.select(*[F.col("_k")[g].alias(g) for g in groups], "_n", *between)


def quantiles_by(df: DataFrame, groups: list[str], columns: list[str], probs: list[float], names: list[str]) -> DataFrame:
    """(_column, groups, _n, names) of several columns from one exchange."""
    return quantiles_of_counts(stacked_counts(df, groups, columns), ["_column", *groups], "_v", probs, names)


def wide(found: DataFrame, groups: list[str], columns: list[str], names: list[str]) -> DataFrame:
    """One row per group: ``<column>__<name>`` of each column (null where it has no value)."""
    return found.groupBy(*groups).agg(*[
        F.max(F.when(F.col("_column") == c, F.col(n))).alias(f"{c}__{n}") for c in columns for n in names])


def join_groups(left: DataFrame, right: DataFrame, groups: list[str], how: str = "left") -> DataFrame:
    """Join of two group tables in which null is a group like others."""
    renamed = right.select(*[F.col(g).alias(f"_g_{g}") for g in groups], *[c for c in right.columns if c not in groups])
    same = F.lit(True)
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return left.join(renamed, same, how).drop(*[f"_g_{g}" for g in groups])
