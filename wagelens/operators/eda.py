"""EDA aggregates.

Each table is one lazy DataFrame over Silver / training.  Group facts are
partial aggregates; per-group statistics that rows are compared with are
stored, checked for size and broadcast, so the rows are not shuffled on a
few group keys.  All quantiles are exact (linear interpolation, same as
pandas) and come from distributed value counts (``quantiles``);
``exact=False`` of some tables switches to ``percentile_approx``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagelens.functions.columns import attach_scalars, false_if_null, g1_skew_correction
from wagelens.operators.quantiles import (checked_broadcast, join_groups, quantiles_by, quantiles_of_counts, value_counts,
                                          wide)


def approx_quantile(c: str | Column, q, accuracy: int = 1_000_000) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.percentile_approx(c, q if not isinstance(q, (list, tuple)) else list(q), accuracy)


def skew_g1(c: str) -> Column:
    """Bias-corrected sample skewness (pandas ``skew``); null for n < 3."""
    n = F.count(c)
    return F.when(n >= 3, F.skewness(c) * g1_skew_correction(n))


def coverage_by_group(silver: DataFrame, group: str = "country") -> DataFrame:
    """G1: canonical postings, model-ready, unlabelled and coverage %."""
    s = F.col("salary_quality_status")
    return (silver.where(F.col("duplicate_action") == "keep")
            .groupBy(group)
            .agg(F.count(F.lit(1)).alias("total_postings"),
                 F.sum((s == "model_ready").cast("long")).alias("model_ready"),
                 F.sum((s == "unlabeled").cast("long")).alias("unlabeled"))
            .withColumn("coverage_pct", F.round(100.0 * F.col("model_ready") / F.col("total_postings"), 6)))


def share_by_group(df: DataFrame, group: str, flag: str, name: str | None = None) -> DataFrame:
    """% of rows with a true boolean, per group."""
    return (df.where(F.col(group).isNotNull()).groupBy(group)
            .agg(F.count(F.lit(1)).alias("postings"),
                 F.round(F.avg(F.col(flag).cast("int")) * 100, 6).alias(name or f"{flag}_pct")))


def coverage_two_keys(silver: DataFrame, a: str = "job_level", b: str = "is_remote") -> DataFrame:
    """Postings and labelled share by two keys, with a display label."""
    return (silver.groupBy(a, b)
            .agg(F.count(F.lit(1)).alias("postings"),
                 F.round(F.avg(F.col("salary_avg").isNotNull().cast("int")) * 100, 6).alias("labelled_pct"))
            .withColumn("label", F.concat_ws(" / ", F.col(a).cast("string"),
                                             F.when(F.col(b), "Remote").otherwise("Not Remote"))))


def group_summary(df: DataFrame, groups: list[str], value: str, exact: bool = True) -> DataFrame:
    """N, mean, median, min, max, bias-corrected skew per group."""
    v = F.col(value)
    data = df.where(v.isNotNull())
    stats = data.groupBy(*groups).agg(
        F.count(v).alias("n"), F.round(F.avg(v), 6).alias("mean"), F.round(approx_quantile(v, 0.5), 6).alias("median"),
        F.round(F.min(v), 6).alias("min"), F.round(F.max(v), 6).alias("max"), F.round(skew_g1(value), 6).alias("skew"))
    if exact:
        middle = quantiles_of_counts(value_counts(df, groups, value), groups, value, [0.5], ["_m"])
        stats = join_groups(stats.drop("median"), middle.drop("_n"), groups).withColumn("median", F.round("_m", 6))
    return stats.select(*groups, "n", "mean", "median", "min", "max", "skew")


def local_vs_usd_medians(df: DataFrame, groups=("country", "currency")) -> DataFrame:
    """Medians of the local and converted salary per group."""
    return medians_with(df, list(groups), {"salary_avg_local": "median_local", "salary_avg_usd": "median_usd"},
                        [F.count(F.lit(1)).alias("postings")])


def medians_with(df: DataFrame, groups: list[str], names: dict[str, str], aggs: list[Column]) -> DataFrame:
    """Plain aggregates and the medians of some columns per group."""
    middle = wide(quantiles_by(df, groups, list(names), [0.5], ["m"]), groups, list(names), ["m"])
    plain = df.groupBy(*groups).agg(*aggs)
    return join_groups(plain, middle, groups).select(*plain.columns, *[F.round(f"{c}__m", 6).alias(n) for c, n in names.items()])


def range_summary(df: DataFrame, groups=("country", "job_level"), value: str = "salary_range_usd") -> DataFrame:
    """Salary range size / median / mean by groups, non-null only."""
    v = F.col(value)
    return medians_with(df.where(v.isNotNull()), list(groups), {value: "median_range"},
                        [F.count(F.lit(1)).alias("postings"), F.round(F.avg(v), 6).alias("mean_range")])


def median_by(df: DataFrame, groups, value: str = "salary_avg_usd", name: str = "median_salary_usd") -> DataFrame:
    """Postings and median per group (role family x country)."""
    return medians_with(df, list(groups), {value: name}, [F.count(F.lit(1)).alias("postings")])


def mix_counts(df: DataFrame, groups) -> DataFrame:
    """Rows per group combination."""
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias("postings"))


def histogram(df: DataFrame, value: str, bins: int = 30, groups: list[str] | None = None) -> DataFrame:
    """Equal-width histogram over [min, max] (numpy edges: last bin
    closed).  Bounds come from a one-row aggregate (or one row per group)."""
    groups = groups or []
    v = F.col(value)
    data = df.where(v.isNotNull())
    if groups:
        bounds = data.groupBy(*groups).agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"))
        joined = data.join(checked_broadcast(bounds), groups)
    else:
        bounds = data.agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"))
        joined = attach_scalars(data, bounds)
    width = (F.col("_hi") - F.col("_lo")) / bins
    idx = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((v - F.col("_lo")) / width), F.lit(bins - 1))).cast("int")
    out = (joined.withColumn("bin", idx)
           .groupBy(*groups, "bin", "_lo", "_hi").agg(F.count(F.lit(1)).alias("count")))
    w = (F.col("_hi") - F.col("_lo")) / bins
    return out.select(*groups, "bin",
                      F.round(F.col("_lo") + F.col("bin") * w, 6).alias("bin_lo"),
                      F.round(F.col("_lo") + (F.col("bin") + 1) * w, 6).alias("bin_hi"), "count")


def kde_grid(df: DataFrame, value: str, grid_points: int = 200) -> DataFrame:
    """Gaussian KDE (Scott bandwidth, as ``gaussian_kde``) on an evenly
    spaced grid over [min, max].  Equal values are pre-aggregated, each
    distinct value emits one contribution per grid point (``grid_points``
    is a fixed bound), and the contributions are combined map-side."""
    v = F.col(value)
    data = df.where(v.isNotNull())
    stats = data.agg(F.count(v).alias("_n"), F.stddev_samp(v).alias("_sd"),
                     F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    distinct = data.groupBy(v.alias("_x")).agg(F.count(F.lit(1)).alias("_w"))
    bw = F.col("_sd") * F.pow(F.col("_n"), F.lit(-0.2))
    step = (F.col("_hi") - F.col("_lo")) / max(grid_points - 1, 1)
    pts = (attach_scalars(distinct, stats)
           .withColumn("grid", F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))))
           .withColumn("x", F.col("_lo") + F.col("grid") * step)
           .withColumn("_z", (F.col("x") - F.col("_x")) / bw)
           .withColumn("_k", F.col("_w") * F.exp(-0.5 * F.col("_z") * F.col("_z"))))
    return (pts.groupBy("grid", "x", "_n", "_sd")
            .agg(F.sum("_k").alias("_s"))
            .select("grid", F.round("x", 6).alias("x"),
                    F.round(F.col("_s") / (F.col("_n") * F.col("_sd") * F.pow(F.col("_n"), F.lit(-0.2))
                                           * math.sqrt(2 * math.pi)), 12).alias("density")))


#: Cells of the linear binning between the least and the largest value of a group.
KDE_CELLS = 1024


def kde_binned(df: DataFrame, value: str, groups: list[str], grid_points: int = 200, cells: int = KDE_CELLS) -> DataFrame:
    """G11 on continuous values, by group: Gaussian KDE (Scott bandwidth) on an
    even grid over the group's [min, max].

    A value is dealt to the two ends of its cell in proportion to its place in
    it (linear binning), counted map-side; the kernel then runs over the cell
    ends only, so its cost is groups x cells x grid points however many values
    there are.  With cell width d and bandwidth h the density is off by at most
    ``0.3989 * d**2 / (8 * h**3)`` (the largest second derivative of the
    kernel).  Density is null where the bandwidth is not positive."""
    v = F.col(value)
    data = df.where(v.isNotNull()).select(*groups, v.cast("double").alias("_v"))
    stats = data.groupBy(*groups).agg(F.count("_v").alias("_n"), F.stddev_samp("_v").alias("_sd"),
                                      F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    stats = checked_broadcast(stats)
    cell = (F.col("_hi") - F.col("_lo")) / cells
    place = F.when(cell > 0, (F.col("_v") - F.col("_lo")) / cell).otherwise(F.lit(0.0))
    low = F.least(F.floor(place), F.lit(cells - 1))
    ends = F.array(F.struct(low.alias("_j"), (1 - (place - low)).alias("_w")), F.struct((low + 1).alias("_j"), (place - low).alias("_w")))
    weights = (join_groups(data, stats, groups, "inner").select(*groups, F.inline(ends))
               .groupBy(*groups, "_j").agg(F.sum("_w").alias("_w")))
    step = (F.col("_hi") - F.col("_lo")) / max(grid_points - 1, 1)
    width = F.col("_sd") * F.pow(F.col("_n"), F.lit(-0.2))
    z = (F.col("x") - (F.col("_lo") + F.col("_j") * cell)) / F.col("_h")
    points = (join_groups(weights, stats, groups, "inner").withColumn("_h", F.when(width > 0, width))
              .withColumn("grid", F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))))
              .withColumn("x", F.col("_lo") + F.col("grid") * step).withColumn("_k", F.col("_w") * F.exp(-0.5 * z * z)))
    return (points.groupBy(*groups, "grid", "x", "_n", "_h").agg(F.sum("_k").alias("_s"))
            .select(*groups, "grid", F.round("x", 6).alias("x"),
                    F.round(F.col("_s") / (F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi)), 12).alias("density")))


def box_stats(df: DataFrame, groups: list[str], value: str, exact: bool = True) -> DataFrame:
    """Q1, median, Q3, IQR and Tukey whiskers (last point within
    1.5 IQR) per group.  Quantiles and whiskers both come from the counts
    of distinct values; the rows themselves are read once."""
    v = F.col(value)
    data = value_counts(df, groups, value)
    if exact:
        q = quantiles_of_counts(data, groups, value, [0.25, 0.5, 0.75], ["q1", "median", "q3"]).withColumnRenamed("_n", "n")
    else:
        q = (df.where(v.isNotNull()).groupBy(*groups)
             .agg(approx_quantile(v, [0.25, 0.5, 0.75]).alias("_q"), F.count(v).alias("n"))
             .select(*groups, "n", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"), F.col("_q")[2].alias("q3")))
    j = data.join(q.withColumn("iqr", F.col("q3") - F.col("q1")), groups)
    lo_f = F.col("q1") - 1.5 * F.col("iqr")
    hi_f = F.col("q3") + 1.5 * F.col("iqr")
    return (j.groupBy(*groups, "n", "q1", "median", "q3", "iqr")
            .agg(F.min(F.when(v >= lo_f, v)).alias("whisker_low"),
                 F.max(F.when(v <= hi_f, v)).alias("whisker_high"))
            .select(*groups, "n", *[F.round(c, 6).alias(c) for c in
                                    ["q1", "median", "q3", "iqr", "whisker_low", "whisker_high"]]))


def skew_comparison(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """N, mean, median, skew for several columns (raw vs log)."""
    aggs = []
    for label, c in columns.items():
        aggs += [F.count(c).alias(f"{label}__n"), F.avg(c).alias(f"{label}__mean"), skew_g1(c).alias(f"{label}__skew")]
    row = df.agg(*aggs)
    stats = row.select(F.inline(F.array(*[
        F.struct(F.lit(label).alias("scale"), F.lit(c).alias("_c"), F.col(f"{label}__n").alias("n"),
                 F.round(F.col(f"{label}__mean"), 6).alias("mean"), F.round(F.col(f"{label}__skew"), 6).alias("skew"))
        for label, c in columns.items()])))
    middle = quantiles_by(df, [], list(dict.fromkeys(columns.values())), [0.5], ["_m"]).select(F.col("_column").alias("_c"), "_m")
    return stats.join(middle, "_c", "left").select("scale", "n", "mean", F.round("_m", 6).alias("median"), "skew")


def iqr_fences(df: DataFrame, groups: list[str], value: str, k: float = 1.5, exact: bool = True) -> DataFrame:
    """Per-group Q1/Q3 fences joined to every row, with an outlier flag."""
    v = F.col(value)
    if exact:
        quartiles = quantiles_of_counts(value_counts(df, groups, value), groups, value, [0.25, 0.75], ["q1", "q3"]).drop("_n")
    else:
        quartiles = (df.where(v.isNotNull()).groupBy(*groups).agg(approx_quantile(v, [0.25, 0.75]).alias("_q"))
                     .select(*groups, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("q3")))
    fences = (quartiles
              .withColumn("iqr", F.col("q3") - F.col("q1"))
              .withColumn("lower_fence", F.col("q1") - k * F.col("iqr"))
              .withColumn("upper_fence", F.col("q3") + k * F.col("iqr")))
    out = df.join(checked_broadcast(fences), groups, "left")
    return out.withColumn("is_outlier", false_if_null((v < F.col("lower_fence")) | (v > F.col("upper_fence")))) \
              .withColumn("outlier_side", F.when(false_if_null(v < F.col("lower_fence")), "low")
                          .when(false_if_null(v > F.col("upper_fence")), "high"))


def outlier_counts(flagged: DataFrame, groups: list[str]) -> DataFrame:
    """Outliers per group and side."""
    return (flagged.groupBy(*groups)
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.count(F.when(F.col("is_outlier"), 1)).alias("outliers"),
                 F.count(F.when(F.col("outlier_side") == "low", 1)).alias("low_outliers"),
                 F.count(F.when(F.col("outlier_side") == "high", 1)).alias("high_outliers")))


def threshold_sweep(df: DataFrame, value: str, thresholds: list[float]) -> DataFrame:
    """Rows strictly below each cut-off (one scan)."""
    v = F.col(value)
    row = df.agg(*[F.sum(false_if_null(v < t).cast("long")).alias(f"t{i}") for i, t in enumerate(thresholds)],
                 F.count(v).alias("_n"))
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(float(t)).alias("threshold"), F.col(f"t{i}").cast("bigint").alias("rows_below"),
                 F.round(100.0 * F.col(f"t{i}") / F.col("_n"), 6).alias("pct_below"))
        for i, t in enumerate(thresholds)])))


def top_k(df: DataFrame, order: list[Column], k: int, columns: list[str]) -> DataFrame:
    """K rows by an explicit total order (TakeOrderedAndProject:
    per-partition top-k, then one merge of k x partitions rows)."""
    return df.select(*columns).orderBy(*order).limit(k)
