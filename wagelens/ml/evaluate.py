"""Evaluation tables.

Metrics are single aggregates (MAE, RMSE, R^2 with SST = var_pop * n and
a zero-SST guard).  Cross-validation of the group-mean baseline is fully
declarative: per-(group, fold) sums give every leave-one-fold-out mean,
each row is expanded over the k folds (k is a fixed bound) and one
aggregate returns all fold scores.  MLlib models go through stored encoded
folds (``candidates.cross_validate``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagelens.functions.columns import attach_row, attach_scalars

from wagelens.operators.quantiles import checked_broadcast, quantiles_of_counts, value_counts
from wagelens.rules import INDUSTRY_MAE_USD, LEGACY_MAE_USD


def metric_aggs(y: str | Column, p: str | Column) -> list[Column]:
    y = F.col(y) if isinstance(y, str) else y
    p = F.col(p) if isinstance(p, str) else p
    n = F.count(y)
    sse = F.sum((y - p) * (y - p))
    sst = F.var_pop(y) * n
    r2 = F.when(sst > 0, 1 - sse / sst).when(n > 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return [F.avg(F.abs(y - p)).alias("MAE"), F.sqrt(F.avg((y - p) * (y - p))).alias("RMSE"), r2.alias("R2")]


def metrics(df: DataFrame, label: str = "actual", prediction: str = "predicted") -> DataFrame:
    """One-row MAE / RMSE / R^2."""
    return df.agg(*metric_aggs(label, prediction))


def usd_metrics_from_log(df: DataFrame, label_log: str, pred_log: str) -> DataFrame:
    """Score a log-scale model in USD (expm1 on both sides)."""
    return df.agg(*metric_aggs(F.expm1(label_log), F.expm1(pred_log)))


def group_mean_cv(dev: DataFrame, groups: list[str], label: str, fold: str = "fold", k: int = 5,
                  key: str = "job_id") -> tuple[DataFrame, DataFrame]:
    """I7 + I8 for the group-mean baseline in one pass.

    Returns (summary, oof): summary has CV_MAE, CV_MAE_SD, CV_RMSE, CV_R2,
    Train_MAE; oof has key, fold, prediction for every development row."""
    y = F.col(label)
    per = dev.groupBy(*groups, fold).agg(F.sum(y).alias("_s"), F.count(y).alias("_n"))
    glob = dev.groupBy(fold).agg(F.sum(y).alias("_gs"), F.count(y).alias("_gn"))
    tot = glob.agg(F.sum("_gs").alias("_ts"), F.sum("_gn").alias("_tn"))
    gtot = per.groupBy(*groups).agg(F.sum("_s").alias("_gsum"), F.sum("_n").alias("_gcnt"))
    folds = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_k")
    # Leave-fold-k-out mean per group (small: groups x k).
    means = (gtot.select("*", folds)
             .join(per.withColumnRenamed(fold, "_k"), [*groups, "_k"], "left")
             .select(*groups, "_k", F.try_divide(F.col("_gsum") - F.coalesce("_s", F.lit(0)),
                                                 F.col("_gcnt") - F.coalesce("_n", F.lit(0))).alias("_gm")))
    fallback = (attach_scalars(glob.withColumnRenamed(fold, "_k"), tot)
                .select("_k", F.try_divide(F.col("_ts") - F.col("_gs"), F.col("_tn") - F.col("_gn")).alias("_fm")))
    rows = (dev.select(key, *groups, fold, label, folds)
            .join(checked_broadcast(means), [*groups, "_k"], "left").join(F.broadcast(fallback), "_k", "left")
            .withColumn("prediction", F.coalesce("_gm", "_fm"))
            .withColumn("_role", F.when(F.col(fold) == F.col("_k"), "val").otherwise("train")))
    per_fold = rows.groupBy("_k", "_role").agg(*metric_aggs(label, "prediction"))
    val = per_fold.where("_role = 'val'")
    train = per_fold.where("_role = 'train'")
    summary = val.agg(F.avg("MAE").alias("CV_MAE"), F.stddev_pop("MAE").alias("CV_MAE_SD"),
                      F.avg("RMSE").alias("CV_RMSE"), F.avg("R2").alias("CV_R2"))
    summary = attach_scalars(summary, train.agg(F.avg("MAE").alias("Train_MAE")))
    oof = rows.where("_role = 'val'").select(key, fold, "prediction")
    return summary, oof


def prediction_audit(scored: DataFrame, label: str, prediction: str = "prediction",
                     keep=("job_id", "country", "job_level", "salary_segment", "job_title", "search_keyword")) -> DataFrame:
    """Actual, predicted, residual, absolute error per row."""
    return scored.select(*keep, F.col(label).alias("actual_salary"), F.col(prediction).alias("predicted_salary")) \
        .withColumn("residual", F.col("actual_salary") - F.col("predicted_salary")) \
        .withColumn("absolute_error", F.abs("residual"))


def segment_performance(audit: DataFrame, group: str) -> DataFrame:
    """Rows, MAE, RMSE, R^2 (null under two rows), mean residual and
    underprediction % per segment."""
    y, p = F.col("actual_salary"), F.col("predicted_salary")
    n = F.count(F.lit(1))
    sse = F.sum((y - p) * (y - p))
    sst = F.var_pop(y) * n
    r2 = F.when(n < 2, F.lit(None).cast("double")).when(sst > 0, 1 - sse / sst) \
        .otherwise(F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return audit.groupBy(group).agg(
        n.alias("Rows"), F.avg(F.abs(y - p)).alias("MAE"), F.sqrt(F.avg((y - p) * (y - p))).alias("RMSE"),
        r2.alias("R2"), F.avg(y - p).alias("Mean_Residual"),
        (100 * F.avg((y - p > 0).cast("double"))).alias("Underprediction_Rate"))


def residual_summary(audit: DataFrame) -> DataFrame:
    """Residual describe + over / under prediction shares."""
    r = F.col("residual")
    names = ["q25", "q50", "q75"]
    q = quantiles_of_counts(value_counts(audit, [], "residual"), [], "residual", [0.25, 0.5, 0.75], names)
    stats = audit.agg(F.count(r).alias("count"), F.avg(r).alias("mean"), F.stddev_samp(r).alias("std"),
                      F.min(r).alias("min"), F.max(r).alias("max"),
                      (100 * F.avg((r < 0).cast("double"))).alias("overprediction_pct"),
                      (100 * F.avg((r > 0).cast("double"))).alias("underprediction_pct"))
    return attach_row(stats, q.select(*names)).select(
        "count", "mean", "std", "min", *names, "max", "overprediction_pct", "underprediction_pct")


def diagonal_bounds(audit: DataFrame) -> DataFrame:
    """Common min / max of actual and predicted (plot diagonal)."""
    return audit.agg(F.least(F.min("actual_salary"), F.min("predicted_salary")).alias("minimum"),
                     F.greatest(F.max("actual_salary"), F.max("predicted_salary")).alias("maximum"))


def worst_bias(segments: DataFrame, group: str) -> DataFrame:
    """Segment with the largest mean residual (ties -> smallest key)."""
    return segments.agg(F.max_by(F.col(group), F.col("Mean_Residual")).alias(group),
                        F.max("Mean_Residual").alias("Mean_Residual"))


def benchmark_verdict(metrics_row: DataFrame, legacy: float = LEGACY_MAE_USD,
                      industry: float | None = INDUSTRY_MAE_USD) -> DataFrame:
    """Improvement over the legacy MAE and the decision (two-level, or
    three-level when an industry target is given)."""
    mae = F.col("MAE")
    imp = F.lit(legacy) - mae
    if industry is None:
        decision = F.when(mae < legacy, "pilot").otherwise("keep_legacy")
    else:
        decision = (F.when(mae < industry, "meets_industry_target")
                    .when(mae < legacy, "beats_legacy").otherwise("keep_legacy"))
    return metrics_row.select(mae.alias("MAE"), imp.alias("improvement_usd"),
                              (100 * imp / legacy).alias("improvement_pct"), decision.alias("decision"))


def scoring_contract(scoring: DataFrame, scored: DataFrame, prediction: str) -> DataFrame:
    """Scored rows equal input rows; every prediction finite."""
    p = F.col(prediction)
    a = scoring.agg(F.count(F.lit(1)).alias("input_rows"))
    b = scored.agg(F.count(F.lit(1)).alias("scored_rows"),
                   F.count(F.when(p.isNull() | F.isnan(p) | (F.abs(p) == float("inf")), 1)).alias("non_finite"))
    return attach_scalars(a, b).withColumn("contract_ok", (F.col("input_rows") == F.col("scored_rows"))
                                     & (F.col("non_finite") == 0))


def overfit_depth(results: DataFrame, tolerance: float = 1.02) -> DataFrame:
    """I13 rule as a query: first depth above the best whose validation MAE
    exceeds tolerance x best (null -> not detected)."""
    best = results.orderBy("Validation_MAE", "max_depth").limit(1) \
        .select(F.col("max_depth").alias("best_depth"), F.col("Validation_MAE").alias("best_mae"))
    cand = attach_scalars(results, best).where((F.col("max_depth") > F.col("best_depth"))
                                         & (F.col("Validation_MAE") > F.col("best_mae") * tolerance))
    first = cand.agg(F.min("max_depth").alias("overfit_depth"))
    return attach_scalars(best, first)
