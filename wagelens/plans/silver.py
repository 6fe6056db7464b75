"""Bronze -> Silver -> Gold/scoring/review plan (one lazy DataFrame each).

The Silver plan is: narrow normalisation projection -> one shuffle on the
posting fingerprint (duplicate audit) -> narrow projections for currency,
flags, status and features.  Callers that reuse Silver for many tables
persist it once: the audited rows up to the status (``build_audited``), on
which ``derive`` puts the features a table reads, as narrow projections.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagelens.operators import clean, dedup, skills
from wagelens.operators.profile import enforce_contract
from wagelens.functions.columns import normalized_key
from wagelens.rules import REVIEW_STATUSES, STRICT, RuleSet


def build_silver(bronze: DataFrame, rules: RuleSet = STRICT, enforce: bool = True) -> DataFrame:
    """Silver rows of a Bronze table."""
    return derive(build_audited(bronze, rules, enforce), rules)


def build_audited(bronze: DataFrame, rules: RuleSet = STRICT, enforce: bool = True) -> DataFrame:
    """Silver up to the quality status: everything that needs the shuffle or
    decides a layer.  With ``enforce`` (the default) a
    Bronze that breaks its contract raises before anything is planned.
    The fingerprinted rows are not persisted here: the group-facts branch
    prunes to the key columns, so recomputing their normalisation and
    SHA-1 is cheaper than holding a second full copy of the table next to
    the persisted Silver (measured: 4.9 s vs 5.3 s at sf0.1)."""
    if enforce:
        enforce_contract(bronze)
    df = clean.normalize_strings(bronze)
    df = dedup.duplicate_audit(df, rules, already_normalized=True, reuse_input=False)
    df = clean.add_currency(df)
    df = clean.add_usd(df)
    if rules.bounds_rule == "null_out":
        df = clean.repair_salary(clean.salary_issue_flags(df), rules.repair_disordered)
        df = clean.add_usd(df.drop(*[f"{c}_{s}" for c in clean.SALARY_COLUMNS for s in ("local", "usd")]))
        if rules.target_floor_usd is not None:
            df = clean.drop_tiny_targets(df, rules.target_floor_usd)
    df = clean.salary_flags(df, rules)
    return clean.quality_status(df, rules)


def derive(audited: DataFrame, rules: RuleSet = STRICT) -> DataFrame:
    """The feature columns of Silver: narrow, so a table computes only those
    it reads and none of them is stored."""
    df = clean.experience_features(audited, rules)
    df = clean.seniority(df)
    df = skills.skill_features(df, rules)
    df = df.withColumn("job_title_text", normalized_key("job_title", already_normalized=True))
    df = clean.log_target(df, guard_positive=rules.log_guard_positive)
    return df


def persist_silver(silver: DataFrame) -> DataFrame:
    return silver.persist(StorageLevel.MEMORY_AND_DISK)


def training_layer(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("salary_quality_status") == "model_ready")


def scoring_layer(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("salary_quality_status") == "unlabeled")


def review_layer(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("salary_quality_status").isin(*REVIEW_STATUSES))


def layer_counts(silver: DataFrame) -> DataFrame:
    """F1/F2/A10: rows per layer in one aggregate (one scan of Silver)."""
    s = F.col("salary_quality_status")
    return silver.agg(
        F.count(F.lit(1)).alias("silver"),
        F.sum((s == "model_ready").cast("long")).alias("training"),
        F.sum((s == "unlabeled").cast("long")).alias("scoring"),
        F.sum(s.isin(*REVIEW_STATUSES).cast("long")).alias("review"),
        F.sum((s == "duplicate_removed").cast("long")).alias("duplicate_removed"),
    )
