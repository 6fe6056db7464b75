"""Refit + batch scoring (I25), scoring requests (I28) and model
persistence (A11).

A fitted ``PipelineModel`` (preprocessor + regressor, plus an optional
``expm1`` stage for log-target models) is the deployable unit: it is saved
to the shared checkpoint folder, reloaded, and applied to any number of
rows with ``transform`` - the same object the streaming scorer uses.
"""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagelens.functions.columns import right_closed_bucket
from wagelens.ml.features import preprocessor
from wagelens.rules import ALL_SKILLS, STRICT, TierRule, skill_column

# Scoring-form experience tiers: <=2, <=5, <=10, else (input range 0..40).
APP_TIER = TierRule((float("-inf"), 2, 5, 10, float("inf")),
                    ("Entry", "Intermediate", "Experienced", "Highly Experienced"))


def expm1_stage(col: str = "prediction", out: str = "predicted_salary_usd") -> SQLTransformer:
    """Last stage of a log-target model: back to USD."""
    return SQLTransformer(statement=f"SELECT *, expm1({col}) AS {out} FROM __THIS__")


def identity_stage(col: str = "prediction", out: str = "predicted_salary_usd") -> SQLTransformer:
    return SQLTransformer(statement=f"SELECT *, {col} AS {out} FROM __THIS__")


def fit_scoring_model(training: DataFrame, spec: dict, regressor, log_target: bool = True,
                      label_source: str = "salary_avg_usd") -> PipelineModel:
    """Fit preprocessor + regressor on all labelled rows.  The log
    label is made outside the pipeline (a label stage inside it would fail
    on unlabelled rows at scoring time)."""
    label = regressor.getOrDefault("labelCol")
    data = training.withColumn(label, F.log1p(label_source) if log_target else F.col(label_source))
    pre = preprocessor(spec).fit(data)
    reg = regressor.fit(pre.transform(data))
    last = expm1_stage() if log_target else identity_stage()
    return PipelineModel([pre, reg, last])


def score_pool(model: PipelineModel, scoring: DataFrame,
               keep=("job_id", "job_title", "company", "country", "job_level", "salary_segment")) -> DataFrame:
    """Batch predictions for the unlabelled pool."""
    return model.transform(scoring).select(*keep, "predicted_salary_usd")


def prepare_requests(requests: DataFrame) -> DataFrame:
    """Derive the model columns of a scoring request from raw inputs:
    experience tier from years, skill count from the selected skills."""
    out = requests.withColumn("experience_tier", right_closed_bucket("experience_required", APP_TIER))
    total = F.lit(0)
    for s in ALL_SKILLS:
        total = total + F.col(skill_column(s))
    return out.withColumn("num_skills", total.cast("int"))


def save_model(model: PipelineModel, path: str, contract: dict | None = None) -> None:
    """Persist the fitted pipeline (and its JSON contract) to shared storage."""
    model.write().overwrite().save(path)
    if contract is not None:
        spark = __import__("pyspark.sql", fromlist=["SparkSession"]).SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(contract),)], "contract string") \
            .coalesce(1).write.mode("overwrite").text(path + "_contract")


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def capstone_requests_from(scoring: DataFrame) -> DataFrame:
    """Scoring requests in the 14-column form, derived from unlabelled rows
    (raw years and selected skills only; tier and count are re-derived)."""
    return scoring.select("job_id", "job_level", "country", "is_remote",
                          F.coalesce("experience_required_clean", F.lit(0.0)).alias("experience_required"),
                          *[skill_column(s) for s in ALL_SKILLS])
