import os
import tempfile

from pyspark.sql import functions as F

from smoke_data import SMOKE
from wagelens.ml import models, scoring
from wagelens.ml.features import CAPSTONE_SPEC, FEATURE_SPECS
from wagelens.plans.silver import build_silver, scoring_layer, training_layer
from wagelens.sources.postings import postings
from wagelens.streaming.scoring_stream import run_to_completion


def _silver(spark):
    return build_silver(postings(spark, SMOKE)).cache()


def test_save_load_gives_identical_predictions(spark):
    s = _silver(spark)
    spec = FEATURE_SPECS["Core + nonredundant engineered"]
    m = scoring.fit_scoring_model(training_layer(s), spec, models.linear_regression("label"))
    path = os.path.join(tempfile.mkdtemp(dir="/tmp"), "model")
    scoring.save_model(m, path, {"selected_feature_set": "x"})
    r = scoring.load_model(path)
    sc = scoring_layer(s)
    a = m.transform(sc).select("job_id", F.col("predicted_salary_usd").alias("a"))
    b = r.transform(sc).select("job_id", F.col("predicted_salary_usd").alias("b"))
    j = a.join(b, "job_id")
    assert j.count() == sc.count() and j.where("a <> b").count() == 0


def test_stream_output_equals_batch_output(spark):
    s = _silver(spark)
    t = scoring.prepare_requests(training_layer(s).withColumn(
        "experience_required", F.coalesce("experience_required_clean", F.lit(0.0))))
    m = scoring.fit_scoring_model(t, CAPSTONE_SPEC, models.random_forest(20, 5, 2, 0.7, label="label"))
    req = scoring.capstone_requests_from(scoring_layer(s))
    base = tempfile.mkdtemp(dir="/tmp")
    req.repartition(3).write.parquet(os.path.join(base, "src"))
    streamed = run_to_completion(spark, m, os.path.join(base, "src"), req.schema, os.path.join(base, "out"),
                                 os.path.join(base, "ckpt"))
    batch = m.transform(scoring.prepare_requests(req)).select("job_id", "predicted_salary_usd")
    diff = streamed.join(batch.withColumnRenamed("predicted_salary_usd", "b"), "job_id") \
        .where(F.abs(F.col("predicted_salary_usd") - F.col("b")) > 1e-9)
    assert streamed.count() == req.count() and diff.count() == 0
