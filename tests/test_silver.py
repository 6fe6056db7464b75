import pytest
from pyspark.sql import functions as F

from smoke_data import SMOKE
from wagelens.plans.silver import build_silver
from wagelens.rules import BEGINNER, CAPSTONE, PHASE1, STRICT
from wagelens.sources.postings import postings


def test_fixture_matches_published_counts(spark):
    b = postings(spark, SMOKE)
    r = b.agg(F.count("*").alias("n"), F.count_distinct("job_id").alias("ids"), F.sum("num_skills").alias("sk"),
              F.sum(F.col("has_salary").cast("int")).alias("hs"), F.sum(F.col("is_remote").cast("int")).alias("rm"),
              F.sum(F.col("salary_avg").isNull().cast("int")).alias("na")).first()
    assert (r.n, r.ids, r.sk, r.hs, r.rm, r.na) == (1500, 1500, 1872, 817, 503, 673)


def test_strict_status_counts_and_layer_identity(spark):
    s = build_silver(postings(spark, SMOKE), STRICT)
    counts = {r[0]: r[1] for r in s.groupBy("salary_quality_status").count().collect()}
    assert counts == {"model_ready": 733, "unlabeled": 654, "duplicate_conflict": 34, "duplicate_removed": 21,
                      "invalid_bounds": 13, "unit_review": 21, "midpoint_mismatch": 9, "review_other": 15}
    # silver = training + scoring + review + duplicate_removed
    assert sum(counts.values()) == s.count()
    # one canonical row per fingerprint among training + scoring
    kept = s.where(F.col("salary_quality_status").isin("model_ready", "unlabeled"))
    assert kept.groupBy("posting_fingerprint").count().where("count > 1").count() == 0
    # training rows all have a positive target and complete bounds
    tr = s.where("salary_quality_status = 'model_ready'")
    assert tr.where("salary_avg_usd <= 0 OR salary_min IS NULL OR salary_max IS NULL").count() == 0


GOLDEN = [  # (country, min, max, avg, phase1 status, strict status)  -- rows of the published review queue
    ("India", 400000.0, 1000000.0, 700000.0, "unit_review", "model_ready"),
    ("India", 0.0, 800000.0, 400000.0, "invalid_bounds", "invalid_bounds"),
    ("India", 250000.0, 300000.0, 275000.0, "unit_review", "model_ready"),
    ("India", 120000.0, 300000.0, 210000.0, "unit_review", "unit_review"),
    ("India", 12.0, 144.0, 78.0, "unit_review", "unit_review"),
    ("Canada", 4500.0, 6000.0, 5250.0, "unit_review", "unit_review"),
    ("Canada", 10000.0, None, 10000.0, "invalid_bounds", "invalid_bounds"),
    ("Australia", 0.0, 260000.0, 130000.0, "invalid_bounds", "invalid_bounds"),
    ("Australia", 8000.0, 8000.0, 8000.0, "unit_review", "unit_review"),
]


def _golden_df(spark):
    rows = []
    for i, (c, lo, hi, avg, _, _) in enumerate(GOLDEN):
        rows.append((i + 1, f"Title {i}", "Co", "City", lo, hi, f"desc {i}", c, "data analyst", None, "PhD", "[]", 0,
                     "Mid", False, avg, hi is not None))
    from wagelens.sources.postings import POSTINGS_SCHEMA
    return spark.createDataFrame(rows, POSTINGS_SCHEMA)


def test_golden_review_rows_under_two_presets(spark):
    df = _golden_df(spark)
    for rules, idx in ((PHASE1, 4), (STRICT, 5)):
        got = {r.job_id: r.salary_quality_status for r in build_silver(df, rules).collect()}
        assert [got[i + 1] for i in range(len(GOLDEN))] == [g[idx] for g in GOLDEN], rules.name


def test_usd_is_local_over_rate(spark):
    s = build_silver(_golden_df(spark), STRICT).orderBy("job_id").collect()
    assert s[0].salary_avg_usd == 700000.0 / 83.67
    assert s[5].salary_avg_usd == 5250.0 / 1.37


@pytest.mark.parametrize("broken, said", [
    (lambda df: df.drop("company"), "missing"),
    (lambda df: df.withColumn("job_id", F.lit(1).cast("long")), "repeated"),
    (lambda df: df.withColumn("job_id", F.when(F.col("job_id") > 1, F.col("job_id"))), "null"),
    (lambda df: df.withColumn("country", F.lit("Brazil")), "unknown country"),
    (lambda df: df.withColumn("country", F.lit(None).cast("string")), "without a currency"),
    (lambda df: df.withColumn("job_level", F.lit("Chief")), "unknown job level")])
def test_a_broken_contract_raises(spark, broken, said):
    with pytest.raises(ValueError, match=said):
        build_silver(broken(_golden_df(spark)), STRICT)


def _status(spark, rules, rows):
    from wagelens.sources.postings import POSTINGS_SCHEMA
    data = [(i, f"T{i}", "Co", "City", lo, hi, f"d{i}", "USA", "k", None, "PhD", "[]", 0, "Mid", False, avg, avg is not None)
            for i, (lo, avg, hi) in enumerate(rows)]
    out = build_silver(spark.createDataFrame(data, POSTINGS_SCHEMA), rules).orderBy("job_id").collect()
    return [r.salary_quality_status for r in out]


def test_null_out_presets_follow_their_own_rules(spark):
    rows = [(50000.0, 60000.0, 70000.0), (50000.0, 90000.0, 70000.0), (0.0, 60000.0, 70000.0), (400.0, 500.0, 600.0),
            (4000.0, 5000.0, 6000.0), (50000.0, 51000.0, 90000.0), (None, 60000.0, None), (None, None, None)]
    # disordered, non-positive, tiny, low, midpoint off, bounds missing, no salary
    assert _status(spark, CAPSTONE, rows) == [
        "model_ready", "unlabeled", "unlabeled", "unit_review", "unit_review", "model_ready", "model_ready", "unlabeled"]
    assert _status(spark, BEGINNER, rows) == [
        "model_ready", "model_ready", "unlabeled", "unlabeled", "model_ready", "model_ready", "model_ready", "unlabeled"]
