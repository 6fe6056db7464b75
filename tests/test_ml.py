import json
import math

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from wagelens.ml import evaluate, models
from wagelens.ml.features import MedianImputeScale, OneHotDropFirst, TitleTfidf


def test_ridge_matches_closed_form(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 3))
    y = x @ np.array([1.5, -2.0, 0.5]) + 3 + rng.normal(scale=0.3, size=60)
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, c double, y double")
    feats = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    sd = float(np.std(y))
    for alpha in (0.01, 10.0, 1000.0):
        m = models.ridge(alpha, sd, len(y), "y").fit(feats)
        xc, yc = x - x.mean(0), y - y.mean()
        w = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
        assert np.allclose(m.coefficients.toArray(), w, rtol=1e-6, atol=1e-8), alpha


def test_one_hot_unknown_rare_and_null(spark):
    train = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), ("b",), ("b",), ("c",), (None,)], "k string")
    m = OneHotDropFirst(inputCols=["k"], minFrequency=3, dropFirst=True).fit(train)
    st = json.loads(m.getOrDefault(m.state))
    assert st["mode"]["k"] == "a" and st["rare"]["k"] == ["c"] and st["kept"]["k"] == ["b", "__infrequent__"]
    test = spark.createDataFrame([("a",), ("b",), ("c",), ("zzz",), (None,)], "k string")
    rows = [tuple(r) for r in m.transform(test).select(*m.output_columns()).collect()]
    assert rows == [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (0.0, 0.0), (0.0, 0.0)]


def test_standardisation_uses_population_sd(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (5.0,)], "x double")
    m = MedianImputeScale(inputCols=["x"]).fit(df)
    out = np.array([r[0] for r in m.transform(df).select("num__x").collect()])
    assert abs(out.mean()) < 1e-12 and abs(out.std() - 1) < 1e-12
    assert m.output_columns() == ["num__x", "miss__x"]


def test_tfidf_hand_example(spark):
    docs = ["data engineer", "data engineer", "data analyst", "data analyst", "data analyst", "lead data engineer"]
    df = spark.createDataFrame([(d,) for d in docs], "t string")
    m = TitleTfidf(inputCol="t", outputCol="v", minDF=2, maxFeatures=10).fit(df)
    st = json.loads(m.getOrDefault(m.state))
    assert st["vocabulary"] == ["analyst", "data", "data analyst", "data engineer", "engineer"]
    n = len(docs)
    idf_data = math.log((n + 1) / (6 + 1)) + 1
    assert math.isclose(st["idf"][1], idf_data)
    v = m.transform(df).select("v").collect()[0][0].toArray()
    assert math.isclose(float(np.linalg.norm(v)), 1.0, rel_tol=1e-12)


def test_group_mean_cv_matches_brute_force(spark):
    rows = [(i, "g" + str(i % 3), float(i * 7 % 11), i % 5) for i in range(50)]
    dev = spark.createDataFrame(rows, "job_id long, g string, y double, fold int")
    summary, oof = evaluate.group_mean_cv(dev, ["g"], "y")
    s = summary.first()
    maes, train = [], []
    for k in range(5):
        tr = [r for r in rows if r[3] != k]
        va = [r for r in rows if r[3] == k]
        mean = {g: np.mean([r[2] for r in tr if r[1] == g]) for g in {r[1] for r in tr}}
        maes.append(np.mean([abs(r[2] - mean[r[1]]) for r in va]))
        train.append(np.mean([abs(r[2] - mean[r[1]]) for r in tr]))
    assert math.isclose(s.CV_MAE, np.mean(maes)) and math.isclose(s.CV_MAE_SD, np.std(maes))
    assert math.isclose(s.Train_MAE, np.mean(train))
    assert oof.count() == 50


def test_segment_single_row_r2_is_null_and_constant_target(spark):
    audit = spark.createDataFrame([("a", 1.0, 1.0), ("b", 2.0, 2.0), ("b", 2.0, 3.0)],
                                  "g string, actual_salary double, predicted_salary double")
    out = {r.g: r for r in evaluate.segment_performance(audit, "g").collect()}
    assert out["a"].R2 is None and out["b"].R2 == 0.0


def test_verdict_levels(spark):
    df = spark.createDataFrame([(7000.0,), (8000.0,), (12000.0,), (18500.0,), (20000.0,)], "MAE double")
    got = [r.decision for r in evaluate.benchmark_verdict(df).collect()]
    assert got == ["meets_industry_target", "beats_legacy", "beats_legacy", "keep_legacy", "keep_legacy"]


def test_overfit_rule(spark):
    res = spark.createDataFrame([(3, 10.0), (4, 9.0), (5, 9.1), (6, 9.5)], "max_depth int, Validation_MAE double")
    r = evaluate.overfit_depth(res).first()
    assert r.best_depth == 4 and r.overfit_depth == 6
    res2 = spark.createDataFrame([(3, 10.0), (4, 9.0)], "max_depth int, Validation_MAE double")
    assert evaluate.overfit_depth(res2).first().overfit_depth is None


def test_group_mean_fit_in_one_rollup_matches_brute_force(spark):
    rows = [("a", "x", 1.0), ("a", "x", 3.0), ("a", None, 5.0), ("b", "y", None), ("b", "y", None),
            ("c", "z", 10.0)]
    df = spark.createDataFrame(rows, "g string, h string, y double")
    m = models.GroupMeanRegressor(groupCols=["g", "h"], labelCol="y").fit(df)
    got = {(r.g, r.h): r.prediction for r in m.transform(df).select("g", "h", "prediction").distinct().collect()}
    overall = (1.0 + 3.0 + 5.0 + 10.0) / 4
    # ("b", "y") has no label, so it falls back to the overall mean.
    assert got == {("a", "x"): 2.0, ("a", None): 5.0, ("b", "y"): overall, ("c", "z"): 10.0}
    empty = models.GroupMeanRegressor(groupCols=["g"], labelCol="y").fit(df.where("y IS NULL"))
    assert json.loads(empty.getOrDefault(empty.state)) == {"means": {}, "global": None}
