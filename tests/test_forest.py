"""Trees grown in tasks: against MLlib's, against brute force, and their files."""

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from wagelens.ml import candidates, forest, models
from wagelens.ml.candidates import BOOSTING, FOREST, Candidate, depth_maes, fit, scored
from wagelens.ml.folds import FoldData

PARAMS = {"numTrees": 30, "maxDepth": None, "minInstancesPerNode": 2, "featureSubsetStrategy": "0.7"}


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=600), rng.integers(0, 2, 600), rng.integers(0, 5, 600), rng.normal(size=600), np.zeros(600)])
    return x, 1000 + 300 * x[:, 0] + 500 * x[:, 1] * (x[:, 2] > 2) + rng.normal(scale=30, size=600)


@pytest.fixture(scope="module")
def rows(spark, points):
    x, y = points
    df = spark.createDataFrame([(i, *map(float, r), float(v), i % 4 == 0) for i, (r, v) in enumerate(zip(x, y))],
                               "job_id long, a double, b double, c double, d double, e double, usd double, held boolean")
    return VectorAssembler(inputCols=list("abcde"), outputCol="features").transform(df).repartition(3, "job_id").persist()


def mae(df):
    return df.agg(F.avg(F.abs(F.col("usd") - F.col("prediction")))).first()[0]


def test_forest_runs_no_shuffle_per_level_and_keeps_mllibs_quality(spark, rows):
    train, held = rows.where("not held"), rows.where("held")
    group = "forest-jobs"
    spark.sparkContext.setJobGroup(group, group)
    fitted = fit(Candidate(FOREST, PARAMS), train, 450, {"usd": 1.0, "log_usd": 1.0})
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 8                      # MLlib: more than one a level
    plain = RandomForestRegressor(labelCol="usd", numTrees=30, maxDepth=30, minInstancesPerNode=2, featureSubsetStrategy="0.7", maxBins=64, seed=1)
    assert mae(fitted.add(held)) < 1.1 * mae(plain.fit(train).transform(held))
    fitted.close()


def test_loaded_model_equals_the_files_and_the_top_of_a_tree_is_the_tree_of_less_depth(spark, rows, tmp_path):
    train = rows.where("not held")
    deep, flat = (models.random_forest(3, d, 2, "sqrt", label="usd").grow(train) for d in (6, 3))
    model = deep.model()
    want = {r[0]: r[1] for r in model.transform(rows).select("job_id", "prediction").collect()}
    got = {r[0]: r[1] for r in deep.add(rows, "features", "p").select("job_id", "p").collect()}
    assert got == want and model.getNumTrees == 3 and model.totalNumNodes == sum(n for _, _, n in deep.manifest)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = type(model).load(str(tmp_path / "m"))
    assert again.featureImportances == model.featureImportances and again.getOrDefault("labelCol") == "usd"
    store, root = forest.opened(f"{deep.path}/nodes")
    other = forest.opened(f"{flat.path}/nodes")[1]
    for (_, a, n), (_, b, m) in zip(deep.manifest, flat.manifest):
        a, b = forest.nodes_of(store, f"{root}/{a}", n), forest.nodes_of(store, f"{other}/{b}", m)
        assert np.array_equal(b["feature"][b["feature"] >= 0], a["feature"][:m][b["feature"] >= 0])
        assert np.array_equal(a["value"][:m], b["value"]) and n > m
    for f in (deep, flat):
        f.close()


@pytest.mark.parametrize("small", [False, True])
def test_one_plain_tree_equals_brute_force(points, monkeypatch, small):
    """Every split is the best one over all columns and thresholds, also where
    blocks, parts of a level and copied parts are tiny."""
    x, y = points
    if small:
        monkeypatch.setattr(forest, "BLOCK_ROWS", 128)
        monkeypatch.setattr(forest, "CELLS", 500)
        monkeypatch.setattr(forest, "COMPACT_ROWS", 64)
    cuts = [forest.thresholds(x[:, f], 63) for f in range(x.shape[1])]
    packs = forest.packs_of(cuts, x)
    codes = np.stack([p.codes(x, cuts) for p in packs])
    step = 100 if small else len(y)
    blocks = [(np.ascontiguousarray(codes[:, a:a + step]), y[a:a + step]) for a in range(0, len(y), step)]
    grown = forest.Tree(cuts, packs, 5, 30, 3, y.mean(), 1e-12 * y.var()).grow(blocks, 1, 0, False, 1.0)
    assert len(cuts[4]) == 0 and len(cuts[0]) == 63

    def check(node, rows):
        best = 0.0
        for f, c in enumerate(cuts):
            for t in c:
                l = x[rows, f] <= t
                if 3 <= l.sum() <= len(rows) - 3:
                    best = max(best, y[rows].var() - (l.mean() * y[rows][l].var() + (~l).mean() * y[rows][~l].var()))
        assert grown["count"][node] == len(rows) and math.isclose(grown["value"][node], y[rows].mean(), rel_tol=1e-9)
        if grown["feature"][node] < 0:
            assert best <= 1e-6
            return 1
        assert math.isclose(grown["gain"][node], best, rel_tol=1e-6)
        l, child = x[rows, int(grown["feature"][node])] <= grown["cut"][node], int(grown["left"][node])
        return 1 + check(child, rows[l]) + check(child + 1, rows[~l])

    assert check(0, np.arange(len(y))) == len(grown["count"]) > 100


def test_boosting_in_a_task_equals_mllib_and_larger_fits_stay_mllibs(rows, monkeypatch):
    train = rows.where("not held")
    c = Candidate(BOOSTING, {"maxIter": 12, "stepSize": 0.1, "maxDepth": 3, "minInstancesPerNode": 3})
    fitted = fit(c, train, 450, {"usd": 1.0, "log_usd": 1.0})
    plain = GBTRegressor(labelCol="usd", maxIter=12, stepSize=0.1, maxDepth=3, minInstancesPerNode=3, maxBins=64, seed=1).fit(train)
    want = {r[0]: r[1] for r in plain.transform(rows).select("job_id", "prediction").collect()}
    for df in (fitted.add(rows), fitted.parts[0].model().transform(rows)):
        got = {r[0]: r[1] for r in df.select("job_id", "prediction").collect()}
        assert all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)
    curve = plain.evaluateEachIteration(train, "absolute")
    held = fitted.parts[0].add_prefixes(train, "features", {"p5": 5, "p12": 12})
    for n in (5, 12):
        assert math.isclose(held.agg(F.avg(F.abs(F.col("usd") - F.col(f"p{n}")))).first()[0], curve[n - 1], rel_tol=1e-9)
    fitted.close()
    monkeypatch.setattr(candidates, "BOOSTED_ROWS", 100)
    assert type(fit(c, train, 450, {"usd": 1.0, "log_usd": 1.0}).parts[0]).__name__ == "GBTRegressionModel"


def test_depths_of_one_fit_equal_their_own_fits(rows):
    fd = FoldData(rows.select("job_id", "usd", "held", "features"), 450, {"usd": 1.0, "log_usd": 1.0})
    grid = {"numTrees": 4, "minInstancesPerNode": 2, "featureSubsetStrategy": "0.7"}
    found = depth_maes(Candidate(FOREST, grid), fd, [12, 2, 5])
    assert sorted(found) == [2, 5, 12]
    for d, maes in found.items():
        own = scored(Candidate(FOREST, grid | {"maxDepth": d}), fd)
        assert all(math.isclose(maes[held], own[held][0], rel_tol=1e-12) for held in (True, False))
    assert math.isclose(scored(Candidate(FOREST, grid | {"maxDepth": 5}), fd, rows=fd.valid)[True][0], found[5][True], rel_tol=1e-12)


def test_thresholds_and_packs():
    assert list(forest.thresholds(np.array([3.0, 1.0, 1.0, 2.0]), 5)) == [1.5, 2.5] and len(forest.thresholds(np.zeros(9), 5)) == 0
    many = forest.thresholds(np.arange(1000.0), 9)
    assert len(many) == 9 and np.allclose(many, np.arange(100, 1000, 100) - 0.5, atol=1.1)
    cuts = [np.array([0.5])] * 7 + [np.arange(63.0), np.zeros(0)]
    x = np.random.default_rng(0).integers(0, 2, (50, 9)).astype(float)
    packs = forest.packs_of(cuts, x)
    assert sorted(f for p in packs for f in p.members) == list(range(8)) and all(p.width <= 64 for p in packs)
    assert forest.packs_of([np.zeros(0)], x)[0].width == 1
    assert [forest.subset_size(s, 10, 5) for s in ("all", "sqrt", "onethird", "0.7", "1.0", "3", "auto")] == [10, 4, 4, 7, 10, 3, 4]


def test_forest_refuses_missing_labels_and_takes_constant_columns(spark):
    df = VectorAssembler(inputCols=["a"], outputCol="features").transform(spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "a double, usd double"))
    assert models.random_forest(3, None, 1, "all", label="usd").fit(df).totalNumNodes == 3
    with pytest.raises(ValueError):
        models.random_forest(3, None, 1, "all", label="usd").fit(df.withColumn("usd", F.when(F.col("usd") > 2, F.col("usd"))))
