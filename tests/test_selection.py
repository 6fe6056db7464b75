"""Selection chain: shared fits, stored folds, ledger, out-of-fold rows, permutation importance."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from wagelens.ml import candidates, models, permutation
from wagelens.ml.candidates import BOOSTING, FOREST, LINEAR, Candidate, cross_validate, fit, grid_search, out_of_fold, scores
from wagelens.ml.chain import Ledger, Selection
from wagelens.ml.features import branches, preprocessor
from wagelens.ml.folds import FoldData, column_slots, slots_of, store_folds


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(11)
    out = []
    for i in range(400):
        c, l = rng.choice(["A", "B", "C"]), rng.choice(["x", "y", None])
        e = None if rng.random() < 0.1 else rng.uniform(0, 20)
        usd = 30_000 + 9_000 * "ABC".index(c) + (4_000 if l == "x" else 0) + 1_500 * (e or 3) + rng.gauss(0, 2_000)
        out.append((i, c, l, e, rng.randrange(4), rng.choice(["data engineer", "lead analyst", "data analyst"]), usd, i % 3))
    df = spark.createDataFrame(out, "job_id long, country string, level string, years double, extra int, title string, "
                                    "salary_avg_usd double, fold int")
    return df.persist()


SPECS = {"small": branches(("country",)), "mid": branches(("level", "country"), ("extra",)),
         "all": branches(("country", "level"), ("years", "extra"), "title")}


def test_slots_of_a_set_equal_its_own_preprocessor(spark, rows, tmp_path):
    store = store_folds(rows, str(tmp_path / "folds"), SPECS, k=3)
    for spec in SPECS.values():
        with store.loaded(spec) as folds:
            for i, fd in enumerate(folds):
                own = preprocessor(spec).fit(rows.where(F.col("fold") != i))
                want = {r[0]: r[1] for r in own.transform(rows).select("job_id", vector_to_array("features")).collect()}
                got = {r[0]: r[1] for r in fd.rows.select("job_id", vector_to_array("features")).collect()}
                assert got == want
                assert fd.n == fd.train.count() and fd.valid.where(F.col("fold") != i).count() == 0
                sd = np.std([r[0] for r in rows.where(F.col("fold") != i).select("salary_avg_usd").collect()])
                assert math.isclose(fd.sd["usd"], sd)


@pytest.fixture(scope="module")
def folds(spark, rows):
    x = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows.select(
        "job_id", "fold", F.col("salary_avg_usd").alias("usd"), F.log1p("salary_avg_usd").alias("log_usd"),
        F.coalesce("years", F.lit(5.0)).alias("a"), F.col("extra").cast("double").alias("b")))
    return [FoldData(x.withColumn("held", F.col("fold") == i).coalesce(1).persist(), 260, {"usd": 9000.0, "log_usd": 0.2}) for i in range(3)]


def test_boosting_prefixes_equal_their_own_fits(folds):
    grid = {"maxIter": [3, 7, 12], "stepSize": [0.1], "maxDepth": [2], "minInstancesPerNode": [1, 5]}
    found = grid_search(folds, BOOSTING, grid)
    assert len(found) == 6
    for c, m in found:
        own = cross_validate(folds, {"own": (c, "Original USD")})["own"]
        for name in ("CV_MAE", "CV_MAE_SD", "Train_MAE"):
            assert math.isclose(m[name], own[name], rel_tol=1e-9), (c, name)


def test_forest_blocks_equal_their_own_fits(folds, monkeypatch):
    monkeypatch.setattr(candidates, "BLOCK", 4)
    grid = {"numTrees": [4, 8], "maxDepth": [2, None], "minInstancesPerNode": [3], "featureSubsetStrategy": ["0.7"]}
    found = grid_search(folds, FOREST, grid)
    assert len(found) == 4
    for c, m in found:
        own = cross_validate(folds, {"own": (c, "Original USD")})["own"]
        assert math.isclose(m["CV_MAE"], own["CV_MAE"], rel_tol=1e-9) and math.isclose(m["Train_MAE"], own["Train_MAE"], rel_tol=1e-9)
        if c.params["numTrees"] == 4:       # one block: the plain MLlib forest
            maes = []
            for fd in folds:
                plain = models.random_forest(4, c.params["maxDepth"], 3, "0.7", label="usd").fit(fd.train)
                maes.append(plain.transform(fd.valid).agg(F.avg(F.abs(F.col("usd") - F.col("prediction")))).first()[0])
            assert math.isclose(m["CV_MAE"], np.mean(maes), rel_tol=1e-12)


def test_forest_sizes_that_are_no_blocks_are_fitted_apart(folds):
    grid = {"numTrees": [2, 3], "maxDepth": [2], "minInstancesPerNode": [3], "featureSubsetStrategy": ["all"]}
    found = grid_search(folds, FOREST, grid)
    assert sorted(c.params["numTrees"] for c, _ in found) == [2, 3]
    for c, m in found:
        own = cross_validate(folds, {"own": (c, "Original USD")})["own"]
        assert math.isclose(m["CV_MAE"], own["CV_MAE"], rel_tol=1e-9)


def test_grids_are_whole():
    assert {a: len(candidates.grid_points(g)) for a, g in candidates.GRIDS.items()} == {LINEAR: 6, FOREST: 24, BOOSTING: 36}


@pytest.mark.parametrize("target", ["Original USD", "Log target"])
def test_out_of_fold_has_each_key_once_and_the_metrics_of_cv(rows, folds, target):
    c = Candidate(LINEAR, {"alpha": 10.0})
    out = out_of_fold(folds, c, target)
    assert sorted(r[0] for r in out.select("job_id").collect()) == list(range(400))
    per = [r[1] for r in out.groupBy("fold").agg(F.avg(F.abs(F.col("usd") - F.col("prediction")))).collect()]
    assert math.isclose(np.mean(per), cross_validate(folds, {"c": (c, target)})["c"]["CV_MAE"], rel_tol=1e-12)


def test_ledger_keeps_order_and_missing_metrics(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    assert not ledger.has("tuning")
    ledger.put("tuning", [("b", Candidate(LINEAR, {"alpha": 1.0}), {"MAE": 2}), ("a", Candidate(FOREST, {"maxDepth": None}), {"MAE": None})])
    assert ledger.has("tuning") and ledger.winner("tuning")["candidate"] == "b"
    rows = ledger.rows("tuning").orderBy("place").collect()
    assert Candidate.of(FOREST, rows[1]["params"]) == Candidate(FOREST, {"maxDepth": None}) and rows[1]["candidate"] == "a"
    assert rows[0]["metrics"] == {"MAE": 2.0} and rows[1]["metrics"] == {"MAE": None}


GRIDS = {LINEAR: {"alpha": [0.1, 100.0]},
         FOREST: {"numTrees": [3], "maxDepth": [3], "minInstancesPerNode": [1], "featureSubsetStrategy": ["all"]},
         BOOSTING: {"maxIter": [4, 8], "stepSize": [0.1], "maxDepth": [2], "minInstancesPerNode": [1]}}
BASELINES = {LINEAR: {}, FOREST: {"numTrees": 4, "maxDepth": 4, "minInstancesPerNode": 2, "featureSubsetStrategy": "all"},
             BOOSTING: {"maxIter": 5, "stepSize": 0.1, "maxDepth": 2, "minInstancesPerNode": 1}}


@pytest.fixture(scope="module")
def chain(spark, rows, tmp_path_factory):
    pool = rows.select("*", F.lit("t").alias("job_title"), F.lit("c").alias("company"), F.coalesce("level", F.lit("z")).alias("job_level"),
                       F.lit("s").alias("salary_segment"), F.lit("k").alias("search_keyword"))
    dev, held = pool.where("job_id >= 80"), pool.where("job_id < 80")
    return Selection(dev.withColumn("fold", (F.col("job_id") % 5).cast("int")), held, rows, pool, str(tmp_path_factory.mktemp("chain")),
                     SPECS, GRIDS, BASELINES, depths=(2, 4), sweep_trees=3)


def test_each_stage_reads_the_winner_before_it(spark, chain):
    chain.run("refit")
    assert not chain.ledger.has("alpha") and not chain.ledger.has("depth")
    first = {s: chain.ledger.winner(s) for s in ("feature_set", "baseline", "tuning", "target")}
    best = {s: chain.ledger.rows(s).orderBy("place").collect() for s in ("feature_set", "baseline", "tuning", "target")}
    assert [r["metrics"]["CV_R2"] for r in best["feature_set"]] == sorted((r["metrics"]["CV_R2"] for r in best["feature_set"]), reverse=True)
    for s in ("baseline", "tuning", "target"):
        maes = [r["metrics"]["CV_MAE"] for r in best[s]]
        assert maes == sorted(maes)
    strongest = first["baseline"]["candidate"]
    assert first["tuning"]["candidate"] == strongest
    assert len(best["tuning"]) == len(candidates.grid_points(GRIDS[strongest]))
    assert first["target"]["params"] == first["tuning"]["params"] and len(best["target"]) == 2
    gain = chain.tuning_gain().first()
    assert math.isclose(gain.Improvement, first["baseline"]["metrics"]["CV_MAE"] - first["tuning"]["metrics"]["CV_MAE"])


def test_holdout_compares_baselines_and_the_tuned_model(chain):
    out = chain.run("holdout").orderBy("place").collect()
    names = {r["candidate"] for r in out}
    assert names == {*BASELINES, f"Tuned final candidate ({chain.target()})"}
    rmse = [r["metrics"]["RMSE"] for r in out]
    assert rmse == sorted(rmse)


def test_contract_has_its_fields_and_the_saved_model_scores_alike(spark, rows, chain):
    c = chain.contract()
    assert set(c) == {"selected_feature_set", "feature_columns", "selected_target", "legacy_mae_usd", "industry_mae_usd",
                      "training_rows", "scoring_rows", "random_state"}
    assert c["training_rows"] == c["scoring_rows"] == 400 and c["selected_target"] == chain.target()
    got = {r[0]: r[1] for r in chain.final_model().transform(rows).select("job_id", "predicted_salary_usd").collect()}
    pre = preprocessor(chain.spec()).fit(rows)
    label = {"Original USD": "usd", "Log target": "log_usd"}[chain.target()]
    data = pre.transform(rows).withColumn("usd", F.col("salary_avg_usd")).withColumn("log_usd", F.log1p("salary_avg_usd"))
    sd = float(np.std([r[0] for r in data.select(label).collect()]))
    again = fit(chain.winning("target"), data, 400, {label: sd}, chain.target()).add(data.drop("prediction"))
    for r in again.select("job_id", "prediction").collect():
        assert math.isclose(got[r[0]], r[1], rel_tol=1e-9)


def test_whole_run_is_exported_and_summed_up(spark, chain, tmp_path):
    audit = chain.audit()
    assert sorted(r[0] for r in audit.select("job_id").collect()) == list(range(80))
    mae = audit.agg(F.avg("absolute_error")).first()[0]
    facts = chain.memo(audit, chain.importance())
    assert math.isclose(facts["MAE"], mae, rel_tol=1e-9) and math.isclose(facts["improvement_usd"], 18_500 - mae, rel_tol=1e-9)
    assert facts["decision"] == ("pilot" if mae < 18_500 else "keep_legacy") and len(facts["top_features"]) == min(3, len(chain.spec()["levels"]) + len(chain.spec()["measures"]) + len(chain.spec()["title"]))
    worst = audit.groupBy("country").agg(F.avg("residual").alias("r")).orderBy(F.desc("r")).first()
    assert facts["worst_country"] == worst["country"] and math.isclose(facts["worst_country_residual"], worst["r"])
    paths = chain.export(str(tmp_path))
    assert len(paths) == 13
    rows = {n: spark.read.option("header", True).csv(p).count() for n, p in paths.items()}
    assert rows["feature_set_ablation"] == 3 and rows["final_holdout_predictions"] == 80 and rows["scoring_predictions"] == 400
    assert rows["permutation_importance"] >= 1 and rows["holdout_metrics_by_country"] == 3


def test_side_stages_and_a_resumed_ledger(chain):
    assert chain.run("alpha").count() == 6
    depths = chain.run("depth").collect()
    assert sorted(r["metrics"]["max_depth"] for r in depths) == [2.0, 4.0]
    again = Selection(chain.development, chain.holdout, chain.training, chain.scoring, chain.folder, SPECS, GRIDS, BASELINES)
    assert again.run("tuning").orderBy("place").collect() == chain.run("tuning").orderBy("place").collect()
    assert again._folds is None         # nothing was encoded again


def plain_importance(order, y, x, slots, predict):
    """Brute force over the donor table: one swapped copy per column and repeat."""
    base = np.mean(np.abs(y - predict(x)))
    out = {}
    for name, places in slots.items():
        inc = []
        for give in order:
            z = x.copy()
            z[:, places] = x[give][:, places]
            inc.append(np.mean(np.abs(y - predict(z))) - base)
        out[name] = (np.mean(inc), np.std(inc))
    return out


def test_importance_equals_swapped_copies(spark, rows):
    spec = SPECS["all"]
    pre = preprocessor(spec).fit(rows)
    data = pre.transform(rows).select("job_id", F.col("salary_avg_usd").alias("usd"), "features").persist()
    fitted = fit(Candidate(LINEAR, {"alpha": 1.0}), data, 400, {"usd": 9000.0})
    slots, width = {}, 0
    for (_, c), places in column_slots(pre).items():
        slots.setdefault(c, []).extend(places)
        width += len(places)
    assert set(slots) == {"country", "level", "years", "extra", "title"} and len(slots["years"]) == 2     # value and indicator
    got = {r["Feature"]: (r["Importance_MAE"], r["Importance_SD"])
           for r in permutation.importance(fitted, data, slots, width, repeats=3).collect()}
    local = sorted(data.select("job_id", "usd", vector_to_array("features").alias("x")).collect())
    x, y = np.array([r["x"] for r in local]), np.array([r["usd"] for r in local])
    order = []
    for r in range(3):
        pairs = {p["job_id"]: p["donor"] for p in permutation.donors(data, "job_id", 3).where(f"repeat = {r}").collect()}
        assert sorted(pairs) == sorted(pairs.values()) == list(range(400))
        order.append([pairs[i] for i in range(400)])
    (m,) = fitted.parts
    want = plain_importance(order, y, x, slots, lambda z: z @ m.coefficients.toArray() + m.intercept)
    for name, (mean, sd) in want.items():
        assert math.isclose(got[name][0], mean, rel_tol=1e-9, abs_tol=1e-6) and math.isclose(got[name][1], sd, rel_tol=1e-6, abs_tol=1e-6)


def test_importance_copies_rows_by_repeat_only(spark, rows):
    pre = preprocessor(SPECS["mid"]).fit(rows)
    data = pre.transform(rows).select("job_id", F.col("salary_avg_usd").alias("usd"), "features")
    fitted = fit(Candidate(LINEAR, {"alpha": 1.0}), data, 400, {"usd": 9000.0})
    slots = {c: p for (_, c), p in column_slots(pre).items()}
    few = permutation.importance(fitted, data, {"level": slots["level"]}, 6)
    many = permutation.importance(fitted, data, slots, 6)
    shape = lambda df: [df._jdf.queryExecution().optimizedPlan().toString().count(w) for w in ("Join ", "Generate explode", "Union")]
    assert shape(few) == shape(many) and shape(many)[2] == 0
    # both readers of the ranks explode keys and repeats, never columns
    assert shape(many)[1] <= 4


def test_receiving_rows_are_not_looked_up_by_key(spark, rows):
    data = rows.select("job_id", "salary_avg_usd", "country", "level")
    both = permutation.side_by_side(data, "job_id", ["country"], 3, 42)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = both._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 << 20))
    assert "hashpartitioning(job_id" not in plan and "hashpartitioning(donor" in plan
    of = {r[0]: r[1] for r in data.select("job_id", "country").collect()}
    pairs = {(p["repeat"], p["job_id"]): p["donor"] for p in permutation.donors(data, "job_id", 3).collect()}
    got = both.select("repeat", "job_id", "donor", "country", "_d_country").collect()
    assert {(r["repeat"], r["job_id"]): r["donor"] for r in got} == pairs and len(got) == len(pairs) == 1200
    assert all(r["country"] == of[r["job_id"]] and r["_d_country"] == of[r["donor"]] for r in got)


def test_ridge_points_from_moments_equal_their_own_fits(rows, folds, monkeypatch):
    alphas = [0.01, 10.0, 1000.0]
    found = {c.params["alpha"]: m for c, m in grid_search(folds, LINEAR, {"alpha": alphas})}
    for a in alphas:
        own = cross_validate(folds, {"own": (Candidate(LINEAR, {"alpha": a}), "Original USD")})["own"]
        for name in ("CV_MAE", "CV_MAE_SD", "Train_MAE"):
            assert math.isclose(found[a][name], own[name], rel_tol=1e-7), (a, name)
    # one grid is two passes a fold, however many points it has: MLlib fits none of them
    monkeypatch.setattr(candidates.models, "ridge", None)
    assert len(grid_search(folds, LINEAR, {"alpha": alphas})) == 3


def test_feature_sets_from_one_matrix_equal_their_own_fits(spark, rows, tmp_path):
    run = Selection(rows, rows, rows, rows, str(tmp_path), SPECS)
    run._folds = store_folds(rows, str(tmp_path / "folds"), SPECS, k=3)
    got = {name: m for name, _, m in run._feature_set()}
    assert set(got) == set(SPECS)
    for name, spec in SPECS.items():
        with run._folds.loaded(spec) as encoded:
            own = cross_validate(encoded, {"own": (Candidate(LINEAR, {"alpha": 10.0}), "Original USD")})["own"]
        for metric, value in own.items():
            assert math.isclose(got[name][metric], value, rel_tol=1e-6), (name, metric)
