"""Exact quantiles from value counts, and the profile without Expand."""

import math
import pathlib
import random

import numpy as np
from pyspark.sql import functions as F

from smoke_data import SMOKE
from wagelens.operators import eda, profile, stats
from wagelens.operators.quantiles import quantiles_by, quantiles_of_counts, value_counts, wide
from wagelens.sources.postings import postings, table

PROBS = [0.0, 0.025, 0.25, 0.5, 0.75, 0.9, 1.0]
NAMES = [f"q{i}" for i in range(len(PROBS))]


def sample(n=3000, seed=5):
    rng = random.Random(seed)
    kinds = [lambda: 50_000.0, lambda: rng.gauss(0, 1), lambda: rng.lognormvariate(11, 1), lambda: -rng.random() * 1e-9,
             lambda: 0.0, lambda: rng.uniform(-1e12, 1e12), lambda: None, lambda: float(rng.randrange(5))]
    return [(i, rng.choice(["a", "b", None]), rng.choice(kinds)(), rng.choice(kinds)()) for i in range(n)]


def check(found, rows, groups, column):
    for r in found:
        values = [v for v in (row[column] for row in rows if groups(row) == groups(r, True)) if v is not None]
        assert r["_n"] == len(values)
        want = np.quantile(values, PROBS)
        for name, w in zip(NAMES, want):
            assert math.isclose(r[name], w, rel_tol=1e-12, abs_tol=1e-300), (r, name, w)


def test_quantiles_equal_numpy_for_any_values_and_null_groups(spark):
    rows = sample()
    df = spark.createDataFrame(rows, "id long, g string, x double, y double")
    found = quantiles_by(df, ["g"], ["x", "y"], PROBS, NAMES).collect()
    assert len(found) == 6
    for c, at in (("x", 2), ("y", 3)):
        check([r for r in found if r["_column"] == c], rows, lambda r, out=False: r["g"] if out else r[1], at)
    (all_x,) = quantiles_of_counts(value_counts(df, [], "x"), [], "x", PROBS, NAMES).collect()
    check([all_x], rows, lambda r, out=False: None, 2)


def test_quantiles_of_one_value_and_of_nothing(spark):
    df = spark.createDataFrame([("a", 7.0), ("b", None)], "g string, x double")
    found = quantiles_by(df, ["g"], ["x"], [0.25, 0.5], ["lo", "mid"]).collect()
    assert [(r["g"], r["lo"], r["mid"], r["_n"]) for r in found] == [("a", 7.0, 7.0, 1)]
    assert quantiles_by(df.limit(0), ["g"], ["x"], [0.5], ["m"]).count() == 0
    none = wide(quantiles_by(df.limit(0), [], ["x"], [0.5], ["m"]), [], ["x"], ["m"]).collect()
    assert none[0]["x__m"] is None


def test_integers_are_exact_beyond_the_buckets(spark):
    df = spark.range(5000).select((F.col("id") + 10**12).alias("x"))      # all in few fine buckets
    (r,) = quantiles_of_counts(value_counts(df, [], "x"), [], "x", [0.5, 0.1], ["m", "t"]).collect()
    assert r["m"] == 10**12 + 2499.5 and math.isclose(r["t"], 10**12 + 499.9, rel_tol=1e-15)


def test_one_count_table_and_no_job_while_a_plan_is_built(spark):
    li = table(spark, SMOKE, "lineitem")
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    spark.sparkContext.setJobGroup("quantiles", "plans only")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("quantiles"))
    df = quantiles_by(li, ["l_returnflag"], ["l_quantity", "l_extendedprice"], [0.25, 0.5], ["a", "b"])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("quantiles")) == before and jobs() is not None
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "percentile" not in plan and "ExistingRDD" not in plan
    # the rows are counted by one and the same aggregate in each of the three steps
    assert plan.count("Generate inline") == 3
    executed = df._jdf.queryExecution().executedPlan()
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString() and executed is not None


def test_no_percentile_buffers_in_the_package():
    root = pathlib.Path(eda.__file__).parents[1]
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert "F.percentile(" not in path.read_text(), path


def test_describe_equals_numpy(spark):
    df = spark.createDataFrame(sample(), "id long, g string, x double, y double")
    x = [r[2] for r in sample() if r[2] is not None]
    r = profile.describe(df, "x").first()
    assert r["count"] == len(x) and math.isclose(r["mean"], np.mean(x), rel_tol=1e-9, abs_tol=1e-6)
    assert math.isclose(r["std"], np.std(x, ddof=1), rel_tol=1e-9)
    for name, p in (("min", 0), ("q25", 0.25), ("q50", 0.5), ("q75", 0.75), ("max", 1)):
        assert math.isclose(r[name], np.quantile(x, p), rel_tol=1e-9, abs_tol=1e-6)


def test_group_medians_keep_groups_without_values(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", None, 3.0), (None, 4.0, None), ("b", 2.0, 2.0)], "g string, x double, y double")
    got = {r["g"]: (r["n"], r["mx"], r["my"]) for r in
           eda.medians_with(df, ["g"], {"x": "mx", "y": "my"}, [F.count(F.lit(1)).alias("n")]).collect()}
    assert got == {"a": (2, None, 2.0), None: (1, 4.0, None), "b": (1, 2.0, 2.0)}


def test_profile_does_not_expand_rows(spark):
    df = postings(spark, SMOKE)
    plan = profile.column_profile(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "Generate" not in plan
    rows = {r["column"]: r for r in profile.column_profile(df).collect()}
    for c in ("job_title", "salary_min", "is_remote", "job_id"):
        values = [r[0] for r in df.select(c).collect()]
        assert rows[c]["distinct_count"] == len(set(values))
        assert rows[c]["missing_count"] == sum(v is None for v in values)
        assert rows[c]["missing_pct"] == round(100.0 * rows[c]["missing_count"] / len(values), 2)


def test_bootstrap_interval_uses_the_same_quantiles(spark):
    df = spark.range(60).selectExpr("id", "cast(id % 2 as string) AS g", "cast(id as double) AS v")
    out = stats.bootstrap_mean_ci(df, ["g"], "v", "id", replicates=50).collect()
    assert len(out) == 2 and all(r["ci_low"] <= r["mean"] <= r["ci_high"] for r in out)


def test_binned_density_is_within_its_stated_error(spark):
    rng = random.Random(9)
    rows = [("a", rng.lognormvariate(11, 0.5)) for _ in range(2000)] + [(None, rng.gauss(0, 1)) for _ in range(500)] + [("c", 5.0)] * 3
    out = eda.kde_binned(spark.createDataFrame(rows, "g string, v double"), "v", ["g"], 40, 256).collect()
    assert len(out) == 120 and all(r["density"] is None for r in out if r["g"] == "c")
    for g in ("a", None):
        v = np.array([x for k, x in rows if k == g])
        h, cell = v.std(ddof=1) * len(v) ** -0.2, (v.max() - v.min()) / 256
        for r in (r for r in out if r["g"] == g):
            direct = np.exp(-0.5 * ((r["x"] - v) / h) ** 2).sum() / (len(v) * h * math.sqrt(2 * math.pi))
            assert abs(r["density"] - direct) <= 0.3989 * cell**2 / (8 * h**3) + 1e-9


def test_poisson_draws_follow_the_distribution(spark):
    from wagelens.operators.stats import POISSON_PART, poisson_cdf, poisson_draw
    n = 20000
    for rate in (1, 3, POISSON_PART):
        df = spark.range(n).select(poisson_draw((F.col("id") + 0.5) / n, F.lit(rate)).alias("d"))
        counts = {r["d"]: r["count"] for r in df.groupBy("d").count().collect()}
        for k in range(12):
            want = math.exp(-rate) * rate**k / math.factorial(k)
            assert abs(counts.get(k, 0) / n - want) < 2 / n
        assert poisson_cdf(rate)[-1] >= 1 - 2.0**-52


def test_bootstrap_draws_by_value_and_weight(spark):
    """Heavy values are drawn in parts; every replicate mean is that of plain Python."""
    import hashlib
    from wagelens.operators.stats import POISSON_PART, poisson_cdf
    rows = [(i, "g", float(i % 3)) for i in range(60)]          # three values of weight 20
    (out,) = stats.bootstrap_mean_ci(spark.createDataFrame(rows, "id long, g string, v double"), ["g"], "v", "id", replicates=40).collect()
    means = []
    for rep in range(1, 41):
        total = n = 0
        for v in range(3):
            for part, rate in enumerate((POISSON_PART, POISSON_PART, 20 - 2 * POISSON_PART)):
                u = int(hashlib.md5(f"{v}#{rep}#{part}#42".encode()).hexdigest()[:13], 16) / 2**52
                d = sum(u >= c for c in poisson_cdf(rate))
                total, n = total + d * v, n + d
        means.append(total / n)
    assert math.isclose(out["ci_low"], np.quantile(means, 0.025), rel_tol=1e-9)
    assert math.isclose(out["ci_high"], np.quantile(means, 0.975), rel_tol=1e-9) and out["mean"] == 1.0 and out["n"] == 60
