import math

from pyspark.sql import functions as F

from wagelens.operators import eda, stats
from wagelens.operators.splits import rank_within, stratified_split
from pyspark.sql import Window


def test_skew_needs_three_rows_and_is_bias_corrected(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 2.0), ("c", 1.0), ("c", 2.0), ("c", 4.0)],
                               "g string, x double")
    got = {r.g: r.skew for r in eda.group_summary(df, ["g"], "x").collect()}
    assert got["a"] is None and got["b"] is None
    # pandas Series([1, 2, 4]).skew() = 0.935219...
    assert math.isclose(got["c"], 0.935220, abs_tol=1e-5)


def test_vif_exact_dependence_is_infinite_and_pair_matches_closed_form(spark):
    rows = [(float(i), float(i % 3), float(i + i % 3)) for i in range(30)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    v = {r.feature: r.VIF for r in stats.vif(df, ["a", "b", "c"]).collect()}
    assert all(math.isinf(x) for x in v.values())
    pair = {r.feature: r.VIF for r in stats.vif(df, ["a", "b"]).collect()}
    r = df.agg(F.corr("a", "b")).first()[0]
    assert math.isclose(pair["a"], 1 / (1 - r * r), rel_tol=1e-9)


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "y double, k double")
    assert stats.target_correlations(df, "y", ["k"]).first().pearson_r is None


def test_rank_within_matches_window_row_number(spark):
    df = spark.range(0, 2000).select((F.col("id") % 3).alias("s"), F.col("id"),
                                     F.md5(F.col("id").cast("string")).alias("h"))
    got = rank_within(df, ["s"], [F.col("h"), F.col("id")], "r", num_partitions=7)
    ref = df.withColumn("r2", F.row_number().over(Window.partitionBy("s").orderBy("h", "id")))
    assert got.join(ref, ["s", "id"]).where("r <> r2").count() == 0
    assert got.count() == 2000


def test_stratified_split_sizes_are_exact(spark):
    df = spark.range(0, 1003).select((F.col("id") % 4).alias("s"), F.col("id"))
    sp = stratified_split(df, ["s"], "id", test_size=0.2)
    got = {r.s: r["count"] for r in sp.where("split = 'test'").groupBy("s").count().collect()}
    n = {r.s: r["count"] for r in df.groupBy("s").count().collect()}
    assert all(got[s] == math.floor(n[s] * 0.2 + 0.5) for s in n)


def test_iqr_fences_single_row_and_constant_group(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 2.0), ("b", 2.0), ("b", 2.0)], "g string, x double")
    out = eda.iqr_fences(df, ["g"], "x").collect()
    assert not any(r.is_outlier for r in out)


def test_hash_rank_within_equals_row_number_also_for_null_strata(spark):
    from pyspark.sql import Window
    from wagelens.operators.splits import hash_order, hash_rank_within
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 5 = 0 THEN NULL WHEN id % 3 = 0 THEN 'a' ELSE 'b' END AS s", "id % 2 AS t")
    got = hash_rank_within(df, ["s", "t"], hash_order("id"), [F.col("id")], "r", "n")
    w = Window.partitionBy("s", "t")
    want = df.withColumn("r", F.row_number().over(w.orderBy(hash_order("id"), "id"))).withColumn("n", F.count("*").over(w))
    assert got.count() == 3000 and got.columns == ["id", "s", "t", "r", "n"]
    assert got.select("id", "r", "n").exceptAll(want.select("id", F.col("r").cast("long"), "n")).count() == 0


def test_full_poisson_parts_are_drawn_without_a_list(spark):
    from wagelens.operators import stats
    steps = stats.poisson_cdf(stats.POISSON_PART)
    us = [0.0, 1 - 2.0**-52, *steps[:20], *[c - 1e-9 for c in steps[1:20]]]
    df = spark.createDataFrame([(u, r) for u in us for r in (1, 5, stats.POISSON_PART)], "u double, r int")
    for row in df.withColumn("d", stats.poisson_draw(F.col("u"), F.col("r"))).collect():
        assert row["d"] == sum(row["u"] >= c for c in stats.poisson_cdf(row["r"])), row
    full = df.select(stats.poisson_draw(F.col("u"), F.lit(stats.POISSON_PART)).alias("d"))
    assert "lambda" not in full._jdf.queryExecution().optimizedPlan().toString()
