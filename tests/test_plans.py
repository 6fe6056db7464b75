"""Physical-plan shape checks for the scale-sensitive operators."""

from pyspark.sql import functions as F

from smoke_data import SMOKE
from wagelens.operators import eda
from wagelens.operators.dedup import duplicate_audit
from wagelens.plans.silver import build_silver
from wagelens.rules import STRICT
from wagelens.sources.postings import postings, table


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_is_partial_hash_aggregate_without_window(spark):
    plan = _plan(duplicate_audit(postings(spark, SMOKE), STRICT, reuse_input=False))
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert "Window" not in plan


def test_histogram_prunes_columns_at_the_scan(spark):
    df = eda.histogram(table(spark, SMOKE, "lineitem"), "l_extendedprice", 10)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_extendedprice:double>" in plan


def test_filter_reaches_parquet_scan(spark):
    li = table(spark, SMOKE, "lineitem").where(F.col("l_quantity") > 45).select("l_orderkey")
    plan = _plan(li)
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,45.0)]" in plan


def test_silver_has_one_shuffle_for_dedup(spark):
    spark.catalog.clearCache()      # an identical cached Silver would hide the plan
    s = build_silver(postings(spark, SMOKE), STRICT)
    plan = s._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [posting_fingerprint") == 1


def test_global_aggregate_is_attached_without_a_join(spark):
    from wagelens.functions.columns import attach_scalars
    li = table(spark, SMOKE, "lineitem").select("l_quantity")
    bounds = li.agg(F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"))
    out = attach_scalars(li, bounds)
    plan = _plan(out)
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan and "Join" not in plan
    row = out.agg(F.min("lo"), F.max("hi"), F.count("*")).first()
    ref = li.agg(F.min("l_quantity"), F.max("l_quantity"), F.count("*")).first()
    assert tuple(row) == tuple(ref)


def test_kde_has_no_cartesian_product(spark):
    plan = _plan(eda.kde_grid(table(spark, SMOKE, "lineitem"), "l_extendedprice", 20))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_spread_only_splits_under_split_scans(spark):
    from wagelens.session import spread
    orders = table(spark, SMOKE, "orders").select("o_orderkey")
    target = spark.sparkContext.defaultParallelism
    spread_out = spread(orders, "o_orderkey")
    assert spread_out.rdd.getNumPartitions() >= min(target, orders.rdd.getNumPartitions() or target)
    assert "Exchange hashpartitioning(o_orderkey" in _plan(spread_out) or orders.rdd.getNumPartitions() >= target
    wide = orders.repartition(target + 2, "o_orderkey")
    assert spread(wide, "o_orderkey") is wide
    assert spread_out.count() == orders.count()


def test_hash_ranks_exchange_the_rows_once_and_store_nothing(spark):
    """Rows go through one exchange, by (stratum, prefix); the other exchanges
    carry counts."""
    from wagelens.operators.splits import stratified_split_folds
    rows = spark.range(1000).selectExpr("id", "cast(id % 3 as string) AS s", "id * 2 AS payload")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(stratified_split_folds(rows, ["s"], "id"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 << 20))
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("_stratum" in e and "_prefix" in e for e in exchanges) == 3        # rows, partial counts, offsets
    assert len(exchanges) == 4                                                   # and the counts by stratum
    assert "Scan ExistingRDD" not in plan and "rangepartitioning" not in plan


def test_layers_are_one_write_and_pruned_reads(spark, tmp_path):
    from wagelens.plans.silver import layer_counts, scoring_layer
    from wagelens.sources import sinks
    s = build_silver(postings(spark, SMOKE), STRICT)
    path = sinks.export_layers(s, str(tmp_path / "silver"))
    train = sinks.read_layer(spark, path, "training", ["job_id", "salary_avg_usd"])
    plan = _plan(train)
    assert "PartitionFilters: [isnotnull(salary_quality_status" in plan and "model_ready" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "ReadSchema: struct<job_id:bigint,salary_avg_usd:double>" in plan
    want = layer_counts(s).first()
    got = {r["layer"]: r["rows"] for r in sinks.manifest(spark, path).collect()}
    assert got == {k: want[k] for k in ("silver", "training", "scoring", "review")}
    for layer in got:
        assert sinks.read_layer(spark, path, layer).count() == got[layer]
    out = sinks.export_layer_csv(spark, path, "scoring", str(tmp_path / "csv"))
    assert spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(out).count() == scoring_layer(s).count()


def _tiny_orders(spark, folder):
    spark.range(1, 4001).selectExpr("id AS o_orderkey").write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_silver_stores_no_feature_columns(spark, tmp_path):
    from wagelens.plans import catalog
    catalog.clear_cache()
    try:
        d = _tiny_orders(spark, tmp_path)
        s = catalog.silver(spark, d)
        assert s.columns == build_silver(postings(spark, d), STRICT).columns
        plan = _plan(s.where("salary_quality_status = 'model_ready'").select("job_id"))
        relation = plan[plan.index("InMemoryRelation ["):]
        assert "skill_python" not in relation[:relation.index("]")] and "regexp_extract_all" not in plan
    finally:
        catalog.clear_cache()


def test_split_ranks_the_training_rows_once(spark, tmp_path):
    """Development and test are filters over one cached, pruned table."""
    from wagelens.plans import catalog
    catalog.clear_cache()
    try:
        d = _tiny_orders(spark, tmp_path)
        dev, test = catalog._gm_split(spark, d)
        assert len(catalog._CACHE) == 3 and "description" not in dev.columns and "fold" not in test.columns
        for part in (dev, test):
            assert _plan(part).count("InMemoryTableScan") >= 1
        every = catalog.training(spark, d)
        assert dev.count() + test.count() == every.count() > 0
        assert dev.where("fold IS NULL").count() == 0 and dev.join(test, "job_id").count() == 0
        wide, _ = catalog.dev_test(spark, d)
        assert dev.select("job_id", "fold").exceptAll(wide.select("job_id", "fold")).count() == 0
    finally:
        catalog.clear_cache()
