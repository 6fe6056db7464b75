"""Fitted levels and group means as stored tables."""

import shutil

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from wagelens.ml import models
from wagelens.ml.features import LevelTableEncoder, OneHotDropFirst, branches, preprocessor
from wagelens.ml.folds import column_slots, slots_of

TRAIN = [("a", "x"), ("a", "y"), ("a", None), ("b", "x"), ("b", "x"), ("b", None), ("c", "z"), (None, "x")]
TEST = [("a", "x"), ("b", "y"), ("c", "z"), ("zzz", "x"), (None, None)]


def dense(df, columns):
    return [tuple(r) for r in df.orderBy("i").select(*columns).collect()]


def test_level_tables_give_the_slots_of_the_dense_encoder(spark):
    train = spark.createDataFrame([(i, *r) for i, r in enumerate(TRAIN)], "i int, k string, l string")
    test = spark.createDataFrame([(i, *r) for i, r in enumerate(TEST)], "i int, k string, l string")
    for minf, drop in ((3, True), (2, False), (1, True)):
        one = OneHotDropFirst(inputCols=["k", "l"], minFrequency=minf, dropFirst=drop).fit(train)
        many = LevelTableEncoder(inputCols=["k", "l"], minFrequency=minf, dropFirst=drop).fit(train)
        want = dense(one.transform(test), one.output_columns())
        parts = dense(many.transform(test), [vector_to_array(c) for c in many.output_columns()])
        assert [tuple(x for part in row for x in part) for row in parts] == want
        assert sum(many.widths().values()) == len(one.output_columns())


def test_preprocessor_with_level_tables_gives_the_same_vectors(spark, tmp_path):
    spec = branches(("k", "l"), ("n",))
    train = spark.createDataFrame([(i, *r, float(i)) for i, r in enumerate(TRAIN * 3)], "i int, k string, l string, n double")
    plain, tables = preprocessor(spec).fit(train), preprocessor(spec, level_tables=True).fit(train)
    vector = [vector_to_array("features")]
    want = dense(plain.transform(train), vector)
    assert dense(tables.transform(train), vector) == want
    assert slots_of(column_slots(tables), spec) == slots_of(column_slots(plain), spec)
    path = str(tmp_path / "model")
    tables.write().overwrite().save(path)
    shutil.rmtree(tables.stages[0].table_path().removeprefix("file:"))        # the saved copy has its own table
    assert dense(PipelineModel.load(path).transform(train), vector) == want


def test_200000_levels_fit_and_score(spark):
    n = 200_000
    rows = spark.range(3 * n).select(F.format_string("v%06d", F.col("id") % n).alias("k"), (F.col("id") % n).cast("double").alias("y"))
    m = LevelTableEncoder(inputCols=["k"]).fit(rows)
    assert m.widths() == {"k": n - 1}
    some = spark.createDataFrame([("v000000",), ("v000001",), ("v199999",), ("new",)], "k string")
    out = {r["k"]: r["oh__k"] for r in m.transform(some).collect()}
    assert {k: list(v.indices) for k, v in out.items()} == {"v000000": [], "v000001": [0], "v199999": [n - 2], "new": []}
    g = models.GroupMeanRegressor(groupCols=["k"], labelCol="y").fit(rows)
    assert g.table_path()
    got = {r["k"]: r["prediction"] for r in g.transform(some).collect()}
    assert got == {"v000000": 0.0, "v000001": 1.0, "v199999": n - 1.0, "new": (n - 1) / 2}


def test_group_means_save_and_load(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(models, "INLINE_GROUPS", 2)
    df = spark.createDataFrame([(k, float(i)) for i, k in enumerate("abcdabcd")] + [(None, 100.0)], "k string, y double")
    m = models.GroupMeanRegressor(groupCols=["k"], labelCol="y").fit(df)
    want = sorted((str(r["k"]), r["prediction"]) for r in m.transform(df).collect())
    assert ("a", 2.0) in want and ("None", 100.0) in want
    path = str(tmp_path / "means")
    m.save(path)
    again = models.GroupMeanModel.load(path)
    assert sorted((str(r["k"]), r["prediction"]) for r in again.transform(df).collect()) == want
    small = models.GroupMeanRegressor(groupCols=["k"], labelCol="y").fit(df.where("k = 'a'"))
    assert small.table_path() is None
    small.save(str(tmp_path / "small"))
    assert models.GroupMeanModel.load(str(tmp_path / "small")).transform(df.limit(1)).first()["prediction"] == 2.0
