"""Regressors (I1-I5) and model selection.

MLlib estimators stand in for the sklearn ones:

* OLS   -> ``LinearRegression(solver='normal', regParam=0)``
* Ridge -> same with ``regParam = alpha * stddev_pop(y) / n`` and no
  feature standardisation (MLlib scales the label internally; this choice
  reproduces sklearn's ``Ridge(alpha)`` objective)
* forest / boosting -> ``TaskForestRegressor`` (``RandomForestRegressor`` grown a tree
  a task) / ``TaskBoostingRegressor`` (``forest.py``; binned splits; depth capped at
  30; boosting starts from a weight-1 first tree)

``GroupMeanRegressor`` is a deterministic baseline (mean label per group,
global mean for unseen groups) whose results plain SQL can reproduce; it
is what the SQL-checked evaluation queries use.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import LinearRegression
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagelens.ml.features import TableState
from wagelens.ml.forest import TaskBoostingRegressor, TaskForestRegressor
from wagelens.rules import RANDOM_STATE
from wagelens.session import scratch_path

MAX_TREE_DEPTH = 30
#: Group means up to this many travel inside the plan as a map literal; more are
#: a stored table that rows are joined to.
INLINE_GROUPS = 1_000


class _GroupMeanParams(Params):
    groupCols = Param(Params._dummy(), "groupCols", "group columns", typeConverter=TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "label", typeConverter=TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction", typeConverter=TypeConverters.toString)


def group_key(cols: list[str]):
    return F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in cols])


class GroupMeanModel(Model, _GroupMeanParams, TableState):
    @keyword_only
    def __init__(self, groupCols=None, labelCol="label", predictionCol="prediction", state=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        st, out = self._state(), self.getOrDefault(self.predictionCol)
        if "table" in st:
            means = df.sparkSession.read.parquet(st["table"])
            keyed = df.withColumn("_group", group_key(self.getOrDefault(self.groupCols)))
            return (keyed.join(means.select(F.col("k").alias("_group"), F.col("m").alias("_mean")), "_group", "left")
                    .withColumn(out, F.coalesce("_mean", F.lit(st["global"]))).drop("_group", "_mean"))
        pairs = []
        for k, v in st["means"].items():
            pairs += [F.lit(k), F.lit(float(v))]
        lookup = F.element_at(F.create_map(*pairs), group_key(self.getOrDefault(self.groupCols))) if pairs \
            else F.lit(None).cast("double")
        return df.withColumn(out, F.coalesce(lookup, F.lit(st["global"])))


class GroupMeanRegressor(Estimator, _GroupMeanParams, DefaultParamsReadable, DefaultParamsWritable):
    """Mean label per group, for any number of groups."""

    @keyword_only
    def __init__(self, groupCols=None, labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(labelCol="label", predictionCol="prediction")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> GroupMeanModel:
        y = self.getOrDefault(self.labelCol)
        cols = self.getOrDefault(self.groupCols)
        # One aggregate gives the group means and the overall mean (the rollup's
        # grand-total row); at most INLINE_GROUPS + 2 rows reach the driver.
        means = (df.where(F.col(y).isNotNull()).select(group_key(cols).alias("k"), F.col(y).alias("_y"))
                 .rollup("k").agg(F.avg("_y").alias("m"), F.grouping("k").alias("total")))
        rows = means.limit(INLINE_GROUPS + 2).collect()
        if len(rows) == INLINE_GROUPS + 2:
            path = scratch_path(df.sparkSession, "group-means")
            means.write.parquet(path + "-all")
            stored = df.sparkSession.read.parquet(path + "-all")
            stored.where("total = 0").select("k", "m").write.parquet(path)
            st = {"table": path, "global": float(stored.where("total = 1").first()["m"])}
        else:
            groups = [r for r in rows if r["total"] == 0]
            glob = next((r["m"] for r in rows if r["total"] == 1), None)
            st = {"means": {r["k"]: r["m"] for r in groups}, "global": float(glob) if glob is not None else None}
        return GroupMeanModel(groupCols=cols, labelCol=y, predictionCol=self.getOrDefault(self.predictionCol),
                              state=json.dumps(st))


def linear_regression(label: str = "label") -> LinearRegression:
    return LinearRegression(featuresCol="features", labelCol=label, solver="normal", regParam=0.0,
                            elasticNetParam=0.0, standardization=False)


def ridge(alpha: float, label_sd: float, n: int, label: str = "label") -> LinearRegression:
    """sklearn ``Ridge(alpha)`` on MLlib's objective."""
    reg = alpha * label_sd / n if n else 0.0
    return LinearRegression(featuresCol="features", labelCol=label, solver="normal", regParam=reg,
                            elasticNetParam=0.0, standardization=False)


def random_forest(num_trees: int = 100, max_depth: int | None = None, min_leaf: int = 1,
                  max_features="all", seed: int = RANDOM_STATE, label: str = "label") -> TaskForestRegressor:
    if max_depth is not None and max_depth > MAX_TREE_DEPTH:
        raise ValueError(f"MLlib trees are at most {MAX_TREE_DEPTH} deep; {max_depth} was asked for")
    strategy = max_features if isinstance(max_features, str) else str(max_features)
    return TaskForestRegressor(featuresCol="features", labelCol=label, numTrees=num_trees,
                               maxDepth=max_depth or MAX_TREE_DEPTH,
                               minInstancesPerNode=min_leaf, featureSubsetStrategy=strategy, seed=seed, maxBins=64)


def gradient_boosting(n_estimators: int = 100, learning_rate: float = 0.1, max_depth: int = 3,
                      min_leaf: int = 1, subsample: float = 1.0, seed: int = RANDOM_STATE,
                      label: str = "label") -> TaskBoostingRegressor:
    """Shallow trees: where MLlib fits them, walking a row down again costs less than
    keeping its node between levels (8.8 s against 12.8 s for 40 trees on 5,900 rows)."""
    return TaskBoostingRegressor(featuresCol="features", labelCol=label, maxIter=n_estimators, stepSize=learning_rate,
                                 maxDepth=max_depth, minInstancesPerNode=min_leaf, subsamplingRate=subsample, seed=seed,
                                 maxBins=64, cacheNodeIds=False, maxMemoryInMB=1024, checkpointInterval=10)
