"""Regressors as plain descriptions, their fits, and searches that share fits.

A ``Candidate`` is an algorithm name and parameters, so a stage of the
selection can store its winner and the next stage can fit it.

Grid points that differ only in the number of trees share one fit:

* boosting adds trees one after the other, and a tree depends on the ones
  before it only, so the first ``m`` trees of a long fit *are* the fit of
  ``m`` trees.  All prefixes are scored in one pass.
* a forest of a multiple of ``BLOCK`` trees is fitted as blocks of ``BLOCK``
  trees with consecutive seeds, and the forest of 250 is the first block of the
  forest of 500, which is the fit of its own.

Ridge points differ in the penalty only, so all of them are solved from one
pass of moments a fold (``ridge``).
"""

from __future__ import annotations

import itertools
import json
from dataclasses import dataclass, field

from pyspark.ml import Model
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagelens.ml import models
from wagelens.ml.evaluate import metric_aggs
from wagelens.ml.folds import TARGETS, FoldData, side_by_side
from wagelens.ml.forest import BOOSTED_ROWS, GrownForest
from wagelens.ml.ridge import ridge_scores
from wagelens.rules import BOOSTING_GRID, FOREST_GRID, RANDOM_STATE, RIDGE_ALPHAS

LINEAR, FOREST, BOOSTING = "Linear Regression", "Random Forest", "Gradient Boosting"
#: Trees of one forest fit where sizes share their fits.
BLOCK = 250

# The compared algorithms before tuning.
BASELINES = {
    LINEAR: {},
    FOREST: {"numTrees": 350, "maxDepth": None, "minInstancesPerNode": 2, "featureSubsetStrategy": "0.7"},
    BOOSTING: {"maxIter": 200, "stepSize": 0.05, "maxDepth": 3, "minInstancesPerNode": 3},
}
GRIDS = {LINEAR: {"alpha": RIDGE_ALPHAS}, FOREST: FOREST_GRID, BOOSTING: BOOSTING_GRID}
#: Parameter whose smaller values are prefixes of a longer fit.
LENGTH = {FOREST: "numTrees", BOOSTING: "maxIter"}


@dataclass(frozen=True)
class Candidate:
    algorithm: str
    params: dict = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(self.params, sort_keys=True)

    @staticmethod
    def of(algorithm: str, params: str) -> "Candidate":
        return Candidate(algorithm, json.loads(params))

    def estimators(self, label: str, n: int, sd: float) -> list:
        """MLlib estimators whose predictions, weighted by trees, are this model's."""
        p = self.params
        if self.algorithm == LINEAR:
            return [models.ridge(p["alpha"], sd, n, label) if "alpha" in p else models.linear_regression(label)]
        if self.algorithm == BOOSTING:
            return [models.gradient_boosting(p["maxIter"], p["stepSize"], p["maxDepth"], p["minInstancesPerNode"], label=label)]
        trees = p["numTrees"]
        blocks = [BLOCK] * (trees // BLOCK) if trees % BLOCK == 0 else [trees]
        return [models.random_forest(b, p["maxDepth"], p["minInstancesPerNode"], p["featureSubsetStrategy"],
                                     seed=RANDOM_STATE + i, label=label) for i, b in enumerate(blocks)]


class Fitted:
    """One or more fitted models of equal weight, read as one."""

    def __init__(self, parts: list[Model], target: str = "Original USD"):
        self.parts, self.target = parts, target

    def add(self, df: DataFrame, out: str = "prediction", features: str = "features", first: int | None = None) -> DataFrame:
        """Append the prediction, in USD; ``first`` takes that many parts only."""
        parts = self.parts[:first]
        for i, m in enumerate(parts):
            name = f"_{out}_{i}"
            df = m.add(df, features, name) if isinstance(m, GrownForest) else m.copy({m.featuresCol: features, m.predictionCol: name}).transform(df)
        mean = sum((F.col(f"_{out}_{i}") for i in range(len(parts))), F.lit(0.0)) / len(parts)
        mean = mean if self.target == "Original USD" else F.expm1(mean)
        return df.withColumn(out, mean).drop(*[f"_{out}_{i}" for i in range(len(parts))])

    def stages(self, out: str = "predicted_salary_usd") -> list:
        """The same as stages of a ``PipelineModel`` that can be saved."""
        kept = [m.model() if isinstance(m, GrownForest) else m for m in self.parts]
        kept = [m.copy({m.predictionCol: f"prediction_{i}"}) for i, m in enumerate(kept)]
        mean = " + ".join(f"prediction_{i}" for i in range(len(kept)))
        mean = f"({mean}) / {len(kept)}"
        mean = mean if self.target == "Original USD" else f"expm1({mean})"
        return [*kept, SQLTransformer(statement=f"SELECT *, {mean} AS {out} FROM __THIS__")]

    def close(self) -> None:
        """Delete the files of forests; nothing may be scored after it."""
        for m in self.parts:
            if isinstance(m, GrownForest):
                m.close()


def fit(candidate: Candidate, rows: DataFrame, n: int, sd: dict[str, float], target: str = "Original USD") -> Fitted:
    label = TARGETS[target]
    in_tasks = candidate.algorithm == FOREST or candidate.algorithm == BOOSTING and n <= BOOSTED_ROWS
    return Fitted([e.grow(rows) if in_tasks else e.fit(rows) for e in candidate.estimators(label, n, sd[label])], target)


def scores(df: DataFrame, prediction: str = "prediction") -> dict[bool, tuple[float, float, float]]:
    """held -> (MAE, RMSE, R2) in USD, from one pass."""
    rows = df.groupBy("held").agg(*metric_aggs("usd", prediction)).collect()
    return {r["held"]: (r["MAE"], r["RMSE"], r["R2"]) for r in rows}


def scored(candidate: Candidate, fd: FoldData, target: str = "Original USD", rows: DataFrame | None = None) -> dict[bool, tuple[float, float, float]]:
    """The scores of a fit on its fold, or on ``rows`` of it; the fit is not kept."""
    fitted = fit(candidate, fd.train, fd.n, fd.sd, target)
    try:
        return scores(fitted.add(fd.rows if rows is None else rows))
    finally:
        fitted.close()


def depth_maes(candidate: Candidate, fd: FoldData, depths: list[int]) -> dict[int, dict[bool, float]]:
    """depth -> held -> MAE of the candidate's forest at that depth, all from one
    fit of the deepest."""
    fitted = fit(Candidate(FOREST, candidate.params | {"maxDepth": max(depths)}), fd.train, fd.n, fd.sd)
    try:
        df, parts = fd.rows, range(len(fitted.parts))
        for i in parts:
            df = fitted.parts[i].add_depths(df, "features", {f"p{d}_{i}": d for d in depths})
        said = {d: sum(F.col(f"p{d}_{i}") for i in parts) / len(parts) for d in depths}
        rows = {r["held"]: r for r in df.groupBy("held").agg(*[F.avg(F.abs(F.col("usd") - p)).alias(f"p{d}") for d, p in said.items()]).collect()}
        return {d: {held: r[f"p{d}"] for held, r in rows.items()} for d in depths}
    finally:
        fitted.close()


def mean(values: list[float]) -> float:
    return sum(values) / len(values)


def spread(values: list[float]) -> float:
    return mean([(v - mean(values)) ** 2 for v in values]) ** 0.5


def summary(per_fold: list[dict]) -> dict[str, float]:
    """I7 from the scores of each fold."""
    held, trained = [s[True] for s in per_fold], [s[False] for s in per_fold]
    return {"CV_MAE": mean([s[0] for s in held]), "CV_MAE_SD": spread([s[0] for s in held]), "CV_RMSE": mean([s[1] for s in held]),
            "CV_R2": mean([s[2] for s in held]), "Train_MAE": mean([s[0] for s in trained])}


def cross_validate(folds: list[FoldData], candidates: dict[str, tuple[Candidate, str]]) -> dict[str, dict[str, float]]:
    """name -> I7 summary of each (candidate, target); the longest fits start first."""

    def one(job):
        name, fd = job
        candidate, target = candidates[name]
        return name, scored(candidate, fd, target)

    heavy = sorted(candidates, key=lambda name: [BOOSTING, FOREST, LINEAR].index(candidates[name][0].algorithm))
    done = side_by_side(one, [(name, fd) for name in heavy for fd in folds])
    return {name: summary([s for other, s in done if other == name]) for name in candidates}


def out_of_fold(folds: list[FoldData], candidate: Candidate, target: str = "Original USD") -> DataFrame:
    """I8: the prediction of each development row by the model that has not
    seen it; the union of the folds' held rows, one row a key."""
    fitted = side_by_side(lambda fd: fit(candidate, fd.train, fd.n, fd.sd, target), folds)
    parts = [m.add(fd.valid).select("job_id", "fold", "usd", "prediction") for m, fd in zip(fitted, folds)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def grid_points(grid: dict) -> list[dict]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def prefix_maes(algorithm: str, fitted: Fitted, fd: FoldData, lengths: list[int]) -> dict[int, dict[bool, float]]:
    """length -> held -> MAE of the fit's prefix of that length."""
    df = fd.rows
    if algorithm == BOOSTING and isinstance(fitted.parts[0], GrownForest):
        df = fitted.parts[0].add_prefixes(df, "features", {f"p{m}": m for m in lengths})
    elif algorithm == BOOSTING:
        (model,) = fitted.parts
        curves = {True: model.evaluateEachIteration(fd.valid, "absolute"), False: model.evaluateEachIteration(fd.train, "absolute")}
        return {m: {held: curve[m - 1] for held, curve in curves.items()} for m in lengths}
    else:
        for m in lengths:
            df = fitted.add(df, f"p{m}", first=m // BLOCK or 1)
    aggs = [F.avg(F.abs(F.col("usd") - F.col(f"p{m}"))).alias(f"p{m}") for m in lengths]
    rows = {r["held"]: r for r in df.groupBy("held").agg(*aggs).collect()}
    return {m: {held: r[f"p{m}"] for held, r in rows.items()} for m in lengths}


def grid_search(folds: list[FoldData], algorithm: str, grid: dict | None = None) -> list[tuple[Candidate, dict[str, float]]]:
    """Every point of the grid with its CV and train MAE, best first (ties
    by parameters).  Points that differ in the number of trees share a fit."""
    grid = dict(grid or GRIDS[algorithm])
    if algorithm == LINEAR and set(grid) == {"alpha"}:
        per_fold = side_by_side(lambda fd: ridge_scores(fd, [(a, None) for a in grid["alpha"]]), folds)
        rows = [(Candidate(LINEAR, p), {m: summary([f[i] for f in per_fold])[m] for m in ("CV_MAE", "CV_MAE_SD", "Train_MAE")})
                for i, p in enumerate(grid_points(grid))]
        return sorted(rows, key=lambda r: (r[1]["CV_MAE"], r[0].to_json()))
    lengths = sorted(grid.pop(LENGTH[algorithm])) if algorithm in LENGTH else []
    if algorithm == FOREST and any(m % BLOCK for m in lengths):
        jobs = [(p | {"numTrees": m}, [m]) for p in grid_points(grid) for m in lengths]
    elif lengths:
        jobs = [(p | {LENGTH[algorithm]: lengths[-1]}, lengths) for p in grid_points(grid)]
    else:
        jobs = [(p, [None]) for p in grid_points(grid)]

    def one(job):
        (params, kept), fd = job
        if kept == [None]:
            return {None: {held: s[0] for held, s in scored(Candidate(algorithm, params), fd).items()}}
        fitted = fit(Candidate(algorithm, params), fd.train, fd.n, fd.sd)
        try:
            return prefix_maes(algorithm, fitted, fd, kept)
        finally:
            fitted.close()

    deep = sorted(jobs, key=lambda j: j[0].get("maxDepth") or models.MAX_TREE_DEPTH, reverse=True)
    found = side_by_side(one, [(job, fd) for job in deep for fd in folds])
    rows = []
    for j, (params, kept) in enumerate(deep):
        per_fold = found[j * len(folds):(j + 1) * len(folds)]
        for m in kept:
            point = params if m is None else params | {LENGTH[algorithm]: m}
            held, trained = [f[m][True] for f in per_fold], [f[m][False] for f in per_fold]
            rows.append((Candidate(algorithm, point), {"CV_MAE": mean(held), "CV_MAE_SD": spread(held), "Train_MAE": mean(trained)}))
    return sorted(rows, key=lambda r: (r[1]["CV_MAE"], r[0].to_json()))
