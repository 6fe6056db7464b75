"""Many ridge fits over the same rows: one pass of moments, one pass of errors.

A ridge line depends on its rows only through the products of the columns, so
every penalty and every choice of columns is solved from one Gram matrix
(``RowMatrix``, summed on the executors; its size is the vector's width
squared).  The errors of all lines are then summed in one pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagelens.ml.folds import FoldData

SUMS = "line int, held boolean, n long, absolute double, squared double, shifted double, spread double"


def gram(rows: DataFrame, label: str) -> np.ndarray:
    """Products of (features, label, 1) summed over the rows."""
    wide = VectorAssembler(inputCols=["features", label, "_one"], outputCol="_v").transform(rows.withColumn("_one", F.lit(1.0)))
    return RowMatrix(MLUtils.convertVectorColumnsFromML(wide.select("_v"), "_v")).computeGramianMatrix().toArray()


def line(g: np.ndarray, penalty: float, places: list[int]) -> tuple[np.ndarray, float]:
    """Weights over the whole vector (0 outside ``places``) and intercept of
    the least squared error + n * penalty / sd(label) * squared weights, which
    is what ``models.ridge`` minimises."""
    width, n = len(g) - 2, g[-1, -1]
    means, mean = g[places, -1] / n, g[width, -1] / n
    a = g[np.ix_(places, places)] - n * np.outer(means, means)
    b = g[places, width] - n * means * mean
    sd = np.sqrt(max(g[width, width] / n - mean**2, 0.0))
    weights = np.zeros(width)
    if sd > 0 and len(places):
        a = a + (n * penalty / sd) * np.eye(len(places))
        weights[places] = np.linalg.lstsq(a, b, rcond=None)[0] if penalty == 0 else np.linalg.solve(a, b)
    return weights, float(mean - means @ weights[places])


def dense(vectors: pa.StructArray, width: int) -> np.ndarray:
    """Rows of a vector column as one array."""
    out = np.zeros((len(vectors), width))
    kind, values, indices = vectors.field("type").to_numpy(), vectors.field("values"), vectors.field("indices")
    sizes = np.diff(values.offsets.to_numpy())
    row = np.repeat(np.arange(len(out)), sizes)
    flat = values.flatten().to_numpy()
    full = np.repeat(kind == 1, sizes)
    out[kind == 1] = flat[full].reshape(-1, width)
    out[row[~full], indices.flatten().to_numpy()] = flat[~full]
    return out


def sum_errors(weights: np.ndarray, intercepts: np.ndarray, centre: float):
    """Per task: sums over its rows of each line's errors."""

    def run(batches):
        total = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column("y").to_numpy(zero_copy_only=False)
            held = batch.column("held").to_numpy(zero_copy_only=False)
            e = dense(batch.column("features"), len(weights)) @ weights + intercepts - y[:, None]
            for part in (False, True):
                mine, ys = e[held == part], y[held == part] - centre
                ones = np.ones(e.shape[1])
                sums = np.array([len(ys) * ones, np.abs(mine).sum(0), (mine**2).sum(0), ys.sum() * ones, (ys**2).sum() * ones])
                total[part] = total.get(part, 0.0) + sums
        for part, sums in total.items():
            k = sums.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(k, dtype=np.int32)), pa.array([part] * k), pa.array(sums[0].astype(np.int64)), *map(pa.array, sums[1:])],
                ["line", "held", "n", "absolute", "squared", "shifted", "spread"])

    return run


def ridge_scores(fold: FoldData, lines: list[tuple[float, list[int] | None]], label: str = "usd") -> list[dict]:
    """held -> (MAE, RMSE, R2) for each (alpha, places in ``features``; none:
    all of them), as fitting and scoring each by itself gives."""
    g = gram(fold.train, label)
    found = [line(g, alpha * fold.sd[label] / fold.n if fold.n else 0.0, list(range(len(g) - 2)) if places is None else places)
             for alpha, places in lines]
    run = sum_errors(np.column_stack([w for w, _ in found]), np.array([b for _, b in found]), float(g[-2, -1] / g[-1, -1]))
    sums = fold.rows.select("held", F.col(label).alias("y"), "features").mapInArrow(run, SUMS).groupBy("line", "held").agg(
        *[F.sum(c).alias(c) for c in ("n", "absolute", "squared", "shifted", "spread")]).collect()
    out: list[dict] = [{} for _ in lines]
    for r in sums:
        if r["n"]:
            sst = r["spread"] - r["shifted"] ** 2 / r["n"]
            r2 = 1 - r["squared"] / sst if sst > 0 else (1.0 if r["squared"] == 0 else 0.0)
            out[r["line"]][r["held"]] = (r["absolute"] / r["n"], (r["squared"] / r["n"]) ** 0.5, r2)
    return out
