"""Embedding whitening by pivoted Cholesky and one-sided Jacobi (op12).

Two narrow passes over the distinct vectors give the exact sums and the
scatter of the centred vectors.  The scatter (dimension by dimension) is
factored on the driver: pivoted Cholesky gives a triangular factor, rotations
of its columns make them orthogonal, and the columns are then the components:
their squared norms are the eigenvalues, the columns over their norms the unit
eigenvectors.  Working on the factor keeps the small eigenvalues accurate,
which an eigensolver of the scatter itself does not.

A third pass projects the distinct vectors and measures the covariance of the
result; the last pass projects every row.  A task holds one block of rows and
one scatter; what it sends, and what the driver gets, depends on the dimension
only.

Defined results: vectors that are null, empty, or hold null or non-finite
entries take no part, and of vectors of several lengths only the commonest
length (the longer one of equals); components whose eigenvalue is not above
rounding (rank) are left out, so fewer than asked may come, and none from one
distinct vector or an empty table; rows without ``vec_id`` and repeated rows
are projected like others; ``deviation`` is null where it passes 64 bits;
other columns are ignored.  An entry beyond 2**50 after scaling raises an
error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagelens.llm.shared import small_batches, store
from wagelens.llm.vectors import blocks, complete, integers, key_batch, keyed_sums, matrix

COMPONENTS, SCALE, SHIFT = 16, 64, 1_000_000
LIMIT = 1 << 50
SWEEPS = 60
COLUMNS = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(L, order)`` with ``a[order][:, order] == L @ L.T``; the largest
    remaining diagonal entry comes next, and columns end where it is rounding."""
    d = len(a)
    order, left = np.arange(d), np.diag(a).astype(float).copy()
    factor = np.zeros((d, d))
    floor = d * np.finfo(float).eps * max(left.max(initial=0.0), 0.0)
    for k in range(d):
        p = k + int(np.argmax(left[k:]))
        if not left[p] > floor:
            return factor[:, :k], order
        for held in (order, left):
            held[[k, p]] = held[[p, k]]
        factor[[k, p], :k] = factor[[p, k], :k]
        factor[k, k] = np.sqrt(left[k])
        factor[k + 1:, k] = (a[order[k + 1:], order[k]] - factor[k + 1:, :k] @ factor[k, :k]) / factor[k, k]
        left[k + 1:] -= factor[k + 1:, k] ** 2
    return factor, order


def pairings(n: int):
    """Round-robin rounds of disjoint column pairs; together all pairs, once each."""
    seats = list(range(n + n % 2))
    for _ in range(len(seats) - 1):
        half = len(seats) // 2
        pairs = [(a, b) for a, b in zip(seats[:half], reversed(seats[half:])) if max(a, b) < n]
        yield np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int)
        seats[1:] = [seats[-1], *seats[1:-1]]


def orthogonal_columns(factor: np.ndarray) -> np.ndarray:
    """One-sided Jacobi: rotate pairs of columns until all are orthogonal."""
    c = factor.copy()
    eps = np.finfo(float).eps
    for _ in range(SWEEPS):
        worst = 0.0
        for left, right in pairings(c.shape[1]):
            if not len(left):
                continue
            x, y = c[:, left], c[:, right]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            size = np.abs(xy) / np.sqrt(xx * yy)
            worst = max(worst, size.max())
            turn = size > eps
            zeta = (yy - xx)[turn] / (2 * xy[turn])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cos = 1 / np.hypot(1.0, t)
            sin = cos * t
            a, b = left[turn], right[turn]
            c[:, a], c[:, b] = cos * x[:, turn] - sin * y[:, turn], sin * x[:, turn] + cos * y[:, turn]
        if worst <= 4 * eps:
            break
    return c


def components_of(scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of the scatter, falling, and unit eigenvectors as columns."""
    factor, order = pivoted_cholesky(scatter)
    columns = orthogonal_columns(factor)
    norms = np.sqrt((columns * columns).sum(0))
    by_size = np.argsort(-norms, kind="stable")
    vectors = np.zeros_like(columns)
    vectors[order] = columns[:, by_size] / norms[by_size]
    return norms[by_size] ** 2, vectors


def centred(x: np.ndarray, base: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """``x`` less the mean ``base + rest``: the whole part in integers, so that
    no digit is lost to the shift."""
    return (x - base) - rest


def column_sums(dims: int):
    """Exact sums by dimension, in halves so that 64 bits hold them; the key after the last counts rows."""

    def run(batches):
        low, high, n = np.zeros(dims, np.int64), np.zeros(dims, np.int64), 0
        for block in blocks(batches):
            x = matrix(block.column("x"))
            low += (x & 0xFFFFFF).sum(0)
            high += (x >> 24).sum(0)
            n += len(x)
        yield key_batch(np.arange(2 * dims + 1), np.concatenate((low, high, [n])))

    return run


def products(shared, projected: bool):
    """Sums of ``y`` and of ``y y'`` (upper triangle) over a task's rows, ``y``
    being the centred vectors or their projections."""

    def run(batches):
        base, rest, to = shared.value
        width = to.shape[1] if projected else len(base)
        first, second = np.zeros(width), np.zeros((width, width))
        for block in blocks(batches):
            y = centred(matrix(block.column("x")), base, rest)
            y = y @ to if projected else y
            first += y.sum(0)
            second += y.T @ y
        values = np.concatenate((first, second[np.triu_indices(width)]))
        yield key_batch(np.arange(len(values)), values)

    return run


def scatter_of(sums: dict[int, float], width: int, n: int) -> np.ndarray:
    """The scatter, less what rounding left of the mean."""
    first = np.array([sums[i] for i in range(width)])
    out = np.zeros((width, width))
    out[np.triu_indices(width)] = [sums[width + i] for i in range(width * (width + 1) // 2)]
    out = out + np.triu(out, 1).T
    return out - np.outer(first, first) / n


def deviations(x: np.ndarray, base: np.ndarray, left: list[int], n: int) -> list[int | None]:
    """Exact sums of ``(n * x - S)**2``; ``S = n * base + left``."""
    small = x - base
    bound = n * (int(np.abs(small).max(initial=0)) + 1)
    if bound * bound * x.shape[1] < 1 << 63:
        z = n * small - np.array(left, np.int64)
        return (z * z).sum(1).tolist()
    z = small.astype(object) * n - np.array(left, object)
    return [s if s < 1 << 63 else None for s in (z * z).sum(1)]


def project(shared, n: int, left: list[int], explained: list[float], error: float):
    def run(batches):
        base, rest, to = shared.value
        width = to.shape[1]
        for block in blocks(batches, 1024):
            x = matrix(block.column("x"))
            whitened = centred(x, base, rest) @ to
            each = np.repeat(np.arange(len(x)), width)
            deviation = pa.array(deviations(x, base, left, n), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [block.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(each), n)), deviation.take(pa.array(each)), pa.array(whitened.ravel()),
                 pa.array(np.tile(explained, len(x))), pa.array(np.full(len(each), error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whiten(table: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row per remaining vector and component."""
    spark = table.sparkSession
    small_batches(spark)
    vector = F.col("embedding")
    rows = (table.select(F.col("vec_id").cast("long").alias("vec_id"), vector.cast("array<double>").alias("embedding"))
            .where(complete(vector) & (F.size(vector) > 0)))
    commonest = rows.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if commonest is None:
        return spark.createDataFrame([], COLUMNS)
    dims = commonest[0]
    rows = store(rows.where(F.size(vector) == dims).select("vec_id", integers(vector, scale, shift, LIMIT).alias("x")), "vectors")
    fit = store(rows.select("x").distinct(), "fit")

    sums = keyed_sums(fit, column_sums(dims))
    n = sums[2 * dims]
    total = [sums[d] + (sums[dims + d] << 24) for d in range(dims)]
    base = np.array([s // n for s in total], np.int64)
    left = [s % n for s in total]
    rest = np.array([r / n for r in left])

    shared = spark.sparkContext.broadcast((base, rest, np.zeros((dims, 0))))
    scatter = scatter_of(keyed_sums(fit, products(shared, False), "double"), dims, n)
    values, vectors = components_of(scatter)
    width = min(components, len(values))
    if width == 0:
        return spark.createDataFrame([], COLUMNS)
    to = vectors[:, :width] / np.sqrt(values[:width] / n)
    explained = (values[:width] / np.trace(scatter)).tolist()

    shared = spark.sparkContext.broadcast((base, rest, to))
    covariance = scatter_of(keyed_sums(fit, products(shared, True), "double"), width, n) / n
    error = float(np.abs(covariance - np.eye(width)).max())
    return rows.mapInArrow(project(shared, n, left, explained, error), COLUMNS)
