"""Centroid clustering (op11) and whitening (op12) against plain versions."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from llm_cases import SMOKE

from wagelens.llm import lookup_clusters, whitening

SCHEMA = "vec_id long, embedding array<double>, cluster string, x long, hash string, key int"


def odd_rows(dims, n=60, seed=3):
    """Random vectors with ties, repeated rows, null ids, and rows that take no part."""
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-1.0, 0.5, 0.25, rng.gauss(0, 1)]) for _ in range(dims)]) for i in range(n)]
    rows += [rows[3], rows[3], (3, rows[5][1]), (None, rows[7][1]), (901, rows[9][1])]
    rows += [(902, None), (903, []), (904, [1.0] * (dims - 1)), (905, [None] * dims),
             (906, [math.nan] * dims), (907, [math.inf] * dims), (908, [-math.inf] + [0.0] * (dims - 1))]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "c", 1, "h", 2) for i, v in rows], SCHEMA)


def plain_clusters(rows, k, rounds, dims, scale):
    kept = [(i, [math.floor(scale * c) for c in v]) for i, v in rows
            if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(x) for _, x in order[:k]]

    def nearest(x):
        found = [(sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centroids)]
        return min(found)

    for _ in range(rounds):
        members = {}
        for _, x in kept:
            members.setdefault(nearest(x)[1], []).append(x)
        for j, xs in members.items():
            centroids[j] = [sum(col) // len(xs) for col in zip(*xs)]
    last = [(i, *nearest(x)) for i, x in kept]
    inertia = {}
    for _, dist, j in last:
        inertia[j] = inertia.get(j, 0) + dist
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i if i is not None else -1, j, dist, inertia[j], sum(inertia.values()), digest[j]) for i, dist, j in last))


@pytest.mark.parametrize("k,dims", [(5, 4), (100, 4), (1, 3)])
def test_clusters_equal_plain_rounds(spark, k, dims):
    rows = odd_rows(dims)
    got = lookup_clusters.cluster(frame(spark, rows), k=k, rounds=5, dimensions=dims, scale=8)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    found = sorted(((r[0] if r[0] is not None else -1, *r[1:]) for r in got.collect()))
    assert found == plain_clusters(rows, k, 5, dims, 8)


def test_clusters_of_wide_and_negative_values(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 9000, 3).tolist()) for i in range(80)]
    got = lookup_clusters.cluster(frame(spark, rows), k=7, rounds=5, dimensions=3)
    assert sorted(tuple(r) for r in got.collect()) == plain_clusters(rows, 7, 5, 3, 256)
    with pytest.raises(Exception, match="out of range"):
        lookup_clusters.cluster(frame(spark, [(1, [1e9, 0.0, 0.0])]), k=1, dimensions=3)


def test_clusters_of_nothing(spark):
    empty = frame(spark, odd_rows(4)).where("vec_id > 901")
    assert lookup_clusters.cluster(empty, dimensions=4).collect() == []
    assert lookup_clusters.cluster(empty.limit(0), dimensions=4).collect() == []


def test_starts_need_no_full_sort(spark, monkeypatch):
    """The least hashes are found by raising a limit, whatever the first share."""
    vectors = spark.range(500).selectExpr("id AS vec_id", "array(id) AS x")
    rows = lookup_clusters.first_by_hash(vectors, 10, "2")
    want = sorted(range(500), key=lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest())[:10]
    assert [r["vec_id"] for r in rows] == want


def test_registered_clusters_equal_sql(spark):
    import __spark_entry__ as entry
    name = "op11_lookup_table_clustering"
    got = entry.queries()[name](spark, SMOKE)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SMOKE}/embeddings.parquet')")
    cur = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    want = sorted(tuple(r[names.index(c)] for c in got.columns) for r in cur.fetchall())
    assert sorted(tuple(r) for r in got.collect()) == want


def plain_whitening(rows, dims, components, scale=64, shift=1_000_000):
    kept = [(i, [math.floor(scale * c) + shift for c in v]) for i, v in rows
            if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}))
    n, total = len(fit), fit.sum(0)
    y = fit - total / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    return kept, n, total, values[:components], vectors[:, :components], values.sum()


def check_whitening(rows, dims, components, out):
    kept, n, total, values, vectors, trace = plain_whitening(rows, dims, components)
    assert len(out) == len(kept) * components
    assert {r["n"] for r in out} == {n}
    by_id = {}
    for r in out:
        by_id.setdefault(r["vec_id"], []).append(r)
    signs = np.zeros(components)
    for i, x in kept:
        want = (np.array(x) - total / n) @ vectors / np.sqrt(values)
        deviation = sum((n * a - int(s)) ** 2 for a, s in zip(x, total))
        mine = [r for r in by_id[i] if r["deviation"] == deviation]
        assert mine
        for r in mine:
            c = r["component"] - 1
            if signs[c] == 0 and abs(want[c]) > 1e-6:
                signs[c] = np.sign(want[c] * r["whitened"])
        for c in range(components):
            close = [r for r in mine if r["component"] == c + 1 and abs(r["whitened"] * (signs[c] or 1) - want[c]) < 1e-8]
            assert close
    for r in out:
        assert abs(r["explained"] - values[r["component"] - 1] / trace) < 1e-10
        assert r["identity_error"] < 1e-10


def test_whitening_equals_eigenvectors(spark):
    rows = odd_rows(6, 200)
    out = whitening.whiten(frame(spark, rows), components=5).collect()
    check_whitening(rows, 6, 5, out)


def test_whitening_keeps_exact_deviation_and_null_beyond_64_bits():
    rng = np.random.default_rng(2)
    x = rng.integers(-10**9, 10**9, (50, 3))
    n, left = 10**5, [7, 0, 99]
    base = np.array([1, 2, 3])
    got = whitening.deviations(x, base, left, n)
    for row, value in zip(x.tolist(), got):
        want = sum((n * (a - b) - r) ** 2 for a, b, r in zip(row, base.tolist(), left))
        assert value == (want if want < 1 << 63 else None)
    small = x // 10**6
    assert whitening.deviations(small, base, left, n) == [
        sum((n * (a - b) - r) ** 2 for a, b, r in zip(row, base.tolist(), left)) for row in small.tolist()]


def test_whitening_of_few_vectors_and_of_nothing(spark):
    line = [(i, [float(i), 2.0 * i, -3.0 * i]) for i in range(9)]      # one direction only
    out = whitening.whiten(frame(spark, line), components=3).collect()
    assert {r["component"] for r in out} == {1} and len(out) == 9
    assert abs(out[0]["explained"] - 1) < 1e-12 and out[0]["identity_error"] < 1e-10
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    empty = whitening.whiten(frame(spark, line).limit(0))
    assert empty.collect() == [] and empty.columns[:3] == ["vec_id", "component", "n"]


def test_factor_and_rotation():
    rng = np.random.default_rng(4)
    for d, rank in ((1, 1), (7, 7), (12, 5), (33, 33)):
        a = rng.normal(size=(d, rank)) * np.logspace(0, -4, rank)
        scatter = a @ a.T
        factor, order = whitening.pivoted_cholesky(scatter)
        assert np.allclose(factor @ factor.T, scatter[order][:, order], atol=1e-12)
        assert np.allclose(np.triu(factor, 1), 0)
        values, vectors = whitening.components_of(scatter)
        assert len(values) <= rank or d == rank
        assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-10)
        assert np.allclose(values, np.linalg.eigvalsh(scatter)[::-1][:len(values)], rtol=1e-6, atol=1e-14)
    seen = [(min(a, b), max(a, b)) for left, right in whitening.pairings(7) for a, b in zip(left, right)]
    assert sorted(seen) == [(a, b) for a in range(7) for b in range(a + 1, 7)]
