"""Centroid clustering of integer vectors by scalar lookup tables (op11).

A component takes few integer values, so a round never multiplies vectors.
For each block of vectors and each dimension, the squared differences between
the values that occur there and every centroid are tabulated once; a distance
is then a gather of table rows, summed over the dimensions.  All arithmetic
is on 64-bit integers and exact, so results do not depend on the order or the
number of tasks.

A task holds one block and its tables (values that occur in the block, at
most its rows, by centroids).  It sends one partial sum for each centroid and
dimension; the driver gets ``k * (dims + 1)`` totals a round and sends back
the centroids.  Vectors are written once to the shared folder, so a lost
executor costs a reread.

Defined results: vectors that are null, of another length, or hold null or
non-finite components take no part; a row without ``vec_id`` takes part, its
hash is that of an empty id; rows of one ``vec_id`` are ordered by their
vector, and repeated rows count as often as they occur; with fewer than ``k``
vectors each is a centroid; an empty table gives no rows; other columns are
ignored.  A component beyond 2**27 after scaling raises an error.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagelens.llm.shared import small_batches, store
from wagelens.llm.vectors import blocks, complete, integers, key_batch, keyed_sums, matrix

CENTROIDS, ROUNDS, DIMENSIONS, SCALE, SALT = 40, 5, 64, 256, "2"
LIMIT = 1 << 27
COLUMNS = "vec_id long, cluster int, distance long"


def occurring(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of an integer column, ascending, and each row's place among them."""
    low = int(column.min())
    span = int(column.max()) - low + 1
    if span > 8 * len(column):
        return np.unique(column, return_inverse=True)
    shifted = column - low
    seen = np.zeros(span, bool)
    seen[shifted] = True
    return low + np.flatnonzero(seen), (np.cumsum(seen) - 1)[shifted]


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances (rows by centroids) from one lookup table a dimension."""
    total = np.zeros((len(x), len(centroids)), np.int64)
    for d in range(x.shape[1]):
        values, place = occurring(x[:, d])
        table = (values[:, None] - centroids[None, :, d]) ** 2
        total += table[place]
    return total


def partial_sums(shared):
    """A task's ``(centroid, dimension)`` sums; the place after the last dimension counts rows."""

    def run(batches):
        centroids = shared.value
        k, dims = centroids.shape
        sums = np.zeros((k, dims + 1), np.int64)
        for block in blocks(batches):
            x = matrix(block.column("x"))
            nearest = distances(x, centroids).argmin(axis=1)
            order = np.argsort(nearest, kind="stable")
            held, first = np.unique(nearest[order], return_index=True)
            sums[held, :dims] += np.add.reduceat(x[order], first, axis=0)
            sums[:, dims] += np.bincount(nearest, minlength=k)
        filled = np.repeat(sums[:, dims] > 0, dims + 1)
        yield key_batch(np.flatnonzero(filled), sums.ravel()[filled])

    return run


def assign(shared):
    def run(batches):
        for block in blocks(batches):
            found = distances(matrix(block.column("x")), shared.value)
            nearest = found.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [block.column("vec_id"), pa.array(nearest.astype(np.int32)),
                 pa.array(np.take_along_axis(found, nearest[:, None], 1)[:, 0])], ["vec_id", "cluster", "distance"])

    return run


def first_by_hash(vectors: DataFrame, k: int, salt: str) -> list:
    """The ``k`` rows of least ``sha256("<salt>:<vec_id>")``, in that order.

    Hashes are uniform, so a limit on their first 52 bits that about ``4 k``
    ids pass is set from the row count and raised until ``k`` rows are below it: what
    reaches the driver does not grow with the number of tasks or rows."""
    hashed = vectors.withColumn("hash", F.sha2(F.concat(F.lit(salt + ":"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256))
    share = min(1.0, (4 * k + 16) / max(1, vectors.count()))
    while True:
        low = hashed if share >= 1 else hashed.where(F.conv(F.substring("hash", 1, 13), 16, 10).cast("long") < int(share * 2**52))
        rows = low.orderBy("hash", "x").limit(k).collect()
        if len(rows) >= k or share >= 1:
            return rows
        share = min(1.0, 8 * share)


def moved(centroids: np.ndarray, sums: dict[int, int]) -> np.ndarray:
    """Exact componentwise floor means; a centroid without vectors stays."""
    k, dims = centroids.shape
    out = centroids.copy()
    for c in range(k):
        n = sums.get(c * (dims + 1) + dims, 0)
        if n:
            out[c] = [sums[c * (dims + 1) + d] // n for d in range(dims)]
    return out


def cluster(table: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS,
            scale: int = SCALE, salt: str = SALT) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` per kept vector."""
    spark = table.sparkSession
    small_batches(spark)
    vector = F.col("embedding")
    kept = (table.select(F.col("vec_id").cast("long").alias("vec_id"), vector.cast("array<double>").alias("embedding"))
            .where(complete(vector) & (F.size(vector) == dimensions)))
    vectors = store(kept.select("vec_id", integers(vector, scale, 0, LIMIT).alias("x")), "cluster-vectors")
    centroids = np.array([r["x"] for r in first_by_hash(vectors, k, salt)], np.int64).reshape(-1, dimensions)
    if len(centroids) == 0:
        return spark.createDataFrame([], COLUMNS + ", cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(centroids)
        centroids = moved(centroids, keyed_sums(vectors, partial_sums(shared)))
        shared.destroy()
    shared = spark.sparkContext.broadcast(centroids)
    assigned = store(vectors.mapInArrow(assign(shared), COLUMNS), "clusters")
    # At most ``k`` rows; sums beyond 64 bits fail on their way into a long column.
    per = {r[0]: int(r[1]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)"))).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = [(c, inertia, sum(per.values()), digest[c]) for c, inertia in per.items()]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def lloyd_sql(k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, salt: str = SALT) -> str:
    """The same in DuckDB SQL: vectors in long form, one pair of tables a round."""
    parts = [f"""kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(CAST(c AS DOUBLE) * {scale}) AS BIGINT)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {dimensions}
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(CAST(c AS DOUBLE)))) = 0),
v AS MATERIALIZED (SELECT vec_id, unnest(range(0, {dimensions})) AS d, unnest(x) AS x FROM kept),
start AS (SELECT x, row_number() OVER (ORDER BY sha256('{salt}:' || vec_id), x) - 1 AS k FROM kept),
c0 AS MATERIALIZED (SELECT k, unnest(range(0, {dimensions})) AS d, unnest(x) AS x FROM start WHERE k < {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, arg_min(k, (distance, k)) AS k, min(distance) AS distance
  FROM (SELECT v.vec_id, c.k, CAST(sum((v.x - c.x) * (v.x - c.x)) AS BIGINT) AS distance
        FROM v JOIN c{r} AS c ON c.d = v.d GROUP BY 1, 2) AS pairs GROUP BY vec_id)""")
        if r < rounds:
            parts.append(f"""m{r} AS MATERIALIZED (
  SELECT k, d, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM v JOIN a{r} USING (vec_id) GROUP BY 1, 2),
c{r + 1} AS MATERIALIZED (
  SELECT c.k, c.d, CASE WHEN m.n IS NULL THEN c.x ELSE (m.s - (m.s % m.n + m.n) % m.n) // m.n END AS x
  FROM c{r} AS c LEFT JOIN m{r} AS m ON m.k = c.k AND m.d = c.d)""")
    return "WITH " + ",\n".join(parts) + f""",
digest AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c{rounds} GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN digest USING (k)"""
