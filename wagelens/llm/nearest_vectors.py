"""Approximate nearest neighbours by a forest of random-projection trees (op9).

The forest's splits are fitted on a bounded sample of the vectors; every
vector is indexed.  A node holds a random direction and the sample's median
along it.  A query goes through all trees with one shared priority queue: the
open branch with the least accumulated distance to its side comes next, until
enough leaves are gathered.  Vectors and queries of a leaf meet in bounded
blocks, are scored exactly in double precision, and the best of all blocks
are ranked.

Equal vectors form one class with its ``k + 1`` least ids, found with a
map-side limit, so a very common vector neither fills a leaf nor a task; a
query needs no more of them, so results stay whole.  A leaf with many classes
or many queries is cut into several blocks, each seeing everything it needs.

Broadcast: the forest, at most ``TREES * FIT / LEAF`` splits.

Defined results: a vector that is null, zero, of another length than most, or
holds a null or non-finite component takes no part; repeated rows count once;
fewer candidates than ``k`` are all returned; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wagelens.llm.shared import small_batches, store

NEAREST = 20
TREES = 12
#: Bounds of the fitted model: sampled vectors, and sampled vectors in a leaf.
FIT = 20_000
LEAF = 128
#: Leaves that a query opens, over all trees.
OPENED = 200
#: Vectors, and queries, that meet in one block.
BLOCK = 2048
SEED = 20


def grow(sample: np.ndarray, trees: int, leaf: int, seed: int):
    """Splits of the forest: directions, thresholds, and per node the two
    children (a negative child is leaf ``-child - 1``); and the tree roots."""
    rng = np.random.default_rng(seed)
    dims = sample.shape[1]
    directions, thresholds, children, roots = [], [], [], []
    leaves = 0

    def node(rows: np.ndarray) -> int:
        nonlocal leaves
        if len(rows) > leaf:
            direction = rng.standard_normal(dims)
            direction /= np.linalg.norm(direction)
            side = sample[rows] @ direction
            cut = float(np.median(side))
            right = side > cut
            if right.any() and not right.all():
                me = len(directions)
                directions.append(direction)
                thresholds.append(cut)
                children.append(None)
                children[me] = (node(rows[~right]), node(rows[right]))
                return me
        leaves += 1
        return -leaves

    for _ in range(trees):
        roots.append(node(np.arange(len(sample))))
    return (np.array(directions).reshape(-1, dims), np.array(thresholds), np.array(children, np.int64).reshape(-1, 2),
            np.array(roots, np.int64))


def leaves_of(forest, vectors: np.ndarray) -> np.ndarray:
    """Leaf of every vector in every tree: (vectors, trees)."""
    directions, thresholds, children, roots = forest
    side = vectors @ directions.T > thresholds if len(directions) else np.zeros((len(vectors), 0), bool)
    at = np.repeat(roots[None, :], len(vectors), 0)
    row = np.arange(len(vectors))[:, None]
    while (at >= 0).any():
        inner = np.maximum(at, 0)
        down = children[inner, side[row, inner].astype(np.int64)] if len(directions) else at
        at = np.where(at >= 0, down, at)
    return -at - 1


def search(forest, queries: np.ndarray, opened: int) -> list[list[int]]:
    """Leaves that each query opens, best first, through one queue over all trees."""
    directions, thresholds, children, roots = forest
    margin = (queries @ directions.T - thresholds) if len(directions) else np.zeros((len(queries), 0))
    child = children.tolist()
    out = []
    for m in margin.tolist():
        heap = [(0.0, r) for r in roots.tolist()]
        heapq.heapify(heap)
        leaves: list[int] = []
        while heap and len(leaves) < opened:
            far, at = heapq.heappop(heap)
            while at >= 0:
                left, right = child[at]
                d = m[at]
                near, other = (right, left) if d > 0 else (left, right)
                # The other side costs the squared distance to the split.
                heapq.heappush(heap, (far + d * d, other))
                at = near
            leaves.append(-at - 1)
        out.append(leaves)
    return out


def matrix(column) -> np.ndarray:
    """A list column of equal lengths as a double matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def route(shared, opened: int):
    """Rows (leaf, row) of the leaves that hold a vector, or that a query opens."""
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            v = matrix(batch.column("embedding"))
            leaves = search(shared.value, v, opened) if opened else leaves_of(shared.value, v).tolist()
            row = np.repeat(np.arange(len(v)), [len(x) for x in leaves])
            flat = np.array([y for x in leaves for y in x], np.int32)
            for a in range(0, len(flat), 8192):  # a batch fans out into bounded ones
                part = pa.table(batch.select(["id", "embedding"]).take(pa.array(row[a:a + 8192])))
                yield from part.append_column("leaf", pa.array(flat[a:a + 8192])).combine_chunks().to_batches()

    return run


def rank_block(k: int):
    """Exact scores of a block; the best ``k + 1`` classes of each query."""
    import pandas as pd

    def run(vectors, queries):
        if len(vectors) == 0 or len(queries) == 0:
            return pd.DataFrame({"query_id": [], "cid": [], "score": []}).astype({"query_id": "int64", "cid": "int64", "score": "float64"})
        v = np.stack(vectors["embedding"].to_numpy()).astype(np.float64)
        q = np.stack(queries["embedding"].to_numpy()).astype(np.float64)
        cid = vectors["id"].to_numpy()
        by = np.argsort(cid)
        v, cid = v[by], cid[by]
        score = q @ v.T
        if score.shape[1] > k + 1:
            cut = -np.partition(-score, k, axis=1)[:, k]
            # Ties with the last one stay in; the final ranking settles them.
            row, col = np.nonzero(score >= cut[:, None] - 1e-12)
        else:
            row, col = np.nonzero(np.ones_like(score, bool))
        # The score of a pair must not depend on its block: one product a pair.
        exact = np.einsum("ij,ij->i", q[row], v[col])
        return pd.DataFrame({"query_id": queries["id"].to_numpy()[row], "cid": cid[col], "score": exact})

    return run


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def neighbours(table: DataFrame, k: int = NEAREST, every: int = 20, trees: int = TREES, opened: int = OPENED) -> DataFrame:
    """The ``k`` nearest found of each row whose ``vec_id`` is divisible by
    ``every``: ``query_id, rank, vec_id, score``."""
    spark = table.sparkSession
    small_batches(spark)
    # Float vectors travel as floats; scores are computed in doubles.
    held_as = "array<float>" if "float" in table.schema["embedding"].dataType.simpleString() else "array<double>"
    rows = (table.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast(held_as).alias("embedding"))
            .where(F.col("id").isNotNull() & usable(F.col("embedding"))))
    lengths = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = store(rows.where(F.size("embedding") == (lengths[0] if lengths else 0)).dropDuplicates(["id"]), "vectors")

    # Rank limits run before the shuffle as well: k + 1 rows a task and vector.
    first = Window.partitionBy("embedding").orderBy("id")
    classes = store(rows.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1).groupBy("embedding")
                    .agg(F.array_sort(F.collect_list("id")).alias("ids"))
                    .select(F.element_at("ids", 1).alias("id"), "embedding", "ids"), "classes")
    sample = classes.select("id", "embedding").orderBy(F.xxhash64("id"), "id").limit(FIT).orderBy("id").toArrow()
    column = sample.column("embedding").combine_chunks()
    forest = grow(matrix(column), trees, LEAF, SEED) if len(column) else (np.zeros((0, 1)), np.zeros(0), np.zeros((0, 2), np.int64), np.zeros(0, np.int64))
    shared = spark.sparkContext.broadcast(forest)

    kind = f"id long, embedding {held_as}, leaf int"
    held = store(classes.select("id", "embedding").mapInArrow(route(shared, 0), kind), "leaves")
    asked = store(rows.where(F.col("id") % every == 0).mapInArrow(route(shared, opened), kind), "probes")
    # Blocks of a leaf: its classes and its queries in as many parts as they need.
    parts = lambda df, name: df.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))
    plan = parts(held, "vs").join(parts(asked, "qs"), "leaf")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = lambda n: F.pmod(F.xxhash64("id"), F.col(n).cast("long")).cast("int")
    left = held.join(plan, "leaf").select("leaf", mine("vs").alias("v"), spread("qs").alias("q"), "id", "embedding")
    right = asked.join(plan, "leaf").select("leaf", spread("vs").alias("v"), mine("qs").alias("q"), "id", "embedding")
    met = left.groupBy("leaf", "v", "q").cogroup(right.groupBy("leaf", "v", "q")).applyInPandas(
        rank_block(k), "query_id long, cid long, score double")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "cid")
    found = (met.groupBy("query_id", "cid").agg(F.max("score").alias("score"))
             .withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1))
    each = (found.join(classes.select(F.col("id").alias("cid"), "ids"), "cid")
            .select("query_id", "score", F.explode("ids").alias("vec_id")).where("vec_id <> query_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
