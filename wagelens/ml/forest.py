"""Forests and boosting whose trees are grown in tasks.

MLlib grows all trees of a forest together, a level at a time: every row keeps
its draws and its node for each tree (about 10 bytes a row and tree, stored and
checkpointed), and every level shuffles the statistics of every open node of
every tree.  With 250 trees of unlimited depth that is many times the table on
disk, and most of the time.

Here the rows are binned once (MLlib's candidate thresholds; columns of few bins
share a byte) and stored as flat files that every worker maps.  A task then grows its trees from
start to end on its own: nothing is shuffled, and a tree holds about 9 bytes for
each row that it drew.  The trees are flat files too, mapped by the workers that
score (``GrownForest.add``: a walk of all rows of a batch down a tree at once), so
no tree passes the driver.  Where a model is kept, they are written in MLlib's own
format and loaded as a ``RandomForestRegressionModel`` (``GrownForest.model``).

The method is MLlib's: Poisson draws of the rows, a random subset of the columns
at every node, at most ``maxBins - 1`` thresholds a column, variance as impurity,
``minInstancesPerNode`` counted in draws.  Only the random numbers differ.  Draws
hang on the seed, the tree and the row's place, subsets on the seed, the tree and
the path to the node; so a tree does not depend on the other trees, and a less
deep tree is the top of a deeper one.

Boosting uses the same trees, all of a fit in one task (``booster``), up to
``BOOSTED_ROWS`` rows; larger fits stay MLlib's.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from wagelens.session import scratch_path

#: Rows of one block of the stored bins, and of one step over them.
BLOCK_ROWS = 1 << 18
#: Histogram cells of the nodes that are split in one step (16 bytes each).
CELLS = 1 << 22
#: Rows up to which a boosting fit is one task's work (about 30 bytes each).
BOOSTED_ROWS = 8_000_000
#: Bins that columns of few bins share.
PACK = 64
#: Rows from which thresholds are found, as in MLlib (or maxBins squared).
SAMPLE_ROWS = 10_000
#: Open rows of a part of a tree that is copied out of the mapped blocks.
COMPACT_ROWS = 1 << 18
#: A gain below this share of the whole table's variance is rounding.
ROUNDING = 1e-12

NODES = ("treeID int, nodeData struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, "
         "gain double, leftChild int, rightChild int, split struct<featureIndex int, leftCategoriesOrThreshold array<double>, "
         "numCategories int>>")


# ------------------------------------------------------------ shared files
def opened(folder: str):
    """(file system, path) of a folder that the driver and all workers share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder.removeprefix("file:"))


def mapped(store, path: str, dtype) -> np.ndarray:
    """A flat file as an array, memory-mapped where the folder is mounted."""
    from pyarrow import fs

    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype, mode="r")
    with store.open_input_file(path) as file:
        return np.frombuffer(file.read(), dtype)


# -------------------------------------------------------------- thresholds
def thresholds(values: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` thresholds between different values of a sample: all
    midpoints, or those nearest to equal shares of the rows."""
    kinds, counts = np.unique(values[~np.isnan(values)], return_counts=True)
    middle = (kinds[:-1] + kinds[1:]) / 2
    if len(middle) <= most:
        return middle
    below = np.cumsum(counts)[:-1]
    wanted = np.arange(1, most + 1) * (counts.sum() / (most + 1))
    at = np.clip(np.searchsorted(below, wanted), 1, len(below) - 1)
    at -= wanted - below[at - 1] < below[at] - wanted
    return middle[np.unique(at)]


def subset_size(strategy: str, columns: int, trees: int) -> int:
    """Columns tried at a node, by MLlib's names for regression."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "onethird"
    named = {"all": columns, "onethird": math.ceil(columns / 3), "sqrt": math.ceil(math.sqrt(columns)),
             "log2": max(1, math.ceil(math.log2(columns))) if columns else 0}
    if strategy in named:
        return named[strategy]
    value = float(strategy)
    return min(columns, int(value) if "." not in strategy and value >= 1 else max(1, math.ceil(value * columns)))


class Pack:
    """Columns whose bins are stored as one number below ``width``, and what
    their histogram tells: ``below`` adds up the cells under each threshold."""

    def __init__(self, members: list[int], cuts: list[np.ndarray], sample: np.ndarray):
        self.members, self.stride, self.width = members, {}, 1
        for f in members:
            self.stride[f], self.width = self.width, self.width * (len(cuts[f]) + 1)
        self.feature = np.concatenate([np.full(len(cuts[f]), f) for f in members] or [np.zeros(0, int)]).astype(np.int64)
        self.place = np.concatenate([np.arange(len(cuts[f])) for f in members] or [np.zeros(0, int)])
        cells = np.arange(self.width)
        self.below = np.stack([cells // self.stride[f] % (len(cuts[f]) + 1) <= t for f, t in zip(self.feature, self.place)] or
                              [np.zeros(self.width, bool)], axis=1).astype(np.float64)
        self.sparse = float(np.mean(self.codes(sample, cuts) == 0)) > 0.6

    def codes(self, x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
        out = np.zeros(len(x), np.uint8)
        for f in self.members:
            out += (np.searchsorted(cuts[f], x[:, f]) * self.stride[f]).astype(np.uint8)
        return out

    def left(self, cells: np.ndarray) -> np.ndarray:
        return np.cumsum(cells, axis=1)[:, :-1] if len(self.members) == 1 else cells @ self.below


def packs_of(cuts: list[np.ndarray], sample: np.ndarray) -> list[Pack]:
    """Columns that have thresholds, those of few bins together, ``PACK`` cells at most."""
    out, open_, size = [], [], 1
    for f in sorted((f for f, c in enumerate(cuts) if len(c)), key=lambda f: len(cuts[f])):
        if open_ and size * (len(cuts[f]) + 1) > PACK:
            out, open_, size = [*out, open_], [], 1
        open_, size = [*open_, f], size * (len(cuts[f]) + 1)
    return [Pack(members, cuts, sample) for members in [*out, open_]]


# ------------------------------------------------------------- binned rows
def bin_writer(folder: str, cuts: list[np.ndarray], packs: list[Pack]):
    """Task function: the bins and labels of a partition as flat files, and one
    manifest row for them.  Files of failed attempts never reach the manifest."""
    def write(batches):
        store, root = opened(folder)
        name, rows, held, files = uuid.uuid4().hex, 0, [], []

        def put(last: bool):
            """Full blocks, and at the end the rest; what is left is held."""
            nonlocal held, rows
            x, y = np.concatenate([b for b, _ in held], axis=1), np.concatenate([y for _, y in held])
            end = len(y) if last else len(y) // BLOCK_ROWS * BLOCK_ROWS
            if end and not files:
                files.extend(store.open_output_stream(f"{root}/{name}.{kind}") for kind in ("bins", "y"))
            for at in range(0, end, BLOCK_ROWS):
                files[0].write(np.ascontiguousarray(x[:, at:min(at + BLOCK_ROWS, end)]).tobytes())
                files[1].write(y[at:min(at + BLOCK_ROWS, end)].tobytes())
            held, rows = [(x[:, end:], y[end:])], rows + end

        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(y), len(cuts))
            held.append((np.stack([p.codes(x, cuts) for p in packs]), y))
            if sum(len(y) for _, y in held) >= BLOCK_ROWS:
                put(False)
        if held:
            put(True)
        for file in files:
            file.close()
        if rows:
            yield pa.RecordBatch.from_pydict({"name": [name], "rows": [rows]})

    return write


def blocks_of(folder: str, manifest: list[tuple[str, int]], packs: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bins, labels) of every block, bins a row a pack."""
    store, root = opened(folder)
    out = []
    for name, rows in manifest:
        bins, y = mapped(store, f"{root}/{name}.bins", np.uint8), mapped(store, f"{root}/{name}.y", np.float64)
        for at in range(0, rows, BLOCK_ROWS):
            n = min(BLOCK_ROWS, rows - at)
            out.append((bins[at * packs:(at + n) * packs].reshape(packs, n), y[at:at + n]))
    return out


# ------------------------------------------------------------------- trees
def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each number (splitmix64)."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Part:
    """Open rows of one block: place in it, node (counted within the step), draws."""

    def __init__(self, bins, y, place, node, draws, leaf=None):
        self.bins, self.y, self.place, self.node, self.draws, self.leaf = bins, y, place, node, draws, leaf

    def pick(self, rows, node):
        return Part(self.bins, self.y, self.place[rows], node, self.draws[rows], self.leaf)


def compact(parts: list[Part]) -> list[Part]:
    """Few open rows, copied out of the mapped blocks into one."""
    parts = [p for p in parts if len(p.place)]
    if not parts:
        return []
    bins = np.concatenate([p.bins[:, p.place] for p in parts], axis=1)
    y, node, draws = (np.concatenate(x) for x in zip(*[(p.y[p.place], p.node, p.draws) for p in parts]))
    return [Part(bins, y, np.arange(len(y), dtype=np.int32), node, draws)]


class Tree:
    """Grows one tree over binned blocks, a level of a group of nodes at a time."""

    def __init__(self, cuts: list[np.ndarray], packs: list[Pack], subset: int, max_depth: int, min_leaf: int, center: float,
                 noise: float):
        self.cuts, self.packs, self.subset = cuts, packs, subset
        self.max_depth, self.min_leaf, self.center, self.noise = max_depth, min_leaf, center, noise
        widths = [p.width for p in packs]
        self.most = max(1, min(CELLS // sum(widths), BLOCK_ROWS // max(widths)))
        #: Where the bin of a column is: pack, and what its number is divided by.
        self.pack, self.stride, self.bins = np.zeros(len(cuts), int), np.ones(len(cuts), int), np.array([len(c) + 1 for c in cuts], int)
        for i, p in enumerate(packs):
            for f in p.members:
                self.pack[f], self.stride[f] = i, p.stride[f]

    def grow(self, blocks, seed: int, tree: int, bootstrap: bool, rate: float, leaves: list[np.ndarray] | None = None):
        """The nodes of a tree; with ``leaves`` the last node of each row is put there."""
        root = np.array([np.uint64(seed % 2**64) ^ (np.uint64(tree) << np.uint64(40))], np.uint64)
        self.size, self.nodes = 0, {k: np.zeros(0) for k in ("count", "sum", "squares", "feature", "cut", "gain", "left")}
        parts = []
        for number, (bins, y) in enumerate(blocks):
            draws = np.random.default_rng([seed % 2**63, tree, number]).poisson(rate, len(y)) if bootstrap else np.ones(len(y))
            place = np.flatnonzero(draws).astype(np.int32)
            parts.append(Part(bins, y, place, np.zeros(len(place), np.int32), np.minimum(draws[place], 255).astype(np.uint8),
                              leaves[number] if leaves else None))
        for leaf in leaves or []:
            leaf[:] = 0
        stats = self.totals(parts, 1)
        first = self.record(stats)
        todo = [(parts, _mix(root), first, 0, stats)]
        while todo:
            parts, marks, ids, depth, stats = todo.pop()
            todo += self.step(parts, marks, ids, depth, stats)
        grown = {k: v[:self.size] for k, v in self.nodes.items()}
        return grown | {"value": grown["sum"] / np.maximum(grown["count"], 1) + self.center}

    # --------------------------------------------------------------- nodes
    def totals(self, parts: list[Part], nodes: int) -> np.ndarray:
        """Draws, sum and sum of squares of the (centred) labels of each node."""
        out = np.zeros((3, nodes))
        for p in parts:
            if len(p.place):
                w = p.draws.astype(np.float64)
                v = p.y[p.place] - self.center
                for i, x in enumerate((w, w * v, w * v * v)):
                    out[i] += np.bincount(p.node, x, nodes)
        return out

    def record(self, stats: np.ndarray) -> np.ndarray:
        """Store nodes as leaves; their numbers in the tree."""
        ids = np.arange(self.size, self.size + stats.shape[1])
        self.size += len(ids)
        if self.size > len(self.nodes["count"]):
            self.nodes = {k: np.concatenate([v, np.zeros(self.size)]) for k, v in self.nodes.items()}
        for name, values in zip(("count", "sum", "squares", "feature", "gain", "left"), (*stats, -1, -1, -1)):
            self.nodes[name][ids] = values
        return ids

    def step(self, parts, marks, ids, depth, stats):
        """Split the nodes of one group; the groups of their children."""
        count, total, squares = stats
        spread = squares - total * total / np.maximum(count, 1)
        open_ = (count >= 2 * self.min_leaf) & (spread > self.noise * count) & (depth < self.max_depth)
        if not open_.all():
            if not open_.any():
                return []
            parts = self.route(parts, np.where(open_, np.cumsum(open_) - 1, -1).astype(np.int32))
            marks, ids, count, total, stats = marks[open_], ids[open_], count[open_], total[open_], stats[:, open_]
        if len(ids) > self.most:              # parts of the level, one after the other
            out = []
            for at in range(0, len(ids), self.most):
                some = slice(at, at + self.most)
                inner = []
                for p in parts:
                    rows = np.flatnonzero((p.node >= at) & (p.node < at + self.most))
                    inner.append(p.pick(rows, p.node[rows] - np.int32(at)))
                out.append((inner, marks[some], ids[some], depth, stats[:, some]))
            return out
        if len(parts) > 1 and parts[0].leaf is None and sum(len(p.place) for p in parts) <= COMPACT_ROWS:
            parts = compact(parts)
        feature, at, gain = self.best(parts, marks, count, total)
        split = gain > self.noise * count
        if not split.any():
            return []
        rank = np.where(split, np.cumsum(split) - 1, -1).astype(np.int32)
        children = []
        for p in parts:
            rows = np.flatnonzero(rank[p.node] >= 0)
            node = p.node[rows]
            code = p.bins[self.pack[feature][node], p.place[rows]]
            right = code // self.stride[feature][node] % self.bins[feature][node] > at[node]
            children.append(p.pick(rows, rank[node] * np.int32(2) + right.astype(np.int32)))
        below = self.totals(children, 2 * int(split.sum()))
        new = self.record(below)
        for p in children:
            if p.leaf is not None:
                p.leaf[p.place] = new[p.node]
        for name, values in (("feature", feature[split]), ("gain", gain[split] / count[split]), ("left", new[0::2]),
                             ("cut", [self.cuts[f][t] for f, t in zip(feature[split], at[split])])):
            self.nodes[name][ids[split]] = values
        marks = _mix(np.stack([marks[split] * np.uint64(2), marks[split] * np.uint64(2) + np.uint64(1)], axis=1).ravel())
        return [(children, marks, new, depth + 1, below)]

    def route(self, parts, rank):
        out = []
        for p in parts:
            rows = np.flatnonzero(rank[p.node] >= 0)
            out.append(p.pick(rows, rank[p.node[rows]]))
        return out

    def best(self, parts, marks, count, total):
        """Best column, threshold and gain (times draws) of each node."""
        nodes, allowed = len(count), self.allowed(marks)
        score, feature, at = np.full(nodes, -np.inf), np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        sums = [(np.zeros(nodes * k.width), np.zeros(nodes * k.width)) for k in self.packs]
        for p in parts:
            if not len(p.place):
                continue
            whole, w, node = len(p.place) == p.bins.shape[1], p.draws.astype(np.float64), p.node.astype(np.int64)
            v = w * (p.y[p.place] - self.center)
            for i, pack in enumerate(self.packs):
                code, key, x, y = p.bins[i] if whole else p.bins[i][p.place], node, w, v
                if pack.sparse:
                    rows = np.flatnonzero(code)
                    code, key, x, y = code[rows], node[rows], w[rows], v[rows]
                key = key * pack.width + code
                sums[i][0][:] += np.bincount(key, x, nodes * pack.width)
                sums[i][1][:] += np.bincount(key, y, nodes * pack.width)
        for pack, (weight, value) in zip(self.packs, sums):
            if not len(pack.feature):
                continue
            weight, value = weight.reshape(nodes, -1), value.reshape(nodes, -1)
            if pack.sparse:
                weight[:, 0], value[:, 0] = count - weight[:, 1:].sum(axis=1), total - value[:, 1:].sum(axis=1)
            left, below = pack.left(weight), pack.left(value)
            right, above = count[:, None] - left, total[:, None] - below
            fits = (left >= self.min_leaf) & (right >= self.min_leaf)
            if allowed is not None:
                fits &= allowed[:, pack.feature]
            found = np.where(fits, below * below / np.maximum(left, 1) + above * above / np.maximum(right, 1), -np.inf)
            cut = found.argmax(axis=1)
            found = found[np.arange(nodes), cut]
            better = found > score
            score[better], feature[better], at[better] = found[better], pack.feature[cut[better]], pack.place[cut[better]]
        return feature, at, score - total * total / count

    def allowed(self, marks: np.ndarray) -> np.ndarray | None:
        """The random subset of columns of each node, none where all are tried."""
        columns = len(self.cuts)
        if self.subset >= columns:
            return None
        ranks = _mix(marks[:, None] + np.arange(1, columns + 1, dtype=np.uint64)[None, :] * np.uint64(0xD1B54A32D192ED03))
        chosen = np.argpartition(ranks, self.subset - 1, axis=1)[:, :self.subset]
        out = np.zeros((len(marks), columns), bool)
        np.put_along_axis(out, chosen, True, axis=1)
        return out


def tree_grower(folder: str, manifest, cuts, grower: dict, seed: int, bootstrap: bool, rate: float):
    """Task function: the trees of the given numbers, a file and a manifest row a tree."""
    def grow(batches):
        tree = Tree(cuts, **grower)
        blocks = blocks_of(f"{folder}/rows", manifest, len(tree.packs))
        store, root = opened(f"{folder}/nodes")
        for batch in batches:
            for number in batch.column(0).to_pylist():
                yield put_tree(store, root, number, tree.grow(blocks, seed, number, bootstrap, rate))

    return grow


def booster(folder: str, manifest, cuts, grower: dict, trees: int, step: float):
    """Task function: the trees of one boosting fit, each on what those before
    it leave (MLlib's: the first of weight one, the others fit twice the rest)."""
    def grow(batches):
        tree = Tree(cuts, **grower)
        blocks = blocks_of(f"{folder}/rows", manifest, len(tree.packs))
        store, root = opened(f"{folder}/nodes")
        reached, leaves = [np.zeros(len(y)) for _, y in blocks], [np.zeros(len(y), np.int32) for _, y in blocks]
        for batch in batches:
            for number in range(trees) if batch.num_rows else ():
                targets = [(bins, y if number == 0 else 2 * (y - f)) for (bins, y), f in zip(blocks, reached)]
                tree.center = grower["center"] if number == 0 else 0.0
                grown = tree.grow(targets, 0, number, False, 1.0, leaves)
                for f, leaf in zip(reached, leaves):
                    f += (1.0 if number == 0 else step) * grown["value"][leaf]
                yield put_tree(store, root, number, grown)

    return grow


def put_tree(store, root: str, number: int, grown: dict[str, np.ndarray]) -> pa.RecordBatch:
    name = uuid.uuid4().hex
    with store.open_output_stream(f"{root}/{name}") as file:
        for column, kind in NODE_FILE:
            file.write(grown[column].astype(kind).tobytes())
    return pa.RecordBatch.from_pydict({"tree": [number], "name": [name], "nodes": [len(grown["count"])]})


#: Columns of a tree's file, one after the other.  The right child follows the left.
NODE_FILE = (("cut", "f8"), ("value", "f8"), ("count", "f8"), ("sum", "f8"), ("squares", "f8"), ("gain", "f8"), ("feature", "i4"), ("left", "i4"))


def nodes_of(store, path: str, nodes: int) -> dict[str, np.ndarray]:
    flat, out, at = mapped(store, path, np.uint8), {}, 0
    for column, kind in NODE_FILE:
        size = nodes * np.dtype(kind).itemsize
        out[column], at = np.asarray(flat[at:at + size]).view(kind), at + size
    return out


def walk(tree: dict[str, np.ndarray], x: np.ndarray, depths: list[int] | None = None) -> np.ndarray:
    """The tree's value of each row of ``x``: all rows go down a level at a time.
    With rising ``depths`` a row of values for each, of the tree cut there."""
    columns, flat, out = x.shape[1], x.ravel(), []
    node, live, depth = np.zeros(len(x), np.int64), np.arange(len(x)), 0
    if tree["left"][0] < 0:
        live = live[:0]
    while len(live) or depths and len(out) < len(depths):
        if depths and depth == depths[len(out)]:
            out.append(tree["value"][node])
            if len(out) == len(depths):
                break
        depth += 1
        at = node[live]
        right = ~(flat[live * columns + tree["feature"][at]] <= tree["cut"][at])
        at = tree["left"][at] + right
        node[live] = at
        live = live[tree["left"][at] >= 0]
    return np.stack(out) if depths else tree["value"][node]


def scorer(folder: str, manifest: list[tuple[int, str, int]], weights: list[float], ends: list[int], depths: list[int] | None = None):
    """Column function: the weighted sums of the first trees, as many as each of
    ``ends`` says, for an array of values; or those of all trees at ``depths``."""
    @arrow_udf("array<double>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        store, root = opened(folder)
        trees = [nodes_of(store, f"{root}/{name}", nodes) for _, name, nodes in manifest[:ends[-1]]]
        for batch in batches:
            x = batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
            sums, found = np.zeros((len(depths), len(x)) if depths else len(x)), []
            for i, (tree, weight) in enumerate(zip(trees, weights)):
                sums += weight * walk(tree, x, depths)
                if i + 1 in ends:
                    found.append(sums.copy())
            flat = (sums if depths else np.stack(found)).T
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * flat.shape[1]), pa.array(flat.ravel()))

    return score


def node_rows(t: dict[str, np.ndarray], number: int) -> pa.RecordBatch:
    """A tree's nodes as MLlib saves them; stored sums are of labels less a center."""
    center = t["value"][0] - t["sum"][0] / max(t["count"][0], 1)
    n, inner = len(t["count"]), t["feature"] >= 0
    mean = t["value"] - center
    spread = np.maximum(t["squares"] / np.maximum(t["count"], 1) - mean * mean, 0.0)
    plain = t["sum"] + center * t["count"]                       # of the labels themselves
    squares = t["squares"] + 2 * center * t["sum"] + center * center * t["count"]
    left, right = t["left"], np.where(inner, t["left"] + 1, -1)
    lists = lambda flat, ends: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.float64()))
    split = pa.StructArray.from_arrays(
        [pa.array(t["feature"]), lists(t["cut"][inner], np.concatenate([[0], np.cumsum(inner)])),
         pa.array(np.full(n, -1, np.int32))], ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    data = pa.StructArray.from_arrays(
        [pa.array(np.arange(n, dtype=np.int32)), pa.array(t["value"]), pa.array(spread),
         lists(np.stack([t["count"], plain, squares], axis=1).ravel(), np.arange(n + 1) * 3), pa.array(t["count"].astype(np.int64)),
         pa.array(t["gain"]), pa.array(left, pa.int32()), pa.array(right, pa.int32()), split],
        ["id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild", "split"])
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, number, np.int32)), data], ["treeID", "nodeData"])


# --------------------------------------------------------------- estimator
class GrownForest:
    """A fitted ensemble as a folder of trees, until ``close`` deletes it."""

    def __init__(self, spark: SparkSession, path: str, manifest, columns: int, estimator):
        self.spark, self.path, self.manifest = spark, path, manifest
        self.columns, self.estimator = columns, estimator

    def add(self, df: DataFrame, features: str, out: str) -> DataFrame:
        return self.add_prefixes(df, features, {out: len(self.manifest)})

    def add_prefixes(self, df: DataFrame, features: str, lengths: dict[str, int]) -> DataFrame:
        """A column for each number of first trees, all from one walk."""
        ends = sorted(set(lengths.values()))
        score = scorer(f"{self.path}/nodes", self.manifest, self.estimator.tree_weights(len(self.manifest)), ends)
        df = df.withColumn("_sums", score(vector_to_array(features)))
        return df.withColumns({name: F.col("_sums")[ends.index(n)] / self.estimator.divisor(n) for name, n in lengths.items()}).drop("_sums")

    def add_depths(self, df: DataFrame, features: str, depths: dict[str, int]) -> DataFrame:
        """A column for each depth: what a forest of that depth says, as a less
        deep tree is the top of a deeper one."""
        wanted, trees = sorted(set(depths.values())), len(self.manifest)
        score = scorer(f"{self.path}/nodes", self.manifest, self.estimator.tree_weights(trees), [trees], wanted)
        df = df.withColumn("_sums", score(vector_to_array(features)))
        return df.withColumns({name: F.col("_sums")[wanted.index(d)] / self.estimator.divisor(trees) for name, d in depths.items()}).drop("_sums")

    def model(self) -> RandomForestRegressionModel | GBTRegressionModel:
        """The same trees as MLlib's model, held by the driver."""
        path = scratch_path(self.spark, "forest-model")
        folder, files = f"{self.path}/nodes", {n: (name, nodes) for n, name, nodes in self.manifest}

        def read(batches):
            store, root = opened(folder)
            for batch in batches:
                for number in batch.column(0).to_pylist():
                    name, nodes = files[number]
                    yield node_rows(nodes_of(store, f"{root}/{name}", nodes), number)

        try:
            tasks = min(len(files), self.spark.sparkContext.defaultParallelism)
            self.spark.range(0, len(files), 1, tasks).mapInArrow(read, NODES).write.parquet(f"{path}/data")
            self.estimator._metadata(self.spark, path, len(files), self.columns)
            return self.estimator.model_class.load(path)
        finally:
            remove(self.spark, path)

    def close(self) -> None:
        remove(self.spark, self.path)


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class _InTasks:
    """What the two ensembles share: binned rows, and trees as files."""

    def divisor(self, trees: int) -> float:
        return 1.0

    def _grow(self, dataset: DataFrame, trees: int, strategy: str, jobs: int, grow) -> GrownForest:
        """``jobs`` numbers are dealt to tasks, which run ``grow``."""
        spark = dataset.sparkSession
        get = self.getOrDefault
        rows = dataset.select(F.col(get(self.labelCol)).cast("double").alias("y"), vector_to_array(get(self.featuresCol)).alias("x"))
        facts = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.nanvl("y", F.lit(None).cast("double"))).alias("labels"),
                         F.avg("y").alias("mean"), F.var_pop("y").alias("var")).first()
        if not facts["n"]:
            raise ValueError("no rows to fit trees on")
        if facts["labels"] < facts["n"]:
            raise ValueError("a label is null or no number")
        cuts, packs = self._cuts(rows, facts["n"])
        path = scratch_path(spark, "forest")
        store, root = opened(path)
        for folder in ("rows", "nodes"):
            store.create_dir(f"{root}/{folder}", recursive=True)
        manifest = [(r["name"], r["rows"]) for r in
                    rows.mapInArrow(bin_writer(f"{path}/rows", cuts, packs), "name string, rows long").collect()]
        grower = {"packs": packs, "subset": subset_size(strategy, len(cuts), trees), "max_depth": get(self.maxDepth),
                  "min_leaf": get(self.minInstancesPerNode), "center": facts["mean"], "noise": ROUNDING * (facts["var"] or 0.0)}
        grown = spark.range(0, jobs, 1, min(jobs, 4 * spark.sparkContext.defaultParallelism)).mapInArrow(
            grow(path, manifest, cuts, grower), "tree long, name string, nodes long").collect()
        remove(spark, f"{path}/rows")
        return GrownForest(spark, path, sorted((r["tree"], r["name"], r["nodes"]) for r in grown), len(cuts), self)

    def _cuts(self, rows: DataFrame, n: int) -> tuple[list[np.ndarray], list[Pack]]:
        """Thresholds of each column, from a sample of MLlib's size, and their packs."""
        bins = min(self.getOrDefault(self.maxBins), 256)
        share = max(bins * bins, SAMPLE_ROWS) / n
        some = rows.select("x") if share >= 1 else rows.select("x").sample(False, share, self.getOrDefault(self.seed))
        held = [r["x"] for r in some.collect()] or [rows.first()["x"]]
        x = np.array(held, dtype=np.float64).reshape(len(held), -1)
        cuts = [thresholds(x[:, f], bins - 1) for f in range(x.shape[1])]
        return cuts, packs_of(cuts, x)

    def _metadata(self, spark: SparkSession, path: str, trees: int, columns: int) -> None:
        """The files beside the nodes, as the model's ``save`` writes them."""
        plain = {p.name: v for p, v in self._paramMap.items()}
        default = {p.name: v for p, v in self._defaultParamMap.items()}
        common = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
        whole = common | {"class": f"org.apache.spark.ml.regression.{self.model_class.__name__}", "uid": self.uid, "paramMap": plain,
                          "defaultParamMap": default, "numFeatures": columns, "numTrees": trees}
        spark.createDataFrame([(json.dumps(whole),)], "value string").coalesce(1).write.text(f"{path}/metadata")
        of_one = {"featuresCol", "labelCol", "maxBins", "maxDepth", "minInstancesPerNode", "predictionCol", "seed"}
        one = common | {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel",
                        "paramMap": {k: v for k, v in plain.items() if k in of_one},
                        "defaultParamMap": {k: v for k, v in default.items() if k in of_one}}
        weights = self.tree_weights(trees)
        held = [(i, json.dumps(one | {"uid": f"dtr_{uuid.uuid4().hex[:12]}"}), weights[i]) for i in range(trees)]
        spark.createDataFrame(held, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")


class TaskForestRegressor(_InTasks, RandomForestRegressor):
    """``RandomForestRegressor`` with its parameters and model, fitted a tree a task."""

    model_class = RandomForestRegressionModel

    def _fit(self, dataset: DataFrame) -> RandomForestRegressionModel:
        grown = self.grow(dataset)
        try:
            return grown.model()
        finally:
            grown.close()

    def grow(self, dataset: DataFrame) -> GrownForest:
        get, trees = self.getOrDefault, self.getOrDefault(self.numTrees)
        return self._grow(dataset, trees, get(self.featureSubsetStrategy), trees,
                          lambda *at: tree_grower(*at, get(self.seed), get(self.bootstrap), get(self.subsamplingRate)))

    def tree_weights(self, trees: int) -> list[float]:
        return [1.0] * trees

    def divisor(self, trees: int) -> float:
        return float(trees)


class TaskBoostingRegressor(_InTasks, GBTRegressor):
    """``GBTRegressor`` that can also ``grow`` its trees in one task: a tree waits
    for the one before, and with MLlib each waits for several jobs.  ``fit`` is
    MLlib's own, which spreads a table of any size over all tasks."""

    model_class = GBTRegressionModel

    def grow(self, dataset: DataFrame) -> GrownForest:
        get = self.getOrDefault
        if get(self.subsamplingRate) != 1.0:
            raise ValueError("rows are not sampled in a task")
        return self._grow(dataset, get(self.maxIter), "all", 1, lambda *at: booster(*at, get(self.maxIter), get(self.stepSize)))

    def tree_weights(self, trees: int) -> list[float]:
        return [1.0] + [self.getOrDefault(self.stepSize)] * (trees - 1)
