"""Encoded folds, stored once for a whole model search.

The preprocessor of a fold is fitted on that fold's training rows only.  Its
branches treat every column by itself, so one fit over the columns of *all*
feature sets holds each single set as a choice of vector slots.  The encoded
rows of the ``k`` folds are written once, partitioned by fold; every feature
set, algorithm, grid point and target then reads its fold's partition and
slices the slots it needs.  A lost executor costs a reread.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorSlicer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagelens.ml.features import (FEATURE_SPECS, LevelTableModel, NumericModel, OneHotModel, TfidfModel, branches,
                                  preprocessor)
from wagelens.rules import CV_FOLDS

#: Rows of one task of a fit.  Fits are many short jobs: small folds must not
#: be cut into more tasks than they fill.
ROWS_PER_TASK = 50_000
#: Independent fits submitted side by side (as ``CrossValidator``'s
#: ``parallelism``).  A tree fit is a chain of short jobs, so more of them than
#: cores keep the cores busy.
PARALLELISM = 8
#: Target of the fits -> label column of the stored rows.
TARGETS = {"Original USD": "usd", "Log target": "log_usd"}


def side_by_side(fn, items, parallelism: int = PARALLELISM) -> list:
    """``fn`` over ``items`` in driver threads; each call submits its own jobs."""
    items = list(items)
    if parallelism <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(items))) as pool:
        return list(pool.map(fn, items))


def union_of(specs: dict[str, dict]) -> dict:
    """One spec with the columns of all of them, each once."""
    merged = {b: list(dict.fromkeys(c for s in specs.values() for c in s[b])) for b in ("levels", "measures", "title")}
    return branches(merged["levels"], merged["measures"], merged["title"][0] if merged["title"] else None)


def column_slots(fitted: PipelineModel) -> dict[tuple[str, str], list[int]]:
    """(branch, input column) -> its places in the assembled vector."""
    slots, at = {}, 0

    def take(key: tuple[str, str], width: int) -> None:
        nonlocal at
        slots[key] = list(range(at, at + width))
        at += width

    for stage in fitted.stages:
        if isinstance(stage, OneHotModel):
            kept = stage._state()["kept"]
            for c in stage.getOrDefault(stage.inputCols):
                take(("levels", c), len(kept[c]))
        elif isinstance(stage, LevelTableModel):
            for c, width in stage.widths().items():
                take(("levels", c), width)
        elif isinstance(stage, NumericModel):
            for c in stage.getOrDefault(stage.inputCols):
                take(("measures", c), 1)
            for c in stage._state()["indicators"]:
                take(("missing", c), 1)
        elif isinstance(stage, TfidfModel):
            take(("title", stage.getOrDefault(stage.inputCol)), len(stage._state()["vocabulary"]))
    return slots


def slots_of(slots: dict[tuple[str, str], list[int]], spec: dict) -> list[int]:
    """Slots of one feature set, in the order its own preprocessor would give them."""
    wanted = [*(("levels", c) for c in spec["levels"]), *(("measures", c) for c in spec["measures"]),
              *(k for k in slots if k[0] == "missing" and k[1] in spec["measures"]), *(("title", c) for c in spec["title"])]
    return [i for key in wanted for i in slots[key]]


def tasks_for(rows: int) -> int:
    return max(1, math.ceil(rows / ROWS_PER_TASK))


@dataclass
class FoldData:
    """Rows of one fold: ``held`` ones validate, the others train."""

    rows: DataFrame
    n: int
    sd: dict[str, float]

    @property
    def train(self) -> DataFrame:
        return self.rows.where(~F.col("held"))

    @property
    def valid(self) -> DataFrame:
        return self.rows.where("held")


class FoldStore:
    """The stored folds of one development table."""

    def __init__(self, path: str, data: DataFrame, slots: list[dict], facts: dict):
        self.path, self.data, self.slots, self.facts = path, data, slots, facts

    @contextmanager
    def loaded(self, spec: dict, cached: bool = True) -> Iterator[list[FoldData]]:
        """The folds of one feature set; ``cached`` on the executors while in
        use, which pays from the second fit on."""
        out = []
        for i, slots in enumerate(self.slots):
            n, sd, total = self.facts[i]
            slicer = VectorSlicer(inputCol="encoded", outputCol="features", indices=slots_of(slots, spec))
            rows = slicer.transform(self.data.where(F.col("model") == i)).drop("encoded", "model")
            rows = rows.coalesce(tasks_for(total))
            out.append(FoldData(rows.persist(StorageLevel.MEMORY_AND_DISK) if cached else rows, n, sd))
        try:
            yield out
        finally:
            for f in out if cached else []:
                f.rows.unpersist()

    def places(self, fold: int, spec: dict, within: dict) -> list[int]:
        """Where the slots of ``spec`` stand in the vectors loaded for ``within``."""
        at = {slot: i for i, slot in enumerate(slots_of(self.slots[fold], within))}
        return [at[slot] for slot in slots_of(self.slots[fold], spec)]


def store_folds(dev: DataFrame, path: str, specs: dict[str, dict] = FEATURE_SPECS, key: str = "job_id", fold: str = "fold",
                k: int = CV_FOLDS, usd: str = "salary_avg_usd") -> FoldStore:
    """Fit the ``k`` preprocessors, write the encoded rows and read them back."""
    spark = dev.sparkSession
    spec = union_of(specs)
    dev.count()                          # one job fills a cached input before the threads share it
    fitted = side_by_side(lambda i: preprocessor(spec).fit(dev.where(F.col(fold) != i)), range(k))
    parts = None
    for i, pre in enumerate(fitted):
        rows = pre.transform(dev).select(
            F.col(key), F.col(fold), F.col(usd).alias("usd"), F.log1p(usd).alias("log_usd"),
            (F.col(fold) == i).alias("held"), F.col("features").alias("encoded"), F.lit(i).alias("model"))
        parts = rows if parts is None else parts.unionByName(rows)
    parts.write.partitionBy("model").parquet(path)
    data = spark.read.schema(parts.schema).parquet(path)
    counts = data.groupBy("model", "held").agg(
        F.count(F.lit(1)).alias("n"), *[F.stddev_pop(c).alias(f"sd_{c}") for c in TARGETS.values()]).collect()
    facts = {i: (0, {c: 0.0 for c in TARGETS.values()}, sum(r["n"] for r in counts if r["model"] == i)) for i in range(k)}
    for r in counts:
        if not r["held"]:
            facts[r["model"]] = (r["n"], {c: float(r[f"sd_{c}"] or 0.0) for c in TARGETS.values()}, facts[r["model"]][2])
    return FoldStore(path, data, [column_slots(pre) for pre in fitted], facts)


def encode_split(spec: dict, fit_rows: DataFrame, other: DataFrame, path: str, key: str = "job_id",
                 usd: str = "salary_avg_usd") -> tuple[FoldData, PipelineModel]:
    """One split as a fold: the preprocessor is fitted on ``fit_rows``, the
    rows of ``other`` are held.  Stored like the folds."""
    spark = fit_rows.sparkSession
    pre = preprocessor(spec).fit(fit_rows)
    parts = None
    for rows, held in ((fit_rows, False), (other, True)):
        out = pre.transform(rows).select(F.col(key), F.col(usd).alias("usd"), F.log1p(usd).alias("log_usd"),
                                         F.lit(held).alias("held"), "features")
        parts = out if parts is None else parts.unionByName(out)
    parts.write.parquet(path)
    data = spark.read.schema(parts.schema).parquet(path)
    r = data.agg(F.count(F.lit(1)).alias("total"), F.count(F.when(~F.col("held"), 1)).alias("n"),
                 *[F.stddev_pop(F.when(~F.col("held"), F.col(c))).alias(c) for c in TARGETS.values()]).first()
    rows = data.coalesce(tasks_for(r["total"])).persist(StorageLevel.MEMORY_AND_DISK)
    return FoldData(rows, r["n"], {c: float(r[c] or 0.0) for c in TARGETS.values()}), pre
