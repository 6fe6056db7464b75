"""Permutation importance over one donor table.

A repeat is one random order of the holdout rows: the row at rank r takes the
values of the donor at rank r of that order.  All columns of a repeat use the
same donors, so the rows exist once per repeat, never per column: a row and
its donor stand side by side, and each column in turn is read from the donor.

``importance`` works on encoded rows.  An input column is a few slots of the
assembled vector, so a swapped row is the row's own vector with those slots
cut from the donor's, and the fitted regressor adds one prediction a column in
the same pass.  ``importance_by_columns`` does the same for any fitted model
that reads plain columns.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wagelens.ml.candidates import Fitted
from wagelens.operators.splits import hash_order, hash_rank_within
from wagelens.rules import RANDOM_STATE

REPEATS = 10
#: Rank order of the receiving rows, beside repeats 0, 1, ...
OWN = -1


def ranks(rows: DataFrame, key: str, first: int, last: int, seed: int = RANDOM_STATE) -> DataFrame:
    """``rows`` with (repeat, rank) for the repeats ``first`` to ``last``: every
    order of the keys, by md5 of key, repeat and seed."""
    each = rows.select("*", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("repeat"))
    order = hash_order(F.concat(F.col(key).cast("string"), F.lit("#"), F.col("repeat").cast("string")), seed)
    return hash_rank_within(each, ["repeat"], order, [F.col(key)], "rank")


def donors(rows: DataFrame, key: str, repeats: int = REPEATS, seed: int = RANDOM_STATE) -> DataFrame:
    """(repeat, rank, key, donor): who takes whose values."""
    own = ranks(rows.select(key), key, OWN, OWN, seed).drop("repeat")
    return _takers(rows, own, key, repeats, seed).select("rank", "repeat", "donor", key)


def _takers(rows: DataFrame, own: DataFrame, key: str, repeats: int, seed: int) -> DataFrame:
    """``own`` rows, which have a rank, with the donor of each repeat."""
    return ranks(rows.select(F.col(key).alias("donor")), "donor", 0, repeats - 1, seed).join(own, "rank")


def side_by_side(rows: DataFrame, key: str, columns: list[str], repeats: int, seed: int) -> DataFrame:
    """Rows per repeat with ``columns`` of the donor as ``_d_<column>``.  The
    receiving rows bring their values to the rank; only donors are looked up."""
    own = ranks(rows, key, OWN, OWN, seed).drop("repeat")
    given = rows.select(F.col(key).alias("donor"), *[F.col(c).alias(f"_d_{c}") for c in columns])
    return _takers(rows, own, key, repeats, seed).join(given, "donor")


def table_of(scored: DataFrame, features: list[str], label: Column) -> DataFrame:
    """Mean and SD (ddof 0) over the repeats of the MAE increase; ``p_own`` and
    ``p_0``, ``p_1``, ... are the predictions of ``scored``."""
    mae = lambda name: F.avg(F.abs(label - F.col(name)))
    per = scored.groupBy("repeat").agg(*[(mae(f"p_{i}") - mae("p_own")).alias(f"i_{i}") for i in range(len(features))])
    once = per.agg(*[F.avg(f"i_{i}").alias(f"m_{i}") for i in range(len(features))],
                   *[F.stddev_pop(f"i_{i}").alias(f"s_{i}") for i in range(len(features))])
    return once.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("Feature"), F.col(f"m_{i}").alias("Importance_MAE"), F.col(f"s_{i}").alias("Importance_SD"))
        for i, f in enumerate(features)])))


def swapped(own: str, donor: str, slots: list[int], width: int) -> Column:
    """``own`` with ``slots`` taken from ``donor`` (arrays), cut in runs."""
    taken, runs, at = set(slots), [], 0
    while at < width:
        end = at
        while end < width and (end in taken) == (at in taken):
            end += 1
        runs.append(F.slice(F.col(donor if at in taken else own), at + 1, end - at))
        at = end
    return array_to_vector(F.concat(*runs) if len(runs) > 1 else runs[0])


def importance(fitted: Fitted, rows: DataFrame, slots: dict[str, list[int]], width: int, key: str = "job_id", usd: str = "usd",
               repeats: int = REPEATS, seed: int = RANDOM_STATE) -> DataFrame:
    """Feature, Importance_MAE, Importance_SD of every input column; ``slots``
    maps a column to its places in ``features``, a vector of ``width``."""
    held = rows.select(key, usd, vector_to_array("features").alias("_x"))
    both = side_by_side(held, key, ["_x"], repeats, seed)
    features = list(slots)
    out = fitted.add(both.withColumn("_v", array_to_vector("_x")), "p_own", "_v")
    for i, f in enumerate(features):
        out = fitted.add(out.withColumn("_v", swapped("_x", "_d__x", slots[f], width)), f"p_{i}", "_v")
    return table_of(out, features, F.col(usd))


def importance_by_columns(model, rows: DataFrame, features: list[str], label: str, key: str, repeats: int = REPEATS,
                          seed: int = RANDOM_STATE, prediction: str = "prediction") -> DataFrame:
    """The same for a fitted model (its ``prediction`` column) over plain columns."""
    read = [c for c in rows.columns if c not in (key, label)]
    out = side_by_side(rows.select(key, label, *read), key, features, repeats, seed)
    out = model.transform(out).withColumnRenamed(prediction, "p_own")
    for i, f in enumerate(features):
        put = out.withColumn("_own", F.col(f)).withColumn(f, F.col(f"_d_{f}"))
        out = model.transform(put).withColumnRenamed(prediction, f"p_{i}").withColumn(f, F.col("_own")).drop("_own")
    return table_of(out, features, F.col(label))
