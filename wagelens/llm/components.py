"""Connected components of a link table by alternating star contractions.

Large-star hooks the larger neighbours of a node to its least neighbour,
small-star the smaller ones; both keep the components and shrink every one
to a star around its least id in a logarithmic number of rounds.  Each round
is written in the shared folder; nothing but two numbers reaches the driver.
A hub's rows are only aggregated and joined with its one least id, so a hub
is split like any skewed join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wagelens.llm.shared import store


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    hooked = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hooked.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """(node, component): every node of a link with its component's least id."""
    edges = store(edges.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v")).where("u <> v"), "links")
    seen = None
    while True:
        edges = store(_small_star(_large_star(edges)), "stars")
        # A star forest no longer changes; the two numbers tell.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == seen:
            break
        seen = now
    least = edges.groupBy("u").agg(F.min("v").alias("component"))
    centres = edges.select(F.col("v").alias("u"), F.col("v").alias("component")).distinct()
    return least.union(centres).select(F.col("u").alias("node"), "component")
