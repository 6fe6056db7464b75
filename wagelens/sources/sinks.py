"""Sinks (A7, A9, A10): layer tables and analysis tables.

Silver is written once, partitioned by quality status; a layer is a set of
statuses, so reading one prunes the folders of the others and the columns
that it does not name.  CSV copies of a layer flatten arrays (``skills_list``
joined with '|').  All writes go to a folder under the shared storage the
caller names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wagelens.rules import REVIEW_STATUSES

STATUS = "salary_quality_status"
#: Layer -> statuses of its rows; None: all.
LAYERS = {"silver": None, "training": ("model_ready",), "scoring": ("unlabeled",), "review": tuple(REVIEW_STATUSES)}


def _flat(df: DataFrame) -> DataFrame:
    """Arrays -> pipe-joined strings (for CSV)."""
    return df.select(*[F.array_join(F.col(f.name), "|").alias(f.name) if isinstance(f.dataType, T.ArrayType)
                       else F.col(f.name) for f in df.schema.fields])


def export_layers(silver: DataFrame, path: str) -> str:
    """Every layer by one write, a folder per status."""
    silver.write.mode("overwrite").partitionBy(STATUS).parquet(path)
    return path


def read_layer(spark: SparkSession, path: str, layer: str, columns: list[str] | None = None) -> DataFrame:
    """A stored layer: only the folders of its statuses are listed and read."""
    statuses = LAYERS[layer]
    df = spark.read.parquet(path)
    df = df if statuses is None else df.where(F.col(STATUS).isin(*statuses))
    return df.select(*columns) if columns else df


def export_layer_csv(spark: SparkSession, path: str, layer: str, target: str) -> str:
    """A layer as CSV, from the stored Silver."""
    return write_table(read_layer(spark, path, layer), target, "csv")


def write_table(df: DataFrame, path: str, fmt: str = "csv") -> str:
    """One analysis table per folder, in as many files as it has partitions."""
    out = _flat(df) if fmt == "csv" else df
    w = out.write.mode("overwrite")
    (w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path))
    return path


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A10: (layer, rows) of the stored folders, counted by status in one scan
    that reads no column files beyond their row counts."""
    per = spark.read.parquet(path).groupBy(STATUS).agg(F.count(F.lit(1)).alias("_n"))
    inside = lambda s: F.lit(True) if s is None else F.col(STATUS).isin(*s)
    row = per.agg(*[F.coalesce(F.sum(F.when(inside(s), F.col("_n"))), F.lit(0)).alias(layer) for layer, s in LAYERS.items()])
    return row.select(F.inline(F.array(*[F.struct(F.lit(layer).alias("layer"), F.col(layer).alias("rows")) for layer in LAYERS])))
