"""Queries of the training-data operators: name -> (builder, DuckDB SQL or None).

SQL expresses the rows of op11 alone; the others need index structures,
tokenizers, fitted models or eigenvectors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from wagelens.llm import (decontaminate, jaccard_join, license_scan, lookup_clusters, nearest_vectors, packing, pii, quality,
                          secret_scan, suffix_dedup, token_files, toxicity, whitening)
from wagelens.llm.shared import load

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


@register("op7_best_fit_packing")
def op7(spark, sf_dir):
    return packing.pack(load(spark, sf_dir, "documents"), packing.tokenizer_path())


@register("op8_benchmark_decontamination")
def op8(spark, sf_dir):
    return decontaminate.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


@register("op2_secret_scans")
def op2(spark, sf_dir):
    return secret_scan.digest(load(spark, sf_dir, "documents"))


@register("op10_pii_weak_supervision")
def op10(spark, sf_dir):
    return pii.digest(load(spark, sf_dir, "documents"))


@register("op3_ngram_jaccard_join")
def op3(spark, sf_dir):
    return jaccard_join.join(load(spark, sf_dir, "documents"))


@register("op6_toxicity_nearest_examples")
def op6(spark, sf_dir):
    return toxicity.score(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@register("op9_random_projection_forest")
def op9(spark, sf_dir):
    return nearest_vectors.neighbours(load(spark, sf_dir, "embeddings"))


@register("op5_suffix_array_dedup")
def op5(spark, sf_dir):
    return suffix_dedup.dedup(load(spark, sf_dir, "documents"))


@register("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


@register("op1_quality_kneser_ney")
def op1(spark, sf_dir):
    return quality.classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@register("op4_license_scans")
def op4(spark, sf_dir):
    return license_scan.scan(load(spark, sf_dir, "documents"))


@register("op11_lookup_table_clustering", lookup_clusters.lloyd_sql())
def op11(spark, sf_dir):
    return lookup_clusters.cluster(load(spark, sf_dir, "embeddings"))


@register("op12_embedding_whitening")
def op12(spark, sf_dir):
    return whitening.whiten(load(spark, sf_dir, "embeddings"))


@register("op13_token_files")
def op13(spark, sf_dir):
    return token_files.round_trip(load(spark, sf_dir, "documents"), token_files.tokenizer_path())
