"""Corpus preparation over ``documents``: five stages, each stored and reread.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame.  All but the
last return the columns of ``documents``:

1. toxicity: documents predicted toxic go;
2. n-gram Jaccard join: of each group of near-duplicates the least doc_id stays;
3. benchmark decontamination: contaminated documents go;
4. secret scans: secrets in the texts are masked;
5. best-fit packing: the remaining texts as placed token pieces.

Empty tables, null texts and repeated rows pass as each operator defines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wagelens.llm import decontaminate, jaccard_join, packing, secret_scan, toxicity
from wagelens.llm.shared import load, store


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, load(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_per_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", one_of_each_group),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scans", mask_secrets),
    ("best_fit_packing", pack),
]

#: Fitted models, index structures and a tokenizer: no SQL gives these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
