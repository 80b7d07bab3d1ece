"""The training corpus in five stages: quality rules, exact dedup, SimHash near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and reread as the next
stage's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from asklens.llm import exact_dedup, mixing, quality, queries, simhash
from asklens.llm.common import written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.drop_rejected(docs)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.packed(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash_near_dedup", simhash_stage),
    ("source_mixing", mixing_stage),
    ("window_packing", packing_stage),
]

#: SimHash and tokenisation have no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
