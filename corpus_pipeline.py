"""Corpus pipeline: toxic documents go, one document of each near-duplicate
group stays, personal data gets surrogates, the rest is packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventide.llm import packing, pii, simhash, toxicity
from eventide.llm.common import materialize, read_table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents predicted toxic; null and empty texts stay."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.reject(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash component (4-word shingles, 4 bits)."""
    return simhash.keep_one(docs, k=4, max_bits=4)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data and secrets by surrogates."""
    return pii.replace(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences: one row per piece of a document."""
    return packing.best_fit(docs)


STAGES = [("toxicity", toxicity_stage), ("simhash_near_dedup", near_duplicate_stage), ("pii", pii_stage),
          ("best_fit_packing", packing_stage)]
ORACLE_SQL = None       # fitted scores and XXH64 fingerprints are not expressible in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return stage_last(spark, docs, sf_dir)


def stage_last(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    name, stage = STAGES[-1]
    return materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
