"""A corpus pipeline: quality, near-duplicates, secrets, mixture and packing, each over all that the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brickwork.llm import common, minhash, mixing, packing, quality, secrets


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    return quality.keep(docs, common.table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates (five words, similarity 0.8)."""
    return minhash.keep(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secret spans in the texts."""
    return secrets.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents, so that the sources' words come to their targets."""
    return mixing.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens into sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", quality_stage),
    ("minhash_near_dedup", dedup_stage),
    ("secret_scans", secrets_stage),
    ("source_mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]
#: SQL can't express the stages; tests/llm hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
