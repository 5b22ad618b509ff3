"""A corpus pipeline of five stages: quality, exact dedup, near dedup, secrets, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestone.llm import exact_dedup, near_dup, packing, quality, secret_scan
from lodestone.llm.shared import read_table, staged


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.accepted(docs, read_table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return exact_dedup.exact_dedup(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the least id."""
    return near_dup.near_dedup(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; the values of secrets are masked, but for widely copied examples."""
    return secret_scan.redacted(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed sequences: one row a piece, with its token ids."""
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("secret_scan", secret_stage),
    ("packing", packing_stage),
]

#: SQL expresses neither the classifier nor the signatures and tokens; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage returns is written and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
