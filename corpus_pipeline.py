"""The corpus pipeline: stages over documents, each written and read again.

Quality rules drop what they reject; of each class of near copies one document stays;
documents with a telling share of benchmark passages go; personal data is masked in
those left, and they are encoded. Every stage sees all rows its predecessor kept, whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loginwatch.llm import bpe, decontamination, pii, quality_rules, simhash
from loginwatch.llm.common import table
from loginwatch.llm.registry import BPE_FILE
from loginwatch.plans.session import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the certified rules keep."""
    return quality_rules.good_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return simhash.first_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a telling share of benchmark passages."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and what gives it away masked."""
    return pii.sanitised(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents that are left."""
    return bpe.token_digests(docs, BPE_FILE)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("pii", sanitise),
    ("bpe", tokenize),
]

#: The fingerprints, the merges and the thresholds are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
