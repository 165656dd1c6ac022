"""The corpus pipeline: each stage works on all documents its predecessor kept.

Toxic documents go, one document of each group of near copies
(5-word shingles, similarity 0.8 or more) stays, documents that hold a benchmark
item go, personal data is redacted, and what is left is tokenized and packed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stagefare.llm import op1_pii, op2_toxicity, op3_decontaminate, op6_packing, op9_jaccard
from stagefare.llm.tables import materialize, read


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op2_toxicity.remove(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op9_jaccard.keep_one(docs, op9_jaccard.Rule(words=5, percent=80))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op3_decontaminate.remove(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op1_pii.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op6_packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal-data", personal_data),
    ("packing", packing),
]

# Learned stages cannot be written in SQL; tests/llm holds their brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's rows are written and read again."""
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, name)
    return docs
