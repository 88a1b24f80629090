"""The corpus pipeline: quality rules, near-duplicates, benchmark leaks, tokens.

``STAGES`` lists (name, function); every function takes (spark, docs, sf_dir)
and returns a DataFrame, written as Parquet and read again as the next one's
``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from servicelens.llm.bpe import digests
from servicelens.llm.decontaminate import drop_leaks
from servicelens.llm.near_dedup import drop_near_duplicates
from servicelens.llm.quality import drop_rejected
from servicelens.plans.physical import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, columns unchanged."""
    return drop_rejected(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with similar five-word shingles."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents' ids and decoded texts."""
    import public_tokenizers

    return digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("bpe", bpe),
]

# Byte-pair encoding has no SQL form: the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
