"""A training corpus from raw documents, stage by stage.

Each stage takes all documents the one before has kept, as Parquet, and its
decisions take effect; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shaftline.llm.block_naming import drop_exact_duplicates
from shaftline.llm.common import stored
from shaftline.llm.minmax import drop_near_duplicates
from shaftline.llm.packing import pack_documents
from shaftline.llm.repetition import drop_repetitive
from shaftline.llm.secrets import mask_secrets

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules on length and repetition keep; others go."""
    return drop_repetitive(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose texts differ in white space at most."""
    return drop_exact_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near_duplicates(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked."""
    return mask_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in sequences of 4096 tokens.

    The workers still hold what earlier stages left, so they remember less here.
    """
    return pack_documents(docs, remembered=150_000)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# Suffix arrays, min-max hashing and tokens are not expressible in SQL; the tests
# hold the stages against plain Python.
ORACLE_SQL: str | None = None
