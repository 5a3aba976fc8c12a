"""The corpus pipeline: five stages over ``documents``, each calling one operator of the llm subpackage.

toxicity -> near duplicates -> benchmark decontamination -> personal data -> mixing. A stage works on all
that the one before it kept; its result is written as Parquet and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlens.llm import decontaminate, mixing, pii, simhash, toxicity
from orderlens.llm.common import read, stage


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator (3) rejects go."""
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates (7) stays: the smallest doc_id."""
    return simhash.near_dedup(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item (2) go."""
    return decontaminate.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data (6) in the texts is replaced by its kind; every document stays."""
    return pii.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights (9): a row for each copy of a document, numbered in ``copy``."""
    return mixing.emit(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("near_dedup", without_near_copies),
    ("decontamination", without_leaks),
    ("pii", without_personal_data),
    ("mixing", mixed),
]

#: SQL can't express the trained scores; tests hold each stage against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage_of) in enumerate(STAGES):
        docs = stage_of(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs
