"""The corpus pipeline: five stages, each one of the corpus operators on what the stage before has kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame. All but
the last return the columns of ``documents``; ``run`` writes each result as
Parquet and reads it again as the next one's ``docs``. An empty table passes
through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from propensity.llm import bestfit_pack, line_rules, pii_boost, quality_classifier, simhash_gray
from propensity.llm.common import saved, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_classifier.accepted(docs, table(spark, sf_dir, "labels"))


def rule_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that the quality rules reject."""
    return line_rules.clean_lines(docs)


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest doc_id."""
    return simhash_gray.representatives(docs)


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to their kind in brackets."""
    return pii_boost.redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 1024."""
    return bestfit_pack.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_filter),
    ("quality_rules", rule_filter),
    ("simhash_near_dedup", near_duplicate_filter),
    ("personal_data", redaction),
    ("best_fit_packing", packing),
]

#: Learnt trees, shingle hashes and a tokenizer have no SQL form; tests/llm/test_pipeline.py checks every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
