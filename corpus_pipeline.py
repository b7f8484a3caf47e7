"""The corpus pipeline: quality rules, near-duplicates, repeated passages, mix, token ids.

Every stage works on all that the one before it kept and takes its decisions
from its own input; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm import bpe, mixing, quality, simhash, suffix
from tablewright.llm.common import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or lie far from their language and source go."""
    return quality.kept_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, that of the smallest id."""
    return simhash.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of passages that occur twice or more are cut out of the texts."""
    return suffix.deduplicated(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights: documents repeated, taken in part or left out."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per row of the mix: number of tokens, digests of ids and decoded text."""
    return bpe.digests(bpe.encode(docs))


STAGES = [("quality_rules", quality_rules), ("simhash_near_dedup", near_copies), ("suffix_array_dedup", repeated_passages),
          ("mixing", source_mix), ("bpe", token_ids)]

#: SQL can't express the robust estimates, the fingerprints or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
