"""The corpus pipeline: quality classifier, near-duplicates, repeated passages, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a DataFrame that is written and read
again before the next one. All but the last return the columns of ``documents``. A stage first removes the tables that the one before
needed for its result, which is written by then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changewatch.llm import packing, quality, repeats, simhash
from changewatch.llm.common import stage_tables, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is in the range of trusted text of their language."""
    with stage_tables(spark, docs):
        return quality.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near-duplicates: by SimHash (operator 6) and by shared shingles."""
    with stage_tables(spark, docs):
        return simhash.one_of_each(docs)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 bytes or more that an earlier document has."""
    with stage_tables(spark, docs):
        return repeats.shortened(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens."""
    with stage_tables(spark, docs):
        return packing.pack(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeats", repeats_stage),
    ("packing", packing_stage),
]
#: SQL cannot express the language model; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
