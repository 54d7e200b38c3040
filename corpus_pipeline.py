"""Corpus pipeline: quality rules, near-duplicate removal, masking of personal data, source
mix, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.chosen_path import deduplicate
from tessera.llm.common import written
from tessera.llm.mixing import mixed_documents
from tessera.llm.pii import mask_documents
from tessera.llm.quality import good_documents
from tessera.llm.sentencepiece import encode


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the likelihood ratio reject go."""
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one of the smallest id."""
    return deduplicate(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return mask_documents(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents appear as often as their source's budget takes them, up to three times."""
    return mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document of the mix."""
    return encode(docs, keep=("doc_id", "source"))


STAGES = [
    ("quality", quality_stage),
    ("ngram_jaccard_join", dedup_stage),
    ("pii", pii_stage),
    ("mix", mix_stage),
    ("sentencepiece", token_stage),
]

# Min-hash recursion and the Viterbi search have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
