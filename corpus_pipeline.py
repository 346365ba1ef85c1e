"""The corpus pipeline: five stages from raw documents to a mix to train on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, language, minhash, mixing, toxicity
from tidemark.llm.scratch import Scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1, learnt from the stage's own documents and their labels."""
    return toxicity.clean_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9; documents go whose language it cannot tell."""
    return language.accepted_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4 on five-word shingles at a similarity of 0.8; a row of the least id stays."""
    return minhash.kept_rows(docs, words=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2; documents go that hold a benchmark item."""
    return decontaminate.clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10; each document as often as the mix takes it, with ``copy_no``."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", keep_known_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

# Learnt models and MinHash are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next.

    Rows with null or empty texts have no toxic words but no letters either, so the
    language stage drops them; a null id, source or lang is kept.  Very long texts go
    through whole.  Rows that repeat are near duplicates, of which one stays.  An empty
    table gives no rows.  Further columns ride along, whatever their names; the last
    stage adds ``copy_no``, in place of a column of that name.
    """
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return docs
