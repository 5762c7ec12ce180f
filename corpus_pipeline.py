"""Cleaning a corpus in stages, each of which applies one operator of storyloom.llm to all that the stage before kept.

Toxic documents go, of equal texts one row stays, of near copies one document stays, sources are brought to
their target weights (rows repeat or go), and what is left becomes token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from storyloom.llm import byte_bpe, exact_dedup, minhash, mixing, scratch, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the classifier learns from the labels of those given."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, the row with the smallest doc_id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shingles of five words link at a similarity of 0.8."""
    return minhash.drop_near_copies(docs, width=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix of sources takes it."""
    return mixing.repeat_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and token_bytes of each row."""
    return byte_bpe.encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("byte_bpe", encode),
]

#: The classifier's training has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch.materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
