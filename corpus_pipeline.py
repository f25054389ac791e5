"""A training corpus from raw documents: the stages of the language-model pipeline, each a step of reelhouse.llm.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet, and the next one reads that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reelhouse.llm import exact_dedup, mixing, packing, quality, simhash
from reelhouse.session import written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; learned from the labels of the rows that are left."""
    return quality.good_ones(docs, quality.learn(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.without_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, shared five-word shingles of 80% included."""
    return simhash.one_of_similar(docs, limit=3, size=3)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document comes out as often as the mix takes it."""
    return mixing.mixed(docs, weights=(5, 2, 1), max_epochs=3)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return packing.packed(docs, "byte_bpe_50k.json", window=2048)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_copies),
    ("simhash_dedup", near_copies),
    ("source_mix", source_mix),
    ("packing", pack),
]

#: SQL can't tokenise or learn; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`, each to what the one before has written."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
