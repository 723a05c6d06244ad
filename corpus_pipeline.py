"""Corpus pipeline over ``documents``: quality, exact dedup, near dedup, substring dedup, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from metalake.llm import exact_dedup, jaccard_join, packing, quality, span_dedup
from metalake.llm.common import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised scorer accepts."""
    return quality.classify(docs).where("keep").select(*docs.columns)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest doc_id."""
    return exact_dedup.drop_exact_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the one with the smallest doc_id."""
    return jaccard_join.drop_near_copies(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the sentences that repeat elsewhere first."""
    return span_dedup.span_dedup(docs).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of at most 1024 tokens."""
    return packing.pack(docs, packing.tokenizer_path(), 1024, 2)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("substring dedup", substring_stage),
    ("best-fit packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each one's result is written and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES):
            docs = materialize(docs, f"stage{at}")
    return docs


#: SQL cannot express the classifier, the near copies and the packing; tests check each stage.
ORACLE_SQL = None
