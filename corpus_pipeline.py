"""Corpus preparation: each stage reads what its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)``. All but the last return rows of ``documents`` with all
their columns; the last returns the pieces of the remaining documents with their places.

Nulls and edges, in all stages: an empty table gives an empty one; other columns are kept, whatever
their names; texts are read whole. Repeated rows are judged each, except by the near-duplicate stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skytrace.llm import decontaminate, langid, packing, quality, simhash
from skytrace.session import written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go.

    A null text is judged by its page alone, as an empty one; null page fields are values of their own.
    Without labels of both classes all documents stay, or go if every label is bad.
    """
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, null texts too, or with a narrow margin between languages go.

    Ties between languages have no margin. Without any labelled language no document stays.
    """
    return langid.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: fingerprints of four-word shingles that
    differ in four bits or fewer.

    Null, empty and blank texts are one group. The smallest ``doc_id`` stays, of repeated rows one; rows
    without an id stay all.
    """
    return simhash.keep_one(docs, words=4, distance=4)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    A null text holds none, and a null or empty item is held by none.
    """
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is packed into sequences.

    A null text is an empty one and has its closing id only. Ties between pieces of equal length are
    settled by id, piece and content.
    """
    return packing.packed(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: Trained models, similarity search and packing: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
