"""A training corpus from raw documents: toxic and poor texts go, copies go, the rest is packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakestrata.llm.common import table
from lakestrata.llm.exact_dedup import duplicate_groups
from lakestrata.llm.near_dup import near_duplicates
from lakestrata.llm.packing import pack_documents
from lakestrata.llm.quality_cnn import score_quality
from lakestrata.llm.toxicity import score_toxicity
from lakestrata.session import work_folder


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not predicted to be toxic."""
    scored = score_toxicity(docs, table(spark, sf_dir, "labels"), carry=True)
    return scored.where("predicted = 0").select("row.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are predicted to be good."""
    scored = score_quality(docs, table(spark, sf_dir, "labels"), carry=True)
    return scored.where("predicted = 1").select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id."""
    return duplicate_groups(docs, carry=True).where("kept").select("row.*")


def near_dup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest id."""
    return near_duplicates(docs, carry=True).where("kept").select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, each with its sequence and place."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dup", near_dup),
    ("packing", packing),
]

#: SQL can express neither the learned scores nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = work_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
