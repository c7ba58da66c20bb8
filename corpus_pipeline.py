"""The corpus pipeline: quality, exact duplicates, near-duplicates, mixing, packing.

Each stage takes the documents that its predecessor kept, written as Parquet and read again. All stages but the last
return the columns of ``documents``; the last one returns the places of the documents' token pieces in sequences. NULLs,
empty and repeated rows are treated as the operators' modules say; an empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelwright.llm import block_naming, cotraining, minhash, mixing, packing
from panelwright.session import cut_lineage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts."""
    return cotraining.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return block_naming.drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more on five-word shingles."""
    return minhash.drop_near_duplicates(docs, words=5)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of at most 1024 tokens."""
    return packing.pack_documents(docs)


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mix", mix), ("pack", pack)]

# The classifier is trained and the near-duplicates are found iteratively: no SQL for the whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut_lineage(docs, f"pipeline-{name}")
    return docs
