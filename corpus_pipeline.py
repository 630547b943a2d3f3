"""Corpus cleaning: quality rules, near-duplicates, repeated passages, source mix, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows of docs; ``run`` writes each result as Parquet
in the shared folder and hands the table, read again, to the next. All but the last keep the columns of
``documents``. Null and repeated ids, null and empty texts, and extra columns are handled as the operators'
docstrings say; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import mixing, neardup, packing, quality, substrings
from tickloom.llm.tables import table
from tickloom.session import new_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality rules reject."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class of near-duplicates."""
    return neardup.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated passages out of the texts; documents that are nothing else go."""
    return substrings.without_repeats(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences, with their token ids."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("source mix", source_mix),
    ("packing", pack),
]
ORACLE_SQL = None  # trained trees, random signatures and tokens are beyond SQL; tests hold every stage to brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        folder = new_folder(spark, f"pipeline-{number}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
