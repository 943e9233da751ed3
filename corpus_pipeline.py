"""The training-data pipeline: each stage applies one operator of `bantin.llm` to what the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bantin.llm.common import importable, shared_folder, table
from bantin.llm.decontamination import decontaminate
from bantin.llm.jaccard_join import drop_near_duplicates
from bantin.llm.line_dedup import dedup_lines
from bantin.llm.packing import pack
from bantin.llm.toxicity import drop_toxic


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models, learned from all labels, do not call toxic."""
    importable(spark)
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stay in another one."""
    importable(spark)
    return dedup_lines(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is linked by 5-word shingles with a similarity of 0.8."""
    importable(spark)
    return drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    importable(spark)
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 4096 ids."""
    importable(spark)
    return pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_shared_lines),
    ("n-gram Jaccard join", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("best-fit packing", packed),
]

# Learned models are not SQL; a test compares every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's rows are written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        folder = shared_folder(spark)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
