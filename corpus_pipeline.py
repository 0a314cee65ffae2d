"""Corpus pipeline: quality, toxicity, near-duplicates, benchmark passages, packing.

Each stage works on all that its predecessor kept and sees nothing else of the corpus, so a stage judges and learns from its own
input. All stages but the last return the documents they keep with the columns they came with.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from paperloom.llm.common import table
from paperloom.llm.decontaminate import without_benchmark
from paperloom.llm.minhash import without_near_duplicates
from paperloom.llm.packing import pack
from paperloom.llm.quality import good_documents
from paperloom.llm.toxicity import clean_documents
from paperloom.session import scratch_path, ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects go."""
    ship_package(spark)
    return good_documents(docs, table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the convolutional classifier rejects go."""
    ship_package(spark)
    return clean_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    ship_package(spark)
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more is benchmark text go."""
    ship_package(spark)
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of token sequences."""
    ship_package(spark)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("packing", packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written below the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
