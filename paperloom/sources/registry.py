"""Bibliographic registry dumps (JSON lines of work records) and model-answer tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paperloom.schemas import MODEL_OUTPUT, REGISTRY_WORK


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REGISTRY_WORK).json(path)


def read_model_output(spark: SparkSession, path: str) -> DataFrame:
    """Answers keyed by idempotency key. A value of another type than declared (authors as text) reads as null."""
    return spark.read.schema(MODEL_OUTPUT).json(path)
