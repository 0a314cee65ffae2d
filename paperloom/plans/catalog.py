"""The query catalogue: every entry reads the given tables and may have an equivalent SQL text."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from paperloom.session import ship_package

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}
MODULES = (
    "paper_queries", "access_queries", "intake_queries", "extract_queries", "store_queries", "search_queries", "stream_queries",
)


def query(name: str, sql: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = _with_package(fn)
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def _with_package(fn: QueryFn) -> QueryFn:
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return fn(spark, sf_dir)

    return run


def load() -> None:
    for module in MODULES:
        import_module(f"paperloom.plans.{module}")
