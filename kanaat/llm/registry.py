"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
MODULES = ["sharding", "secrets", "byte_pair", "quality_rules", "neighbour_forest", "packing", "token_files", "toxicity", "ngram_join", "site_quality", "phrase_fingerprint", "collocations", "token_alignment"]


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table as it is, found through Spark's reader alone."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        import_module(f"kanaat.llm.{name}")
