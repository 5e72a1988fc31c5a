"""Writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_report(df: DataFrame, path: str) -> None:
    """A report table; small enough after aggregation to be one file only if Spark finds it so."""
    df.write.mode("overwrite").parquet(path)


def write_labels(df: DataFrame, path: str, append: bool = True) -> None:
    """Label table partitioned by category, so that training one category reads only its rows."""
    df.write.mode("append" if append else "overwrite").partitionBy("category").parquet(path)
