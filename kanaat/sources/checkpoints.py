"""Labelling checkpoints kept as JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = (
    "category string, target_positive int, target_negative int, count_positive int, count_negative int, "
    "results array<struct<`Tarih`: string, `Yorum`: string, `Sonuç`: int>>, processed_indices array<bigint>, "
    "timestamp string"
)


def read_checkpoints(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).option("multiLine", True).json(path)


def parse_checkpoint(text: Column) -> Column:
    return F.from_json(text, SCHEMA)


def resumable(checkpoints: DataFrame, category: str, target_positive: int, target_negative: int) -> DataFrame:
    """A checkpoint counts only for the same category and the same targets."""
    return checkpoints.where(
        (F.col("category") == category)
        & (F.col("target_positive") == target_positive)
        & (F.col("target_negative") == target_negative)
    )


def results(checkpoints: DataFrame) -> DataFrame:
    return checkpoints.select("category", F.explode("results").alias("r")).select("category", "r.*")


def processed(checkpoints: DataFrame) -> DataFrame:
    return checkpoints.select("category", F.explode("processed_indices").alias("comment_id"))
