"""Soft voting."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kanaat.functions.labels import winning_class


def vote(scores: DataFrame, columns: list[str]) -> DataFrame:
    """Mean probability of class 1 over the models' columns, and the class it wins (a tie is class 0)."""
    mean = reduce(lambda a, b: a + b, [F.col(c) for c in columns]) / F.lit(float(len(columns)))
    return scores.withColumn("p1", mean).withColumn("predicted", winning_class(1 - F.col("p1"), F.col("p1")))
