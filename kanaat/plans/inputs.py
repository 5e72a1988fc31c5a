"""The given tables in the roles the queries use them in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kanaat.operators.tables import unpivot_labels
from kanaat.sources.tables import spread, table

LABEL_COLUMNS = ["quality", "toxic"]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Results as they are compared: every double to the same number of digits."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def comments(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(F.col("doc_id").alias("comment_id"), "source", "lang", "text")


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    return unpivot_labels(table(spark, folder, "labels"), "doc_id", LABEL_COLUMNS)


def labelled_comments(spark: SparkSession, folder: str) -> DataFrame:
    return labelled(spark, folder).join(spread(comments(spark, folder)), "comment_id")
