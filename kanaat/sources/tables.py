"""Reading the Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


# A table read in fewer pieces than this is small: moving it once costs little.
FEW_PIECES = 16


def spread(df: DataFrame) -> DataFrame:
    """Use more cores for costly per-row work on a small table that is read in a few pieces (one row
    group, for example). Tables read in many pieces stay as they are."""
    wanted = min(df.sparkSession.sparkContext.defaultParallelism, FEW_PIECES)
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df
