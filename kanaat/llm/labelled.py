"""A bounded sample of labelled rows for fitting a classifier on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kanaat.llm.batches import with_text_columns
from kanaat.llm.statistics import FEATURES, features, text_statistics

# Labelled rows a classifier is fitted on: those with the smallest hash of their id.
SAMPLE_ROWS = 20_000


def sampled_labels(labels: DataFrame, label_col: str, rows: int = SAMPLE_ROWS, where: Column | None = None) -> DataFrame:
    """``doc_id`` and ``label`` (0 or 1) of at most ``rows`` ids; an id with several labels has the larger one."""
    known = labels.select("doc_id", F.col(label_col).cast("int").alias("label")).where(
        F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
    if where is not None:
        known = known.where(where)
    return known.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def sampled_features(docs: DataFrame, labels: DataFrame, label_col: str, rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows and labels of the sample, in the order of ids; at most ``rows`` of the texts' rows are kept where
    ids repeat. The sample is small enough to be sent to every task."""
    chosen = sampled_labels(labels, label_col, rows).withColumnRenamed("doc_id", "_id")
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "text", "label")

    def make(part):
        return {"_x": list(features(text_statistics(part)))}

    found = with_text_columns(texts, "text", make, "_x array<double>", ["doc_id", "label"])
    got = found.orderBy("doc_id", "_x").limit(rows).collect()
    x = np.array([r["_x"] for r in got], np.float64).reshape(len(got), len(FEATURES))
    return x, np.array([r["label"] for r in got], np.int64)
