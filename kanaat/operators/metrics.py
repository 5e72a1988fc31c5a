"""Classification metrics and the reports made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kanaat.functions.fixed_values import MAX_ACCURACY_GAP, TEST, TRAIN


def weighted_metrics(scored: DataFrame, groups: list[str], truth: str = "label", guess: str = "predicted") -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1; an undefined precision counts as 0."""
    y, p = F.col(truth), F.col(guess)
    counts = scored.groupBy(*groups).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    )
    c = {n: F.col(n).cast("double") for n in ("tp", "fp", "fn", "tn")}
    n = c["tp"] + c["fp"] + c["fn"] + c["tn"]
    share1, share0 = (c["tp"] + c["fn"]) / n, (c["tn"] + c["fp"]) / n

    def safe(a, b):
        return F.when(b > 0, a / b).otherwise(F.lit(0.0))

    accuracy = (c["tp"] + c["tn"]) / n
    precision = share1 * safe(c["tp"], c["tp"] + c["fp"]) + share0 * safe(c["tn"], c["tn"] + c["fn"])
    f1 = share1 * safe(2 * c["tp"], 2 * c["tp"] + c["fp"] + c["fn"]) + share0 * safe(
        2 * c["tn"], 2 * c["tn"] + c["fp"] + c["fn"]
    )
    return counts.select(
        *groups,
        accuracy.alias("accuracy"),
        precision.alias("precision"),
        accuracy.alias("recall"),
        f1.alias("f1"),
    )


def metric_pivot(metrics: DataFrame) -> DataFrame:
    """One row per category, train and test metrics side by side."""
    names = ["accuracy", "precision", "recall", "f1"]
    wide = metrics.groupBy("category").pivot("split", [TRAIN, TEST]).agg(*[F.first(n).alias(n) for n in names])
    return wide.select(
        "category",
        *[F.col(f"`{s}_{n}`").alias(f"{e}_{n}") for s, e in ((TRAIN, "train"), (TEST, "test")) for n in names],
    )


def model_summary(train: DataFrame, test: DataFrame, keys: list[str], max_gap: float = MAX_ACCURACY_GAP) -> DataFrame:
    """Train and test metrics of each model paired by key, with the overfit flag."""
    a = train.select(*keys, F.col("accuracy").alias("train_accuracy"), F.col("f1").alias("train_f1"))
    b = test.select(*keys, F.col("accuracy").alias("test_accuracy"), F.col("f1").alias("test_f1"))
    gap = F.col("train_accuracy") - F.col("test_accuracy")
    return a.join(b, keys).withColumns({"gap": gap, "overfit": (gap > max_gap).cast("int")})


def overall_report(summary: DataFrame, max_gap: float = MAX_ACCURACY_GAP) -> DataFrame:
    means = summary.agg(
        F.avg("train_accuracy").alias("mean_train"),
        F.avg("test_accuracy").alias("mean_test"),
        (F.avg("train_accuracy") - F.avg("test_accuracy")).alias("mean_gap"),
    )
    return means.withColumn("overfit", (F.col("mean_gap") > max_gap).cast("int"))
