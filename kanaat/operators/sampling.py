"""Labelled samples, splits and folds, all in a repeatable random order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kanaat.functions.fixed_values import CLASS_CAP, SEED
from kanaat.functions.keys import shuffle_key
from kanaat.operators import ranking
from kanaat.session import small_side

CLASS = ["category", "label"]


def _quota(target_positive: int, target_negative: int) -> Column:
    return F.when(F.col("label") == 1, target_positive).otherwise(target_negative)


def quota_sample(
    labelled: DataFrame,
    target_positive: int,
    target_negative: int,
    mode: str = "all",
    identity: str = "comment_id",
    seed: int = SEED,
) -> DataFrame:
    """Per category, the first rows of each label until its quota is full.

    ``all`` walks in random order, ``positive_only`` in id order, ``all_comments`` keeps everything."""
    if mode == "all_comments":
        return labelled
    if mode == "positive_only":
        return ranking.first_by_order(labelled, CLASS, identity, _quota(target_positive, target_negative))
    return ranking.first_by_hash(labelled, CLASS, identity, _quota(target_positive, target_negative), seed)


def examined_rows(
    labelled: DataFrame, target_positive: int, target_negative: int, identity: str = "comment_id", seed: int = SEED
) -> DataFrame:
    """How many rows the walk looks at before both quotas are full (all rows if that never happens)."""
    place = F.struct(shuffle_key(F.col(identity), seed).alias("k"), F.col(identity).alias("i"))
    kept = quota_sample(labelled, target_positive, target_negative, "all", identity, seed)
    stops = kept.groupBy("category").agg(
        F.max(place).alias("_stop"),
        F.count_if(F.col("label") == 1).alias("found_positive"),
        F.count_if(F.col("label") == 0).alias("found_negative"),
    )
    complete = (F.col("found_positive") >= target_positive) & (F.col("found_negative") >= target_negative)
    found = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("found_positive", "found_negative")]
    walked = labelled.join(small_side(stops), "category", "left").select("category", place.alias("_place"), "_stop", *found)
    return walked.groupBy("category").agg(
        F.first("found_positive").alias("found_positive"),
        F.first("found_negative").alias("found_negative"),
        F.count_if(F.coalesce(F.col("_place") <= F.col("_stop"), F.lit(False))).alias("_until_stop"),
        F.count(F.lit(1)).alias("_all"),
    ).select(
        "category",
        "found_positive",
        "found_negative",
        F.when(complete, F.col("_until_stop")).otherwise(F.col("_all")).alias("examined"),
        complete.cast("int").alias("complete"),
    )


def running_tally(labelled: DataFrame, identity: str = "comment_id", seed: int = SEED) -> DataFrame:
    """Positives and negatives found so far at every step of the walk."""
    placed = ranking.with_hash_order(labelled, identity, seed)
    return ranking.running(
        placed,
        ["category"],
        ["_key", identity],
        sums={
            "step": F.lit(1),
            "positives": (F.col("label") == 1).cast("int"),
            "negatives": (F.col("label") == 0).cast("int"),
        },
    ).drop("_key", "_bucket")


def capped_class_sample(
    labelled: DataFrame, cap: int = CLASS_CAP, identity: str = "comment_id", seed: int = SEED
) -> DataFrame:
    """``in_sample`` marks up to ``cap`` random rows per category and label; the others are to be scored."""
    return ranking.split_by_hash(labelled, CLASS, identity, F.lit(cap), "in_sample", seed)


def stratified_split(
    labelled: DataFrame, test_fraction: float, identity: str = "comment_id", seed: int = SEED
) -> DataFrame:
    """``is_test`` marks the rounded share of every class."""
    size = F.floor(F.col("_total") * test_fraction + 0.5)
    return ranking.split_by_hash(labelled, CLASS, identity, size, "is_test", seed)


def stratified_folds(
    labelled: DataFrame, folds: int, identity: str = "comment_id", seed: int = SEED
) -> DataFrame:
    """``fold`` numbers 0..folds-1; per class the fold sizes differ by one at most."""
    ranked = ranking.hash_rank(labelled, CLASS, identity, seed)
    return ranked.withColumn("fold", ((F.col("rank") - 1) % folds).cast("int")).drop("rank")


def shuffled_positions(df: DataFrame, identity: str = "comment_id", seed: int = SEED) -> DataFrame:
    return ranking.hash_rank(df, [], identity, seed).withColumnRenamed("rank", "position")


def remaining(rows: DataFrame, taken: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not among the taken ones; works on whole tables of either side."""
    return rows.join(taken.select(*keys), keys, "left_anti")
