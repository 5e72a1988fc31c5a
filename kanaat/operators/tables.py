"""Filters, duplicates, unions, indicator columns and counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kanaat.functions.fixed_values import MIN_WORDS
from kanaat.functions.text import has_words, not_blank


class MissingColumns(ValueError):
    pass


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns(f"missing {missing}, present {df.columns}")
    return df


def usable(frames: list[DataFrame], columns: list[str]) -> list[DataFrame]:
    """Leave out tables that lack a required column, keep the rest."""
    return [f for f in frames if all(c in f.columns for c in columns)]


def not_empty(frames: list[DataFrame]) -> list[DataFrame]:
    return [f for f in frames if not f.isEmpty()]


def long_enough(df: DataFrame, text: str = "text", at_least: int = MIN_WORDS) -> DataFrame:
    return df.where(has_words(F.col(text), at_least))


def with_text(df: DataFrame, text: str = "text") -> DataFrame:
    return df.where(not_blank(F.col(text)))


def with_default(df: DataFrame, column: str, default: str) -> DataFrame:
    """Fill in a column that is absent; nulls in a present one stay."""
    return df if column in df.columns else df.withColumn(column, F.lit(default))


def category_columns(df: DataFrame, others: list[str]) -> list[str]:
    return [c for c in df.columns if c not in others]


def any_category(columns: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0)) for c in columns]) > 0


def keep_first(df: DataFrame, keys: list[Column], identity: str) -> DataFrame:
    """Of rows with equal keys keep the one with the smallest id. Ids are combined before the shuffle,
    so a key that repeats in a third of all rows costs one row per task; keys move as digests, never as texts."""
    named = F.struct(*[k.alias(f"_k{i}") for i, k in enumerate(keys)])
    first = df.select(identity, F.sha2(F.to_json(named), 256).alias("_digest")).groupBy("_digest").agg(
        F.min(identity).alias(identity)
    )
    return df.join(first.select(identity), identity, "left_semi")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def as_comments(df: DataFrame, text: str, date: str | None, source: str) -> DataFrame:
    """One source in the common layout (date text, text, source)."""
    when = F.col(date).cast("string") if date else F.lit(None).cast("string")
    return df.select(when.alias("date_text"), F.col(text).alias("text"), F.lit(source).alias("source"))


def source_indicators(df: DataFrame, source: str, categories: list[str]) -> DataFrame:
    """One 0/1 column per category, 1 where the row came from that category's file."""
    return df.select("*", *[F.when(F.col(source) == c, 1).otherwise(0).alias(c) for c in categories])


def prediction_indicators(
    predictions: DataFrame, identity: str, categories: list[str], category: str = "category", value: str = "predicted"
) -> DataFrame:
    """One row per text and one 0/1 column per category from long predictions."""
    return predictions.groupBy(identity).agg(
        *[F.max(F.when(F.col(category) == c, F.col(value)).otherwise(0)).alias(c) for c in categories]
    )


def unpivot_labels(labels: DataFrame, identity: str, categories: list[str]) -> DataFrame:
    return labels.unpivot(
        [F.col(identity).alias("comment_id")], [F.col(c) for c in categories], "category", "label"
    )


def kept_and_removed(df: DataFrame, keep: Column) -> DataFrame:
    kept = F.count_if(keep)
    return df.agg(
        F.count(F.lit(1)).alias("total"), kept.alias("kept"), (F.count(F.lit(1)) - kept).alias("removed")
    )


def positive_share(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("category").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("label") == 1).alias("positives"),
        (F.count_if(F.col("label") == 1) * F.lit(100.0) / F.count(F.lit(1))).alias("share"),
    )


def label_tally(labelled: DataFrame, target_positive: int, target_negative: int) -> DataFrame:
    found = labelled.groupBy("category").agg(
        F.count_if(F.col("label") == 1).alias("positives"), F.count_if(F.col("label") == 0).alias("negatives")
    )
    done = (F.col("positives") >= target_positive) & (F.col("negatives") >= target_negative)
    return found.withColumn("complete", done.cast("int"))


def in_pieces(df: DataFrame, rows: int, rows_per_piece: int = 20_000) -> DataFrame:
    """Iterative fits run one job per step; a small table should not cost many tasks each time. Rows are put in
    order: learners that draw rows by their place then draw the same ones in every run."""
    return df.coalesce(max(1, -(-rows // rows_per_piece))).sortWithinPartitions("id")
