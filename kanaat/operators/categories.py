"""The category dimension: fixed categories or custom ones, matched against comments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kanaat.functions.fixed_values import CATEGORIES
from kanaat.functions.text import clean_text

KEYWORD_MARK = "Anahtar Kelimeler:"
# The dimension is small by nature (16 categories as delivered); above this it is not one.
MOST_CATEGORIES = 1000

SCHEMA = T.StructType([T.StructField("category", T.StringType()), T.StructField("description", T.StringType())])


def keywords(description: Column) -> Column:
    """Trimmed keywords listed behind the mark; none if the description lists none."""
    listed = F.trim(F.regexp_replace(F.substring_index(description, KEYWORD_MARK, -1), r"\s+", " "))
    words = F.filter(F.transform(F.split(listed, ","), lambda w: F.trim(w)), lambda w: F.length(w) > 0)
    return F.when(F.contains(description, F.lit(KEYWORD_MARK)), words).otherwise(F.array().cast("array<string>"))


def dimension(spark: SparkSession, pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    pairs = CATEGORIES if pairs is None else pairs
    if len(pairs) > MOST_CATEGORIES:
        raise ValueError(f"{len(pairs)} categories")
    rows = spark.createDataFrame(pairs, SCHEMA)
    return rows.withColumn("keywords", keywords(F.col("description")))


def described(rows: DataFrame, pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """Add each row's category description; the bounded dimension is broadcast."""
    return rows.join(F.broadcast(dimension(rows.sparkSession, pairs)), "category")


def per_category(comments: DataFrame, pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """Every comment once per category, by exploding the bounded list of categories in each row."""
    pairs = CATEGORIES if pairs is None else pairs
    if len(pairs) > MOST_CATEGORIES:
        raise ValueError(f"{len(pairs)} categories")
    names = F.array(*[F.lit(name) for name, _ in pairs])
    return comments.withColumn("category", F.explode(names))


def keyword_hits(
    comments: DataFrame, text: str = "text", pairs: list[tuple[str, str]] | None = None
) -> DataFrame:
    """A stand-in labeller for tests: 1 where the cleaned comment contains a keyword of the category.

    The text is cleaned once per comment, before it is repeated per category."""
    pairs = CATEGORIES if pairs is None else pairs
    known = dimension(comments.sparkSession, pairs).select(
        "category", F.transform("keywords", clean_text).alias("keywords")
    ).collect()
    judged = [
        F.struct(
            F.lit(row.category).alias("category"),
            F.coalesce(*[F.when(F.contains("_clean", F.lit(w)), 1) for w in row.keywords], F.lit(0)).alias("label"),
        )
        for row in known
    ]
    cleaned = comments.withColumn("_clean", clean_text(F.col(text)))
    return cleaned.withColumn("_judged", F.explode(F.array(*judged))).select(
        *comments.columns, "_judged.category", "_judged.label"
    )
