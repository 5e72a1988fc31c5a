"""TF-IDF over tokens: as tables, and as MLlib vectors. Both give the same weights.

weight = tf * (ln((1 + n) / (1 + df)) + 1), rows scaled to length 1, vocabulary = the most frequent
terms of the training texts (ties by term)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kanaat.functions import text as T
from kanaat.session import durable, fits

# Largest vocabulary of one category; bounds what is broadcast and what a driver holds.
MOST_TERMS = 100_000
# Up to this rank Spark cuts each task's rows before the window's shuffle by itself.
RANKED_IN_TASK = 1000
SHARES = 256


def with_words(df: DataFrame, text: str, stop_words: list[str], bigrams: bool) -> DataFrame:
    """Add ``words``: tokens of two or more word characters without stop words, then word pairs."""
    plain = df.withColumn("_tokens", T.tokens(F.col(text)))
    kept = plain.withColumn("_kept", T.without(F.col("_tokens"), stop_words))
    words = T.unigrams_and_bigrams(F.col("_kept")) if bigrams else F.col("_kept")
    return kept.withColumn("words", words).drop("_tokens", "_kept")


def each_word() -> Column:
    """Explode ``words``. Over a bare column Catalyst would add a size filter, push it below, and so
    tokenise every text twice; over an expression it does not."""
    return F.explode(F.transform("words", lambda w: w))


def term_counts(docs: DataFrame, groups: list[str]) -> DataFrame:
    """Corpus frequency and document frequency per term. The words of a text are sorted in the row, so
    the first of equal neighbours counts for the document; one shuffle of combined counts follows."""
    sorted_words = docs.select(*groups, F.sort_array("words").alias("w"))
    # Over an expression, as in `each_word`; functions of lambdas would run over every word uncompiled.
    placed = sorted_words.select(*groups, "w", F.posexplode(F.slice("w", F.lit(1), F.size("w"))).alias("place", "term"))
    first = F.when((F.col("place") > 0) & F.get("w", F.col("place") - 1).eqNullSafe(F.col("term")), 0).otherwise(1)
    return placed.select(*groups, "term", first.alias("first")).groupBy(*groups, "term").agg(
        F.count(F.lit(1)).alias("ctf"), F.sum("first").alias("df")
    )


def vocabulary(docs: DataFrame, groups: list[str], size: int) -> DataFrame:
    """The ``size`` most frequent terms per group with document frequency, index and idf. The best of
    each share of the terms are taken first, so a group's whole term list is never sorted at once."""
    if size > MOST_TERMS:
        raise ValueError(f"vocabulary of {size} terms")
    totals = docs.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"))
    counts = term_counts(docs, groups)
    if size > RANKED_IN_TASK:
        counts = _top(counts.withColumn("_share", F.pmod(F.xxhash64("term"), F.lit(SHARES))), [*groups, "_share"], size)
    top = _top(counts, groups, size)
    by_term = Window.partitionBy(*groups).orderBy("term")
    idf = F.log((F.lit(1.0) + F.col("n")) / (F.lit(1.0) + F.col("df"))) + 1.0
    return top.join(totals, groups).select(
        *groups, "term", "ctf", "df", "n", (F.row_number().over(by_term) - 1).alias("term_index"), idf.alias("idf")
    )


def _top(counts: DataFrame, groups: list[str], size: int) -> DataFrame:
    by_count = Window.partitionBy(*groups).orderBy(F.desc("ctf"), "term")
    return counts.withColumn("_r", F.row_number().over(by_count)).where(F.col("_r") <= size)


def fit_vocabulary(docs: DataFrame, groups: list[str], size: int) -> DataFrame:
    """The vocabulary as a stored table, so that scoring does not count the training texts again."""
    return durable(vocabulary(docs, groups, size))


def weights(docs: DataFrame, vocab: DataFrame, groups: list[str], identity: str = "comment_id") -> DataFrame:
    """(id, group, term, tf, weight). Words outside the vocabulary drop out before the one shuffle, which
    moves a list of small integers per text; counting and scaling then stay in place."""
    known = F.broadcast(vocab.select(*groups, "term", "term_index", "idf"))
    hits = docs.select(identity, *groups, each_word().alias("term")).join(known, [*groups, "term"])
    lists = hits.groupBy(identity, *groups).agg(F.collect_list("term_index").alias("_hits"))
    counts = lists.select(identity, *groups, F.explode("_hits").alias("term_index")).groupBy(
        identity, *groups, "term_index"
    ).agg(F.count(F.lit(1)).alias("tf"))
    raw = counts.join(known, [*groups, "term_index"]).withColumn("_w", F.col("tf") * F.col("idf"))
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(identity, *groups)))
    return raw.select(identity, *groups, "term", "term_index", "tf", (F.col("_w") / length).alias("weight"))


def vectorizer(spark: SparkSession, vocab: DataFrame) -> PipelineModel:
    """MLlib stages from ``words`` to the weighted sparse vector ``features``. No shuffle, saved with
    the model. The vocabulary of one category is bounded, so the driver may hold it."""
    rows = vocab.orderBy("term_index").select("term", "idf").collect()
    if not rows:
        raise ValueError("empty vocabulary")
    counts = CountVectorizerModel.from_vocabulary([r.term for r in rows], inputCol="words", outputCol="_counts")
    scaled = ElementwiseProduct(
        scalingVec=Vectors.dense([r.idf for r in rows]), inputCol="_counts", outputCol="_scaled"
    )
    return PipelineModel([counts, scaled, Normalizer(p=2.0, inputCol="_scaled", outputCol="features")])


def class_term_weights(weighted: DataFrame, classes: DataFrame, groups: list[str]) -> DataFrame:
    """Weight of every term in each class, the sums multinomial naive Bayes is made of."""
    return weighted.join(classes, ["comment_id", *groups]).groupBy(*groups, "label", "term").agg(
        F.sum("weight").alias("weight")
    )


def lexicon_polarity(comments: DataFrame, lexicon: DataFrame, most_words: int = 1_000_000) -> DataFrame:
    """Mean score of the lexicon words in each comment, 0 without any. The lexicon (word, score) is
    broadcast up to ``most_words`` rows and joined by shuffle beyond."""
    side = F.broadcast(lexicon) if fits(lexicon, most_words) else lexicon
    words = comments.select("comment_id", F.explode(T.tokens(F.col("text"))).alias("word"))
    scored = words.join(side, "word").groupBy("comment_id").agg(F.avg("score").alias("polarity"))
    return comments.join(scored, "comment_id", "left").withColumn("polarity", F.coalesce("polarity", F.lit(0.0)))
