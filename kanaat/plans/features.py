"""Term statistics, TF-IDF, lexicon polarity, neighbours and class balance."""

from __future__ import annotations

from pyspark.sql import functions as F

from kanaat.functions import labels
from kanaat.functions.fixed_values import STOP_WORDS_LONG, STOP_WORDS_SHORT
from kanaat.operators import balance, features, neighbours
from kanaat.plans.inputs import LABEL_COLUMNS, comments, labelled, labelled_comments, rounded
from kanaat.plans.registry import LABELS, query, sql_clean
from kanaat.sources.tables import spread, table

# Stop words in the languages of the given texts, beside the fixed Turkish ones.
STOP = [*STOP_WORDS_SHORT, "the", "and", "of", "und", "der", "la", "les", "que"]


def _listed(words):
    return "[" + ", ".join("'" + w + "'" for w in words) + "]"


def _sql_tokens(text: str, stop_words) -> str:
    found = rf"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}_]{{2,}}')"
    return f"list_filter({found}, lambda w: NOT list_contains({_listed(stop_words)}, w))" if stop_words else found


TOKENS = f"tokens AS (SELECT doc_id AS comment_id, lang, {_sql_tokens('text', STOP)} AS t FROM documents)"
PAIRS = """words AS (SELECT comment_id, lang, list_concat(t, [t[i] || ' ' || t[i + 1] FOR i IN range(1, len(t))]) AS words
FROM tokens)"""


@query(
    "kept_tokens",
    f"WITH {TOKENS} SELECT comment_id, array_to_string(t, ' ') AS tokens, len(t)::INTEGER AS n FROM tokens",
)
def kept_tokens(spark, folder):
    worded = features.with_words(spread(comments(spark, folder)), "text", STOP, bigrams=False)
    return worded.select("comment_id", F.array_join("words", " ").alias("tokens"), F.size("words").alias("n"))


@query(
    "words_and_pairs",
    f"""WITH {TOKENS}, {PAIRS} SELECT comment_id, len(words)::INTEGER AS n, md5(array_to_string(words, ',')) AS digest
FROM words""",
)
def words_and_pairs(spark, folder):
    worded = features.with_words(spread(comments(spark, folder)), "text", STOP, bigrams=True)
    return worded.select(
        "comment_id", F.size("words").alias("n"), F.md5(F.array_join("words", ",")).alias("digest")
    )


@query(
    "term_frequency",
    f"""WITH {TOKENS}, terms AS (SELECT comment_id, unnest(t) AS term FROM tokens)
SELECT term, count(*)::BIGINT AS ctf, count(DISTINCT comment_id)::BIGINT AS df FROM terms GROUP BY term""",
)
def term_frequency(spark, folder):
    worded = features.with_words(spread(comments(spark, folder)), "text", STOP, bigrams=False)
    return features.term_counts(worded, [])


@query(
    "vocabulary_by_language",
    f"""WITH {TOKENS}, {PAIRS}, terms AS (SELECT comment_id, lang, unnest(words) AS term FROM words),
counts AS (SELECT lang, term, count(*)::BIGINT AS ctf, count(DISTINCT comment_id)::BIGINT AS df FROM terms GROUP BY ALL),
top AS (SELECT * FROM counts QUALIFY row_number() OVER (PARTITION BY lang ORDER BY ctf DESC, term) <= 300)
SELECT lang, term, ctf, df, (row_number() OVER (PARTITION BY lang ORDER BY term) - 1)::INTEGER AS term_index,
  round(ln((1.0 + n) / (1.0 + df)) + 1, 6) AS idf
FROM top JOIN (SELECT lang, count(*) AS n FROM documents GROUP BY lang) USING (lang)""",
)
def vocabulary_by_language(spark, folder):
    worded = features.with_words(spread(comments(spark, folder)), "text", STOP, bigrams=True)
    return features.vocabulary(worded, ["lang"], 300).select(
        "lang", "term", "ctf", "df", "term_index", F.round("idf", 6).alias("idf")
    )


TFIDF = f"""terms AS (SELECT comment_id, category, unnest(words) AS term FROM words),
counts AS (SELECT category, term, count(*) AS ctf, count(DISTINCT comment_id) AS df FROM terms GROUP BY ALL),
top AS (SELECT * FROM counts QUALIFY row_number() OVER (PARTITION BY category ORDER BY ctf DESC, term) <= 300),
idfs AS (SELECT category, term, ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1 AS idf
  FROM top JOIN (SELECT category, count(*) AS n FROM words GROUP BY category) USING (category)),
tfs AS (SELECT comment_id, category, term, count(*) AS tf, any_value(idf) AS idf
  FROM terms JOIN idfs USING (category, term) GROUP BY ALL),
weighted AS (SELECT comment_id, category, term, tf,
  tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY comment_id, category)) AS weight FROM tfs)"""


@query(
    "tfidf_weights",
    f"""WITH {TOKENS}, {PAIRS.replace('comment_id, lang', 'comment_id, lang AS category')},
{TFIDF} SELECT comment_id, category, term, tf::BIGINT AS tf, round(weight, 6) AS weight FROM weighted""",
)
def tfidf_weights(spark, folder):
    rows = spread(comments(spark, folder)).withColumnRenamed("lang", "category")
    worded = features.with_words(rows, "text", STOP, bigrams=True)
    vocab = features.fit_vocabulary(worded, ["category"], 300)
    return features.weights(worded, vocab, ["category"]).select(
        "comment_id", "category", "term", "tf", F.round("weight", 6).alias("weight")
    )


LABELLED_WORDS = f"""{LABELS}, tokens AS (SELECT comment_id, category, label, {_sql_tokens(sql_clean('text'), STOP_WORDS_LONG)} AS t
  FROM labelled JOIN documents ON doc_id = comment_id),
words AS (SELECT comment_id, category, label, list_concat(t, [t[i] || ' ' || t[i + 1] FOR i IN range(1, len(t))]) AS words
  FROM tokens)"""


def _labelled_words(spark, folder):
    from kanaat.functions.text import clean_text

    cleaned = labelled_comments(spark, folder).withColumn("text", clean_text(F.col("text")))
    return features.with_words(cleaned, "text", STOP_WORDS_LONG, bigrams=True)


@query(
    "tfidf_by_category",
    f"""WITH {LABELLED_WORDS}, {TFIDF}
SELECT category, comment_id, count(*)::BIGINT AS terms, round(sum(weight), 5) AS total, round(max(weight), 6) AS highest,
  round(sum(weight * weight), 6) AS norm FROM weighted GROUP BY ALL""",
)
def tfidf_by_category(spark, folder):
    worded = _labelled_words(spark, folder)
    weighted = features.weights(worded, features.fit_vocabulary(worded, ["category"], 300), ["category"])
    return weighted.groupBy("category", "comment_id").agg(
        F.count(F.lit(1)).alias("terms"),
        F.round(F.sum("weight"), 5).alias("total"),
        F.round(F.max("weight"), 6).alias("highest"),
        F.round(F.sum(F.col("weight") * F.col("weight")), 6).alias("norm"),
    )


@query(
    "multinomial_term_weights",
    f"""WITH {LABELLED_WORDS}, {TFIDF}, sums AS (SELECT w.category, w.label, x.term, sum(x.weight) AS weight
  FROM weighted x JOIN words w USING (comment_id, category) GROUP BY ALL)
SELECT category, label, term, round(weight, 5) AS weight,
  round(ln((weight + 2.0) / (sum(weight) OVER (PARTITION BY category, label) + 2.0 * 300)), 5) AS log_probability
FROM sums""",
)
def multinomial_term_weights(spark, folder):
    from pyspark.sql import Window

    worded = _labelled_words(spark, folder)
    weighted = features.weights(worded, features.fit_vocabulary(worded, ["category"], 300), ["category"])
    classes = worded.select("comment_id", "category", "label")
    sums = features.class_term_weights(weighted, classes, ["category"])
    total = F.sum("weight").over(Window.partitionBy("category", "label"))
    return sums.select(
        "category",
        "label",
        "term",
        F.round("weight", 5).alias("weight"),
        F.round(F.log((F.col("weight") + 2.0) / (total + 2.0 * 300)), 5).alias("log_probability"),
    )


# Scores in eighths: their mean is one exact division, the same in every engine without rounding.
LEXICON = [("the", 0.25), ("and", 0.5), ("of", -0.5), ("la", -0.25), ("que", 0.75), ("der", -1.0), ("und", 1.0),
           ("los", -0.75), ("en", 0.125)]


@query(
    "lexicon_sentiment",
    rf"""WITH lexicon(word, score) AS (VALUES {', '.join(f"('{w}', {s}::DOUBLE)" for w, s in LEXICON)}),
words AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}')) AS word FROM documents),
scored AS (SELECT doc_id, avg(score) AS p FROM words JOIN lexicon USING (word) GROUP BY doc_id)
SELECT doc_id AS comment_id, coalesce(p, 0) AS polarity,
  CASE WHEN coalesce(p, 0) > 0 THEN 'Pozitif' WHEN coalesce(p, 0) < 0 THEN 'Negatif' ELSE 'Nötr' END AS sentiment
FROM documents LEFT JOIN scored USING (doc_id)""",
)
def lexicon_sentiment(spark, folder):
    lexicon = spark.createDataFrame(LEXICON, "word string, score double")
    rows = spread(comments(spark, folder)).select("comment_id", "text")
    return features.lexicon_polarity(rows, lexicon).select(
        "comment_id",
        "polarity",
        labels.sentiment_of_polarity(F.col("polarity")).alias("sentiment"),
    )


@query(
    "sentiment_distribution",
    rf"""WITH lexicon(word, score) AS (VALUES {', '.join(f"('{w}', {s}::DOUBLE)" for w, s in LEXICON)}),
words AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}')) AS word FROM documents),
scored AS (SELECT doc_id, avg(score) AS p FROM words JOIN lexicon USING (word) GROUP BY doc_id),
hits AS (SELECT doc_id, coalesce(p, 0) AS p FROM documents LEFT JOIN scored USING (doc_id)
  WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality + toxic > 0))
SELECT count(*)::BIGINT AS total, count(*) FILTER (p > 0)::BIGINT AS positive, count(*) FILTER (p < 0)::BIGINT AS negative,
  count(*) FILTER (p = 0)::BIGINT AS neutral, round(count(*) FILTER (p > 0) * 100.0 / nullif(count(*), 0), 6) AS positive_share,
  round(count(*) FILTER (p < 0) * 100.0 / nullif(count(*), 0), 6) AS negative_share,
  round(count(*) FILTER (p = 0) * 100.0 / nullif(count(*), 0), 6) AS neutral_share FROM hits""",
)
def sentiment_distribution(spark, folder):
    from kanaat.operators.sentiment import distribution
    from kanaat.operators.tables import any_category

    lexicon = spark.createDataFrame(LEXICON, "word string, score double")
    hits = table(spark, folder, "labels").where(any_category(["quality", "toxic"]))
    rows = spread(comments(spark, folder)).select("comment_id", "text").join(
        hits.select(F.col("doc_id").alias("comment_id")), "comment_id", "left_semi"
    )
    scored = features.lexicon_polarity(rows, lexicon)
    return rounded(distribution(scored.select(labels.sentiment_of_polarity(F.col("polarity")).alias("sentiment"))))


@query(
    "prediction_report",
    rf"""WITH lexicon(word, score) AS (VALUES {', '.join(f"('{w}', {s}::DOUBLE)" for w, s in LEXICON)}),
words AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}')) AS word FROM documents),
scored AS (SELECT doc_id, avg(score) AS p FROM words JOIN lexicon USING (word) GROUP BY doc_id)
SELECT d.doc_id AS "Yorum_ID", d.lang AS "Tarih", d.text AS "Yorum", CASE WHEN coalesce(p, 0) > 0 THEN 'Pozitif'
  WHEN coalesce(p, 0) < 0 THEN 'Negatif' ELSE 'Nötr' END AS "Duygu", coalesce(p, 0) AS "Duygu_Polaritesi",
  l.quality, l.toxic FROM labels l JOIN documents d USING (doc_id) LEFT JOIN scored USING (doc_id)
WHERE l.quality = 1 OR l.toxic = 1""",
)
def prediction_report(spark, folder):
    """Long predictions made wide, attached to their comments by id, with sentiment, positives only."""
    from kanaat.operators.tables import any_category, prediction_indicators

    lexicon = spark.createDataFrame(LEXICON, "word string, score double")
    wide = prediction_indicators(labelled(spark, folder), "comment_id", LABEL_COLUMNS, value="label")
    hits = wide.where(any_category(LABEL_COLUMNS)).join(spread(comments(spark, folder)), "comment_id")
    scored = features.lexicon_polarity(hits, lexicon)
    return scored.select(
        F.col("comment_id").alias("Yorum_ID"),
        F.col("lang").alias("Tarih"),
        F.col("text").alias("Yorum"),
        labels.sentiment_of_polarity(F.col("polarity")).alias("Duygu"),
        F.col("polarity").alias("Duygu_Polaritesi"),
        *LABEL_COLUMNS,
    )


def _vectors(spark, folder):
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").alias("grp"), F.col("embedding").cast("array<double>").alias("vector")
    )


NEIGHBOUR_SQL = """pairs AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbour_id, a.label AS a_label, b.label AS b_label,
  power(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 2) AS d
FROM embeddings a JOIN embeddings b ON {on}),
nearest AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, neighbour_id) AS rank FROM pairs QUALIFY rank <= 5)"""


@query(
    "nearest_neighbours",
    f"""WITH {NEIGHBOUR_SQL.format(on='a.label = b.label AND a.vec_id <> b.vec_id')}
SELECT query_id, neighbour_id, round(d, 5) AS distance2, rank::INTEGER AS rank FROM nearest""",
)
def nearest_neighbours(spark, folder):
    rows = _vectors(spark, folder)
    found = neighbours.knn_join(rows, rows, skip_self=True)
    return found.select("query_id", "neighbour_id", F.round("distance2", 5).alias("distance2"), "rank")


@query(
    "nearest_neighbours_by_cells",
    f"""WITH {NEIGHBOUR_SQL.format(on='a.label = b.label AND a.vec_id <> b.vec_id')}
SELECT query_id, neighbour_id, round(d, 5) AS distance2, rank::INTEGER AS rank FROM nearest""",
)
def nearest_neighbours_by_cells(spark, folder):
    rows = _vectors(spark, folder)
    found = neighbours.knn_join(rows, rows, skip_self=True, broadcast_rows=0, chunk_rows=128, pivots=16)
    return found.select("query_id", "neighbour_id", F.round("distance2", 5).alias("distance2"), "rank")


@query(
    "neighbour_votes",
    f"""WITH {NEIGHBOUR_SQL.format(on='a.vec_id <> b.vec_id')}
SELECT query_id, round(avg(CASE WHEN b_label < 5 THEN 1.0 ELSE 0.0 END), 6) AS p1,
  CASE WHEN avg(CASE WHEN b_label < 5 THEN 1.0 ELSE 0.0 END) > 0.5 THEN 1 ELSE 0 END AS predicted
FROM nearest GROUP BY query_id""",
)
def neighbour_votes(spark, folder):
    rows = _vectors(spark, folder).withColumn("label", (F.col("grp") < 5).cast("int")).withColumn("grp", F.lit(0))
    return neighbours.knn_classify(rows, rows, skip_self=True).select(
        "query_id",
        F.round("p1", 6).alias("p1"),
        labels.winning_class(1 - F.col("p1"), F.col("p1")).alias("predicted"),
    )


@query(
    "balanced_classes",
    """WITH sizes AS (SELECT CASE WHEN label < 3 THEN 1 ELSE 0 END AS label, count(*) AS n FROM embeddings GROUP BY 1)
SELECT label, (SELECT max(n) FROM sizes)::BIGINT AS rows, ((SELECT max(n) FROM sizes) - n)::BIGINT AS synthetic FROM sizes""",
)
def balanced_classes(spark, folder):
    rows = _vectors(spark, folder).select("id", (F.col("grp") < 3).cast("int").alias("label"), "vector")
    balanced, _ = balance.oversample(rows)
    return balanced.groupBy("label").agg(F.count(F.lit(1)).alias("rows"), F.sum("synthetic").alias("synthetic"))


@query("balanced_rows")
def balanced_rows(spark, folder):
    rows = _vectors(spark, folder).select("id", (F.col("grp") < 3).cast("int").alias("label"), "vector")
    balanced, _ = balance.oversample(rows)
    return balanced.where("synthetic = 1").select("id", "label", F.element_at("vector", 1).alias("first"))
