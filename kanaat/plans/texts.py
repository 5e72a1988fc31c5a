"""Cleaning, filtering, duplicates, unions and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kanaat.functions import keys, labels, text
from kanaat.functions.fixed_values import DEDUP_PREFIX, MIN_WORDS, STORED_LENGTH
from kanaat.operators import metrics, tables
from kanaat.plans.inputs import LABEL_COLUMNS, comments, labelled, rounded
from kanaat.plans.registry import LABELS, SPACE, query, sql_clean, sql_words
from kanaat.sources.tables import spread, table


@query(
    "positive_share_of_cleaned",
    f"""WITH {LABELS}, cleaned AS (
  SELECT doc_id AS comment_id FROM documents
  WHERE text IS NOT NULL AND {sql_words('text')} >= {MIN_WORDS} AND {sql_clean('text')} <> '')
SELECT category, count(*)::BIGINT AS total, sum(label)::BIGINT AS positives,
  round(sum(label) * 100.0 / count(*), 6) AS share
FROM labelled JOIN cleaned USING (comment_id) GROUP BY category""",
)
def positive_share_of_cleaned(spark, folder):
    usable = spread(comments(spark, folder)).where(
        text.has_words(F.col("text")) & text.has_content(F.col("text"))
    )
    return rounded(tables.positive_share(labelled(spark, folder).join(usable.select("comment_id"), "comment_id")))


@query(
    "clean_text",
    f"""SELECT doc_id AS comment_id, {sql_clean('text')} AS cleaned FROM documents
WHERE {sql_clean("coalesce(text, '')")} <> ''""",
)
def clean_text(spark, folder):
    rows = spread(comments(spark, folder)).where(text.has_content(F.col("text")))
    return rows.select("comment_id", text.clean_text(F.col("text")).alias("cleaned"))


@query(
    "min_word_filter",
    f"""SELECT doc_id AS comment_id, text, {sql_words('text')}::INTEGER AS words FROM documents
WHERE text IS NOT NULL AND {sql_words('text')} >= {MIN_WORDS}""",
)
def min_word_filter(spark, folder):
    kept = tables.long_enough(spread(comments(spark, folder)))
    return kept.select("comment_id", "text", text.word_count(F.col("text")).alias("words"))


@query(
    "kept_and_removed",
    f"""SELECT count(*)::BIGINT AS total, count(*) FILTER ({sql_words("coalesce(text, '')")} >= {MIN_WORDS})::BIGINT AS kept,
  count(*) FILTER ({sql_words("coalesce(text, '')")} < {MIN_WORDS})::BIGINT AS removed FROM documents""",
)
def kept_and_removed(spark, folder):
    return tables.kept_and_removed(spread(comments(spark, folder)), text.has_words(F.col("text")))


@query(
    "drop_null_subset",
    """SELECT d.doc_id AS comment_id, d.source, l.quality, l.toxic
FROM documents d LEFT JOIN labels l USING (doc_id) WHERE d.text IS NOT NULL AND l.quality IS NOT NULL""",
)
def drop_null_subset(spark, folder):
    joined = comments(spark, folder).join(
        table(spark, folder, "labels").withColumnRenamed("doc_id", "comment_id"), "comment_id", "left"
    )
    return joined.dropna(subset=["text", "quality"]).select("comment_id", "source", *LABEL_COLUMNS)


@query(
    "null_rows_per_source",
    """SELECT d.source, count(*)::BIGINT AS total, count(l.quality)::BIGINT AS kept,
  (count(*) - count(l.quality))::BIGINT AS removed
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY d.source""",
)
def null_rows_per_source(spark, folder):
    joined = comments(spark, folder).join(
        table(spark, folder, "labels").withColumnRenamed("doc_id", "comment_id"), "comment_id", "left"
    )
    kept = F.count("quality")
    return joined.groupBy("source").agg(
        F.count(F.lit(1)).alias("total"), kept.alias("kept"), (F.count(F.lit(1)) - kept).alias("removed")
    )


@query("drop_blank", f"SELECT conv_id, turn, text FROM conversations WHERE regexp_matches(text, '[^{SPACE}]')")
def drop_blank(spark, folder):
    return tables.with_text(table(spark, folder, "conversations")).select("conv_id", "turn", "text")


@query(
    "label_split",
    f"""WITH {LABELS} SELECT category, CASE label WHEN 1 THEN 'positive' ELSE 'negative' END AS part,
  comment_id FROM labelled WHERE label IN (0, 1)""",
)
def label_split(spark, folder):
    rows = labelled(spark, folder)
    parts = [rows.where(F.col("label") == v).select("category", F.lit(p).alias("part"), "comment_id")
             for v, p in ((1, "positive"), (0, "negative"))]
    return tables.union_all(parts)


@query(
    "label_value_counts",
    f"""WITH {LABELS}, raw AS (SELECT category, label,
  CASE WHEN label = 1 AND category = 'quality' THEN ' Evet ' WHEN label = 1 THEN 'TRUE'
       WHEN category = 'toxic' THEN 'hayır' ELSE '0' END AS spelled FROM labelled)
SELECT category, spelled, CASE WHEN lower(trim(spelled)) IN ('1','true','evet','yes','positive','pozitif')
  THEN 1 ELSE 0 END AS normalised, count(*)::BIGINT AS n FROM raw GROUP BY ALL""",
)
def label_value_counts(spark, folder):
    one, quality = F.col("label") == 1, F.col("category") == "quality"
    spelled = F.when(one & quality, " Evet ").when(one, "TRUE").when(~quality, "hayır").otherwise("0")
    raw = labelled(spark, folder).withColumn("spelled", spelled)
    return raw.groupBy("category", "spelled", labels.normalise_label(F.col("spelled")).alias("normalised")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "positive_share",
    f"""WITH {LABELS} SELECT category, count(*)::BIGINT AS total, sum(label)::BIGINT AS positives,
  round(sum(label) * 100.0 / count(*), 6) AS share FROM labelled GROUP BY category""",
)
def positive_share(spark, folder):
    return rounded(tables.positive_share(labelled(spark, folder)))


@query(
    "any_category",
    """SELECT doc_id AS comment_id, source FROM documents
WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality + toxic > 0)""",
)
def any_category(spark, folder):
    hits = table(spark, folder, "labels").where(tables.any_category(LABEL_COLUMNS))
    return comments(spark, folder).join(
        hits.select(F.col("doc_id").alias("comment_id")), "comment_id", "left_semi"
    ).select("comment_id", "source")


@query(
    "collapse_spaces",
    f"SELECT doc_id AS comment_id, trim(regexp_replace(text, '[{SPACE}]+', ' ', 'g')) AS text FROM documents",
)
def collapse_spaces(spark, folder):
    return spread(comments(spark, folder)).select("comment_id", text.collapse_spaces(F.col("text")).alias("text"))


@query(
    "stored_entries",
    f"""SELECT doc_id AS comment_id, replace(replace(CASE WHEN length(text) > {STORED_LENGTH}
  THEN left(text, {STORED_LENGTH}) || '...' ELSE text END, chr(10), ' '), chr(13), '') AS content,
  CASE WHEN length(text) > 70 THEN left(text, 70) || '...' ELSE text END AS preview FROM documents""",
)
def stored_entries(spark, folder):
    return comments(spark, folder).select(
        "comment_id",
        text.flatten_lines(text.shorten(F.col("text"), STORED_LENGTH)).alias("content"),
        text.shorten(F.col("text"), 70).alias("preview"),
    )


@query(
    "model_sentiment",
    """WITH logits AS (SELECT doc_id AS comment_id, length(text) / 1000.0::DOUBLE AS l0,
  len(regexp_extract_all(text, 'e')) / 120.0::DOUBLE AS l1 FROM documents
  WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality + toxic > 0)),
probs AS (SELECT comment_id, exp(l0 - greatest(l0, l1)) / (exp(l0 - greatest(l0, l1)) + exp(l1 - greatest(l0, l1))) AS p0,
  exp(l1 - greatest(l0, l1)) / (exp(l0 - greatest(l0, l1)) + exp(l1 - greatest(l0, l1))) AS p1 FROM logits)
SELECT comment_id, round(p1 - p0, 6) AS polarity, CASE WHEN p1 > p0 THEN 'Pozitif' ELSE 'Negatif' END AS sentiment
FROM probs""",
)
def model_sentiment(spark, folder):
    hits = table(spark, folder, "labels").where(tables.any_category(LABEL_COLUMNS))
    scored = spread(comments(spark, folder)).join(
        hits.select(F.col("doc_id").alias("comment_id")), "comment_id", "left_semi"
    ).select(
        "comment_id",
        labels.softmax(
            F.array(F.length("text") / F.lit(1000.0), F.regexp_count("text", F.lit("e")) / F.lit(120.0))
        ).alias("p"),
    )
    p0, p1 = F.col("p")[0], F.col("p")[1]
    return scored.select(
        "comment_id",
        F.round(labels.polarity(p0, p1), 6).alias("polarity"),
        labels.sentiment_of_probabilities(p0, p1).alias("sentiment"),
    )


@query(
    "distinct_texts",
    "SELECT DISTINCT source, lang, text FROM documents",
)
def distinct_texts(spark, folder):
    return comments(spark, folder).select("source", "lang", "text").distinct()


@query(
    "exact_duplicates_removed",
    """SELECT doc_id AS comment_id, lang, source, text FROM documents
QUALIFY row_number() OVER (PARTITION BY lang, text ORDER BY doc_id) = 1""",
)
def exact_duplicates_removed(spark, folder):
    return tables.keep_first(comments(spark, folder), [F.col("lang"), F.col("text")], "comment_id").select(
        "comment_id", "lang", "source", "text"
    )


@query(
    "prefix_duplicates_removed",
    f"""SELECT doc_id AS comment_id, lang, source, text, md5(lang || '‖' || left(text, {DEDUP_PREFIX})) AS review_key
FROM documents QUALIFY row_number() OVER (PARTITION BY lang, left(text, {DEDUP_PREFIX}) ORDER BY doc_id) = 1""",
)
def prefix_duplicates_removed(spark, folder):
    prefix = F.substring("text", 1, DEDUP_PREFIX)
    return tables.keep_first(comments(spark, folder), [F.col("lang"), prefix], "comment_id").select(
        "comment_id", "lang", "source", "text", keys.prefix_key(F.col("lang"), F.col("text")).alias("review_key")
    )


@query(
    "weighted_metrics",
    f"""WITH {LABELS}, scored AS (
  SELECT category, label, CASE WHEN category = 'quality' AND length(text) > 1500 THEN 1
    WHEN category = 'toxic' AND contains(text, 'the') THEN 1 ELSE 0 END AS predicted
  FROM labelled JOIN documents ON doc_id = comment_id),
counts AS (SELECT category, sum(label * predicted)::DOUBLE AS tp, sum((1 - label) * predicted)::DOUBLE AS fp,
  sum(label * (1 - predicted))::DOUBLE AS fn, sum((1 - label) * (1 - predicted))::DOUBLE AS tn FROM scored GROUP BY category)
SELECT category, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
  round((tp + fn) / (tp + fp + fn + tn) * CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END
    + (tn + fp) / (tp + fp + fn + tn) * CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0 END, 6) AS precision,
  round((tp + tn) / (tp + fp + fn + tn), 6) AS recall,
  round((tp + fn) / (tp + fp + fn + tn) * CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END
    + (tn + fp) / (tp + fp + fn + tn) * CASE WHEN 2 * tn + fp + fn > 0 THEN 2 * tn / (2 * tn + fp + fn) ELSE 0 END, 6) AS f1
FROM counts""",
)
def weighted_metrics(spark, folder):
    long_text = (F.col("category") == "quality") & (F.length("text") > 1500)
    has_the = (F.col("category") == "toxic") & F.contains("text", F.lit("the"))
    scored = labelled(spark, folder).join(comments(spark, folder), "comment_id").select(
        "category", "label", F.when(long_text | has_the, 1).otherwise(0).alias("predicted")
    )
    return rounded(metrics.weighted_metrics(scored, ["category"]))


@query(
    "union_of_labelled",
    """SELECT doc_id AS comment_id, quality AS label, lang, 'quality' AS origin FROM labels JOIN documents USING (doc_id)
UNION ALL SELECT doc_id, toxic, NULL, 'toxic' FROM labels""",
)
def union_of_labelled(spark, folder):
    given = table(spark, folder, "labels").withColumnRenamed("doc_id", "comment_id")
    quality = given.join(comments(spark, folder), "comment_id").select(
        "comment_id", F.col("quality").alias("label"), "lang", F.lit("quality").alias("origin")
    )
    toxic = given.select("comment_id", F.col("toxic").alias("label"), F.lit("toxic").alias("origin"))
    return tables.union_all([quality, toxic])


@query(
    "unified_sources",
    """SELECT lang AS date_text, text, 'reviews' AS source FROM documents
UNION ALL SELECT role, text, 'complaints' FROM conversations
UNION ALL SELECT NULL, text, 'entries' FROM benchmark""",
)
def unified_sources(spark, folder):
    return tables.union_all([
        tables.as_comments(table(spark, folder, "documents"), "text", "lang", "reviews"),
        tables.as_comments(table(spark, folder, "conversations"), "text", "role", "complaints"),
        tables.as_comments(table(spark, folder, "benchmark"), "text", None, "entries"),
    ])


@query(
    "row_identity",
    """SELECT md5(lang || '‖' || text || '‖' || source) AS comment_id, count(*)::BIGINT AS copies FROM documents GROUP BY 1""",
)
def row_identity(spark, folder):
    made = comments(spark, folder).select(keys.row_id(F.col("lang"), F.col("text"), F.col("source")).alias("comment_id"))
    return made.groupBy("comment_id").agg(F.count(F.lit(1)).alias("copies"))


@query(
    "stripped_lower",
    "SELECT lower(trim(c_mktsegment)) AS market, count(*)::BIGINT AS n FROM customer GROUP BY 1",
)
def stripped_lower(spark, folder):
    market = F.lower(text.strip_space(F.col("c_mktsegment"))).alias("market")
    return table(spark, folder, "customer").groupBy(market).agg(F.count(F.lit(1)).alias("n"))


@query(
    "column_defaults",
    """SELECT doc_id AS comment_id, 'Tarih Yok' AS "Tarih", lang, 0 AS quality, 0.0::DOUBLE AS "Duygu_Polaritesi",
  'Nötr' AS "Duygu_Etiketi" FROM documents""",
)
def column_defaults(spark, folder):
    rows = tables.with_default(tables.with_default(comments(spark, folder), "Tarih", "Tarih Yok"), "lang", "?")
    return rows.select(
        "comment_id", "Tarih", "lang", F.lit(0).alias("quality"),
        F.lit(0.0).alias("Duygu_Polaritesi"), F.lit("Nötr").alias("Duygu_Etiketi"),
    )


@query(
    "timestamp_text",
    """SELECT event_id, strftime(ts, '%Y%m%d_%H%M') AS stamp,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.') || lpad((epoch_us(ts) % 1000000)::VARCHAR, 6, '0') AS iso FROM events""",
)
def timestamp_text(spark, folder):
    return table(spark, folder, "events").select(
        "event_id",
        F.date_format("ts", "yyyyMMdd_HHmm").alias("stamp"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("iso"),
    )
