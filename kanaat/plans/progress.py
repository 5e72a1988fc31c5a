"""Progress tables, activity, metric reports, votes and label caches."""

from __future__ import annotations

from pyspark.sql import functions as F

from kanaat.functions import labels
from kanaat.functions.fixed_values import ACTIVE_SECONDS, SILENT_SECONDS, STAGNANT_CHECKS, TEST, TRAIN
from kanaat.operators import labelling, metrics, sequences, tables
from kanaat.plans.inputs import comments, labelled, rounded
from kanaat.plans.registry import LABELS, query
from kanaat.plans.samples import NATURE
from kanaat.sources import checkpoints
from kanaat.sources.tables import spread, table


def _events(spark, folder):
    return table(spark, folder, "events").withColumn("micros", F.unix_micros(F.col("ts").cast("timestamp")))


@query(
    "stagnant_counters",
    f"""WITH p AS (SELECT user_id, event_id, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS loaded FROM events),
c AS (SELECT *, CASE WHEN loaded = lag(loaded) OVER w THEN 0 ELSE 1 END AS changed FROM p WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
g AS (SELECT *, sum(changed) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM c)
SELECT user_id, event_id, loaded::BIGINT AS loaded, (row_number() OVER (PARTITION BY user_id, run ORDER BY event_id) - 1)::BIGINT AS unchanged,
  CASE WHEN row_number() OVER (PARTITION BY user_id, run ORDER BY event_id) - 1 >= {STAGNANT_CHECKS} THEN 1 ELSE 0 END AS finished FROM g""",
)
def stagnant_counters(spark, folder):
    from kanaat.operators.ranking import running, with_order_bucket

    events = table(spark, folder, "events").select("user_id", "event_id", "event_type")
    counted = running(
        with_order_bucket(events, "event_id"), ["user_id"], ["event_id"],
        sums={"loaded": (F.col("event_type") == "purchase").cast("int")},
    ).drop("_bucket", "event_type")
    return sequences.stagnation(counted, "user_id", "event_id", "loaded")


@query(
    "activity_sessions",
    f"""WITH e AS (SELECT user_id, event_id, epoch_us(ts) AS t FROM events),
o AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id) < {SILENT_SECONDS} * 1000000 THEN 0 ELSE 1 END AS opens FROM e),
s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS spell FROM o)
SELECT user_id, min(t) AS session_start, max(t) AS session_end, count(*)::BIGINT AS events FROM s GROUP BY user_id, spell""",
)
def activity_sessions(spark, folder):
    return sequences.activity_sessions(_events(spark, folder), "user_id", "micros")


@query(
    "active_workers",
    f"""SELECT (epoch_us(ts) // ({ACTIVE_SECONDS} * 1000000)) * {ACTIVE_SECONDS} AS window_start, count(DISTINCT user_id)::BIGINT AS active
FROM events GROUP BY 1""",
)
def active_workers(spark, folder):
    spans = F.window(F.col("ts").cast("timestamp"), f"{ACTIVE_SECONDS} seconds")
    return table(spark, folder, "events").groupBy(spans.alias("w")).agg(
        F.countDistinct("user_id").alias("active")
    ).select(F.unix_seconds("w.start").alias("window_start"), "active")


@query(
    "time_left",
    """WITH p AS (SELECT user_id, date_trunc('day', ts) AS day, count(*)::BIGINT AS n,
  (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE AS elapsed FROM events GROUP BY ALL),
r AS (SELECT *, greatest(elapsed / n * 100 - elapsed, 0) AS remaining FROM p)
SELECT user_id, strftime(day, '%Y-%m-%d') AS day, n, round(remaining, 3) AS seconds,
  (floor(remaining)::BIGINT // 3600)::VARCHAR || ':' || lpad(((floor(remaining)::BIGINT % 3600) // 60)::VARCHAR, 2, '0') || ':' || lpad((floor(remaining)::BIGINT % 60)::VARCHAR, 2, '0') AS clock FROM r""",
)
def time_left(spark, folder):
    done = _events(spark, folder).groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), ((F.max("micros") - F.min("micros")) / F.lit(1_000_000.0)).alias("elapsed")
    )
    seconds = labels.seconds_left(F.col("elapsed"), F.col("n"), F.lit(100))
    return done.withColumn("left", seconds).select(
        "user_id", "day", "n", F.round("left", 3).alias("seconds"), labels.clock(F.col("left")).alias("clock")
    )


# Two simple rules stand for trained models; their scores grow with the texts.
RULES_SQL = f"""{LABELS}, ruled AS (SELECT comment_id, category, label, md5('7|' || comment_id::VARCHAR) < '4' AS is_test,
  CASE WHEN length(text) > 1500 THEN 1 ELSE 0 END AS long_text, CASE WHEN contains(text, 'the') THEN 1 ELSE 0 END AS english
  FROM labelled JOIN documents ON doc_id = comment_id),
scored AS (SELECT category, 'long' AS model, is_test, label, long_text AS predicted FROM ruled
  UNION ALL SELECT category, 'english', is_test, label, english FROM ruled),
c AS (SELECT category, model, CASE WHEN is_test THEN '{TEST}' ELSE '{TRAIN}' END AS split,
  sum(label * predicted)::DOUBLE AS tp, sum((1 - label) * predicted)::DOUBLE AS fp,
  sum(label * (1 - predicted))::DOUBLE AS fn, sum((1 - label) * (1 - predicted))::DOUBLE AS tn FROM scored GROUP BY ALL),
m AS (SELECT category, model, split, (tp + tn) / (tp + fp + fn + tn) AS accuracy,
  ((tp + fn) / (tp + fp + fn + tn) * CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END
    + (tn + fp) / (tp + fp + fn + tn) * CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0 END) AS precision,
  ((tp + fn) / (tp + fp + fn + tn) * CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END
    + (tn + fp) / (tp + fp + fn + tn) * CASE WHEN 2 * tn + fp + fn > 0 THEN 2 * tn / (2 * tn + fp + fn) ELSE 0 END) AS f1 FROM c)"""


def _rule_metrics(spark, folder):
    rows = labelled(spark, folder).join(comments(spark, folder).select("comment_id", "text"), "comment_id").select(
        "category",
        "label",
        F.when(F.md5(F.concat(F.lit("7|"), F.col("comment_id").cast("string"))) < "4", TEST).otherwise(TRAIN).alias("split"),
        (F.length("text") > 1500).cast("int").alias("long"),
        F.contains("text", F.lit("the")).cast("int").alias("english"),
    )
    scored = rows.unpivot(["category", "split", "label"], ["long", "english"], "model", "predicted")
    return metrics.weighted_metrics(scored, ["category", "model", "split"])


@query(
    "metric_pivot",
    f"""WITH {RULES_SQL} SELECT a.category, round(a.accuracy, 6) AS train_accuracy, round(a.precision, 6) AS train_precision,
  round(a.accuracy, 6) AS train_recall, round(a.f1, 6) AS train_f1, round(b.accuracy, 6) AS test_accuracy,
  round(b.precision, 6) AS test_precision, round(b.accuracy, 6) AS test_recall, round(b.f1, 6) AS test_f1
FROM m a JOIN m b ON a.category = b.category AND a.model = 'long' AND b.model = 'long' AND a.split = '{TRAIN}' AND b.split = '{TEST}'""",
)
def metric_pivot(spark, folder):
    return rounded(metrics.metric_pivot(_rule_metrics(spark, folder).where(F.col("model") == "long")))


@query(
    "all_metrics",
    f"""WITH {RULES_SQL} SELECT category, model, split, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(accuracy, 6) AS recall, round(f1, 6) AS f1 FROM m""",
)
def all_metrics(spark, folder):
    every = _rule_metrics(spark, folder)
    return rounded(tables.union_all([every.where(F.col("split") == TRAIN), every.where(F.col("split") == TEST)]))


SUMMARY_SQL = f"""s AS (SELECT a.category, a.model, a.accuracy AS train_accuracy, a.f1 AS train_f1, b.accuracy AS test_accuracy,
  b.f1 AS test_f1, a.accuracy - b.accuracy AS gap FROM m a JOIN m b USING (category, model)
  WHERE a.split = '{TRAIN}' AND b.split = '{TEST}')"""


def _summary(spark, folder):
    every = _rule_metrics(spark, folder)
    return metrics.model_summary(
        every.where(F.col("split") == TRAIN), every.where(F.col("split") == TEST), ["category", "model"]
    )


@query("model_summary", f"WITH {RULES_SQL}, {SUMMARY_SQL} SELECT category, model, round(train_accuracy, 6) AS train_accuracy, round(train_f1, 6) AS train_f1, round(test_accuracy, 6) AS test_accuracy, round(test_f1, 6) AS test_f1, round(gap, 6) AS gap, (gap > 0.15)::INTEGER AS overfit FROM s")
def model_summary(spark, folder):
    return rounded(_summary(spark, folder))


@query(
    "overall_report",
    f"""WITH {RULES_SQL}, {SUMMARY_SQL} SELECT round(avg(train_accuracy), 6) AS mean_train, round(avg(test_accuracy), 6) AS mean_test,
  round(avg(train_accuracy) - avg(test_accuracy), 6) AS mean_gap,
  (avg(train_accuracy) - avg(test_accuracy) > 0.15)::INTEGER AS overfit FROM s""",
)
def overall_report(spark, folder):
    return rounded(metrics.overall_report(_summary(spark, folder)))


@query(
    "soft_vote",
    """WITH s AS (SELECT doc_id AS comment_id, 1 / (1 + exp(-(length(text) / 1000.0::DOUBLE - 1))) AS p_a,
  1 / (1 + exp(-(len(regexp_extract_all(text, 'e')) / 100.0::DOUBLE - 1))) AS p_b, CASE WHEN contains(text, 'the') THEN 1.0 ELSE 0.0 END AS p_c FROM documents)
SELECT comment_id, round((p_a + p_b + p_c) / 3, 6) AS p1, CASE WHEN (p_a + p_b + p_c) / 3 > 1 - (p_a + p_b + p_c) / 3 THEN 1 ELSE 0 END AS predicted FROM s""",
)
def soft_vote(spark, folder):
    from kanaat.operators.ensemble import vote

    one = F.lit(1.0)
    scores = spread(comments(spark, folder)).select(
        "comment_id",
        (one / (one + F.exp(-(F.length("text") / F.lit(1000.0) - 1)))).alias("p_a"),
        (one / (one + F.exp(-(F.regexp_count("text", F.lit("e")) / F.lit(100.0) - 1)))).alias("p_b"),
        F.contains("text", F.lit("the")).cast("double").alias("p_c"),
    )
    return vote(scores, ["p_a", "p_b", "p_c"]).select("comment_id", F.round("p1", 6).alias("p1"), "predicted")


def _keyword_answer():
    """A labeller standing in for a model: yes when the comment holds a keyword of the description."""

    def ask(prompt: str) -> str:
        comment = prompt.split('YORUM: "', 1)[1].split('"\n    \n', 1)[0].lower()
        listed = prompt.rsplit("Anahtar Kelimeler:", 1)
        words = listed[1].split("\n")[0].split(",") if len(listed) == 2 else []
        return "Evet." if any(w.strip() and w.strip() in comment for w in words) else "hayır"

    return ask


@query(
    "labels_of_distinct_questions",
    """SELECT doc_id AS comment_id, category, CASE category WHEN 'articles' THEN regexp_matches(lower(text), 'the|des|und|los')
    WHEN 'endings' THEN regexp_matches(lower(text), 'tion|ment|ung|ción') ELSE false END::INTEGER AS label, 1 AS attempts, 0 AS failed
FROM documents, (VALUES ('articles'), ('endings'), ('plain')) c(category)""",
)
def labels_of_distinct_questions(spark, folder):
    from kanaat.operators.categories import per_category

    asked = per_category(spread(comments(spark, folder)).select("comment_id", "text"), NATURE)
    return labelling.label_comments(asked, _keyword_answer, NATURE, pause=0.0).select(
        "comment_id", "category", "label", "attempts", "failed"
    )


@query(
    "labels_until_quota",
    """WITH asked AS (SELECT doc_id AS comment_id, category, CASE category WHEN 'articles' THEN regexp_matches(lower(text), 'the|des|und|los')
    WHEN 'endings' THEN regexp_matches(lower(text), 'tion|ment|ung|ción') ELSE false END::INTEGER AS label
  FROM documents, (VALUES ('articles'), ('endings'), ('plain')) c(category) WHERE trim(text, ' \t\n\r') <> '')
SELECT category, comment_id, label FROM asked QUALIFY row_number() OVER (
  PARTITION BY category, label ORDER BY md5('42|' || comment_id::VARCHAR), comment_id) <= CASE label WHEN 1 THEN 60 ELSE 40 END""",
)
def labels_until_quota(spark, folder):
    """The quota sample of a labeller that is asked no more than it takes."""
    from kanaat.operators.categories import per_category

    asked = per_category(spread(comments(spark, folder)).select("comment_id", "text"), NATURE)
    return labelling.label_until_quota(asked, _keyword_answer, 60, 40, NATURE, pause=0.0).select("category", "comment_id", "label")


@query(
    "parsed_checkpoints",
    """SELECT category, (sum(label))::BIGINT AS positives, count(*)::BIGINT AS results, min(text_length)::BIGINT AS shortest FROM (
  SELECT 'quality' AS category, quality AS label, length(text) AS text_length FROM labels JOIN documents USING (doc_id)
  UNION ALL SELECT 'toxic', toxic, length(text) FROM labels JOIN documents USING (doc_id)) GROUP BY category""",
)
def parsed_checkpoints(spark, folder):
    rows = labelled(spark, folder).join(comments(spark, folder), "comment_id")
    saved = rows.select(F.to_json(F.struct(
        "category", F.lit(400).alias("target_positive"), F.lit(400).alias("target_negative"),
        F.array(F.struct(
            F.col("lang").alias("Tarih"), F.col("text").alias("Yorum"), F.col("label").alias("Sonuç")
        )).alias("results"),
        F.array("comment_id").alias("processed_indices"),
    )).alias("json"))
    parsed = saved.select(checkpoints.parse_checkpoint(F.col("json")).alias("c")).select("c.*")
    return checkpoints.results(parsed.where(F.col("target_positive") == 400)).groupBy("category").agg(
        F.sum("Sonuç").alias("positives"), F.count(F.lit(1)).alias("results"),
        F.min(F.length("Yorum")).cast("long").alias("shortest"),
    )


@query(
    "unlabelled_comments",
    f"""WITH {LABELS} SELECT doc_id AS comment_id, category FROM documents, (VALUES ('quality'), ('toxic')) c(category)
WHERE (doc_id, category) NOT IN (SELECT (comment_id, category) FROM labelled)""",
)
def unlabelled_comments(spark, folder):
    from kanaat.operators.categories import per_category

    asked = per_category(comments(spark, folder).select("comment_id"), [("quality", ""), ("toxic", "")])
    return labelling.unlabelled(asked, labelled(spark, folder))
