"""The feed operators over the given tables, each run to the end of what is there."""

from __future__ import annotations

from pyspark.sql import functions as F

from kanaat.functions.fixed_values import ACTIVE_SECONDS, DEDUP_PREFIX, SILENT_SECONDS
from kanaat.operators import labelling
from kanaat.plans.progress import _keyword_answer
from kanaat.plans.registry import query
from kanaat.plans.samples import NATURE
from kanaat.session import shared_path
from kanaat.sources.tables import table
from kanaat.streaming import feed


def _finished(spark, result, name):
    path = shared_path(spark, name)
    feed.append_to(result, f"{path}/rows", f"{path}/state").awaitTermination()
    return spark.read.schema(result.schema).parquet(f"{path}/rows")


def _stream(spark, folder, name):
    # As a pattern the path may be one file or a folder of files.
    return feed.read_feed(spark, f"{folder.rstrip('/')}/{name}.parque[t]", table(spark, folder, name).schema)


def _arriving(spark, folder, name, batches=3):
    """The table as several files that a feed takes one at a time, so that its state spans batches."""
    rows, path = table(spark, folder, name), shared_path(spark, f"arriving-{name}")
    rows.repartition(batches).write.parquet(path)
    return feed.read_feed(spark, path, rows.schema, files_per_batch=1)


def _timed(spark, folder):
    return _stream(spark, folder, "events").withColumn("at", F.col("ts").cast("timestamp"))


@query("feed_unseen_keys", "SELECT DISTINCT user_id, event_type FROM events")
def feed_unseen_keys(spark, folder):
    rows = _arriving(spark, folder, "events").select("user_id", "event_type")
    return _finished(spark, feed.unseen(rows, ["user_id", "event_type"]), "unseen")


@query("feed_unseen_within_a_day", "SELECT DISTINCT user_id, event_type FROM events")
def feed_unseen_within_a_day(spark, folder):
    # One batch: nothing is forgotten inside it, so the first of each pair stays.
    rows = _timed(spark, folder).select("at", "user_id", "event_type")
    return _finished(spark, feed.unseen(rows, ["user_id", "event_type"], "at"), "within").drop("at")


@query("feed_unseen_reviews", f"SELECT DISTINCT lang, left(text, {DEDUP_PREFIX}) AS start FROM documents")
def feed_unseen_reviews(spark, folder):
    fresh = feed.unseen_reviews(_stream(spark, folder, "documents"), "lang", "text")
    kept = _finished(spark, fresh.select("lang", "text"), "reviews")
    return kept.select("lang", F.substring("text", 1, DEDUP_PREFIX).alias("start"))


@query(
    "feed_active_workers",
    f"""WITH w AS (SELECT (epoch_us(ts) // ({ACTIVE_SECONDS} * 1000000)) * {ACTIVE_SECONDS} AS window_start, user_id FROM events)
SELECT window_start, count(DISTINCT user_id)::BIGINT AS active, count(*)::BIGINT AS events FROM w
WHERE window_start + {ACTIVE_SECONDS} <= (SELECT epoch_us(max(ts)) / 1000000 - 10 FROM events) GROUP BY window_start""",
)
def feed_active_workers(spark, folder):
    counted = feed.active_workers(_timed(spark, folder), "at", "user_id")
    return _finished(spark, counted, "active").select(
        F.unix_seconds("window_start").alias("window_start"), "active", "events"
    )


@query(
    "feed_activity_sessions",
    f"""WITH e AS (SELECT user_id, event_id, epoch_us(ts) AS t FROM events),
o AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id) < {SILENT_SECONDS} * 1000000 THEN 0 ELSE 1 END AS opens FROM e),
s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS spell FROM o)
SELECT user_id, min(t) AS session_start, count(*)::BIGINT AS events FROM s GROUP BY user_id, spell
HAVING max(t) + {SILENT_SECONDS} * 1000000 <= (SELECT epoch_us(max(ts)) - 10000000 FROM events)""",
)
def feed_activity_sessions(spark, folder):
    spells = feed.activity_sessions(_timed(spark, folder), "at", "user_id")
    return _finished(spark, spells, "sessions").select(
        "user_id", F.unix_micros("session_start").alias("session_start"), "events"
    )


@query(
    "feed_labels",
    """SELECT conv_id, turn, regexp_matches(lower(text), 'the|des|und|los')::INTEGER AS label FROM conversations""",
)
def feed_labels(spark, folder):
    path = shared_path(spark, "labels")

    def label(batch):
        asked = batch.withColumn("category", F.lit("articles"))
        return labelling.label_comments(asked, _keyword_answer, NATURE, pause=0.0).select("conv_id", "turn", "label")

    feed.label_feed(
        _stream(spark, folder, "conversations"), label, f"{path}/rows", f"{path}/state", ["conv_id", "turn"]
    ).awaitTermination()
    return spark.read.parquet(f"{path}/rows").select("conv_id", "turn", "label")
