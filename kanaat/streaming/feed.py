"""Growing feeds: duplicates removed as they arrive, labelling that resumes, activity by time window."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kanaat.functions.fixed_values import ACTIVE_SECONDS, DEDUP_PREFIX, SILENT_SECONDS
from kanaat.functions.keys import prefix_key


def read_feed(spark: SparkSession, path: str, schema, kind: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """New files of a folder as they appear."""
    reader = spark.readStream.format(kind).schema(schema)
    if kind == "csv":
        reader = reader.option("header", True).option("escape", '"').option("multiLine", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def unseen(feed: DataFrame, keys: list[str], event_time: str | None = None, within: str = "1 day") -> DataFrame:
    """The first row of each key. With an event time, keys are forgotten ``within`` behind the newest
    event, which bounds the state; without, every key ever seen is remembered."""
    if event_time is None:
        return feed.dropDuplicates(keys)
    return feed.withWatermark(event_time, within).dropDuplicatesWithinWatermark(keys)


def unseen_reviews(feed: DataFrame, date: str, text: str, length: int = DEDUP_PREFIX) -> DataFrame:
    """Reviews whose date and first characters have not come before. The state keeps digests only."""
    keyed = feed.withColumn("_review", prefix_key(F.col(date), F.col(text), length))
    return keyed.dropDuplicates(["_review"]).drop("_review")


def active_workers(
    feed: DataFrame, event_time: str, worker: str, late: str = "10 seconds", span: int = ACTIVE_SECONDS, slide: int | None = None
) -> DataFrame:
    """Workers with any activity per window. Each (window, worker) is one state row, counted after."""
    window = F.window(event_time, f"{span} seconds", f"{slide or span} seconds")
    once = feed.withWatermark(event_time, late).groupBy(window.alias("w"), worker).agg(F.count(F.lit(1)).alias("events"))
    return once.groupBy(F.window(F.col("w"), f"{span} seconds").alias("v") if slide is None else F.col("w").alias("v")).agg(
        F.count(F.lit(1)).alias("active"), F.sum("events").alias("events")
    ).select(F.col("v.start").alias("window_start"), F.col("v.end").alias("window_end"), "active", "events")


def activity_sessions(
    feed: DataFrame, event_time: str, worker: str, late: str = "10 seconds", silent: int = SILENT_SECONDS
) -> DataFrame:
    """Spells of activity per worker, closed by silence."""
    spell = F.session_window(event_time, f"{silent} seconds")
    return feed.withWatermark(event_time, late).groupBy(spell.alias("s"), worker).agg(
        F.count(F.lit(1)).alias("events")
    ).select(worker, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "events")


def append_to(
    result: DataFrame, path: str, checkpoint: str, kind: str = "parquet", every: str | None = None
) -> StreamingQuery:
    """Append results to a table; a restart with the same checkpoint adds nothing twice. Without
    ``every`` the query takes what is there and ends."""
    writer = result.writeStream.format(kind).outputMode("append").option("checkpointLocation", checkpoint)
    if kind == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(path)


def label_feed(
    feed: DataFrame, label: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, keys: list[str]
) -> StreamingQuery:
    """Label what arrives and append it. Keys that came before are held back by the stream's own state;
    a batch repeated after a failure overwrites its own folder, so a resumed run adds nothing twice."""

    def one_batch(batch: DataFrame, number: int) -> None:
        label(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = feed.dropDuplicates(keys).writeStream.foreachBatch(one_batch)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
