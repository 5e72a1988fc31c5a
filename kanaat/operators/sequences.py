"""Results that follow an order: page runs, unchanged counters, silence between events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kanaat.functions.fixed_values import SILENT_SECONDS, STAGNANT_CHECKS
from kanaat.operators import ranking
from kanaat.session import small_side


def until_first_failure(pages: DataFrame, topic: str, page: str, failed: Column) -> DataFrame:
    """Pages of a topic before its first failed one. The failure point is aggregated, not windowed,
    so a topic with very many pages needs no single task."""
    marked = pages.withColumn("_failed", failed)
    ends = marked.where("_failed").groupBy(topic).agg(F.min(page).alias("_end"))
    return marked.join(small_side(ends), topic, "left").where(
        F.col("_end").isNull() | (F.col(page) < F.col("_end"))
    ).drop("_end", "_failed")


def numbered_items(pages: DataFrame, page: str, items: Column) -> DataFrame:
    """Explode each page's items with their position in the page and a running number over all pages.
    Offsets are summed per page, so items are never sorted."""
    sized = pages.withColumn("_items", items).withColumn("_size", F.size("_items"))
    placed = ranking.with_order_bucket(sized, page)
    offsets = ranking.running(placed, [], [page], sums={"_end": F.col("_size").cast("long")})
    return offsets.select(
        page, (F.col("_end") - F.col("_size")).alias("_start"), F.posexplode("_items").alias("_pos", "item")
    ).select(
        page,
        (F.col("_pos") + 1).cast("long").alias("position"),
        (F.col("_start") + F.col("_pos") + 1).cast("long").alias("number"),
        "item",
    )


def stagnation(
    progress: DataFrame, worker: str, check: str, counter: str, checks: int = STAGNANT_CHECKS
) -> DataFrame:
    """Length of the run of unchanged counters up to each check, and whether it means finished."""
    placed = ranking.with_order_bucket(progress, check)
    looked = ranking.running(
        placed, [worker], [check], sums={"_n": F.lit(1)}, previous={"_before": F.col(counter)}
    )
    changed = F.coalesce(F.col("_before") != F.col(counter), F.lit(True))
    runs = ranking.running(
        looked, [worker], [check], maxima={"_run_start": F.when(changed, F.col("_n"))}
    )
    return runs.withColumn("unchanged", (F.col("_n") - F.col("_run_start")).cast("long")).withColumn(
        "finished", (F.col("unchanged") >= checks).cast("int")
    ).drop("_bucket", "_n", "_before", "_run_start")


def activity_sessions(
    events: DataFrame, worker: str, micros: str, silent_seconds: int = SILENT_SECONDS
) -> DataFrame:
    """Spells of activity per worker, ended by silence. ``micros`` is the event time as a number."""
    placed = ranking.with_order_bucket(events, micros)
    gaps = ranking.running(placed, [worker], [micros, "event_id"], previous={"_before": F.col(micros)})
    opens = F.col("_before").isNull() | (F.col(micros) - F.col("_before") >= silent_seconds * 1_000_000)
    spells = ranking.running(
        gaps, [worker], [micros, "event_id"], maxima={"session_start": F.when(opens, F.col(micros))}
    )
    return spells.groupBy(worker, "session_start").agg(
        F.count(F.lit(1)).alias("events"), F.max(micros).alias("session_end")
    )
