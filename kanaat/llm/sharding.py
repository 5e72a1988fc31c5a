"""Minimax contiguous partition of a corpus into shards that keep equal texts together.

Groups of equal texts stand in one fixed order, that of their digests. The smallest capacity for which a greedy
pass from the front needs no more than the given number of shards is found by search, and the greedy cuts at that
capacity are the shards. A shard is then a range of digests, so rows find their shard by comparing with a few
literals, without a join.

The order is cut into ranges by leading hex digits. The driver sees one total per range (16 ** digits numbers,
whatever the input); exact positions are looked up inside the few ranges that hold a cut. Many capacities are
tried per job, so a search over 2 ** 20 values takes a handful of rounds.

Null texts count as empty; equal rows, null ids and empty tables are fine. Columns other than id and text are not
touched. A group heavier than a fair share has a shard of that size to itself or nearly so, as nothing can split it.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kanaat.llm.registry import query, table
from kanaat.llm.storage import numbered, stored

# Capacities tried in one round, and rows of one part when slots are numbered.
TRIES, ROWS_PER_PART = 63, 1_000_000


@dataclass
class Ordered:
    """The groups in order: per-range totals on the driver, exact prefix sums in ``placed``."""

    placed: DataFrame  # range, digest, upto: bytes of the range's groups up to this one
    starts: list[int]  # bytes before each range, then the total
    heaviest: int

    @property
    def total(self) -> int:
        return self.starts[-1]


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per document: id, size, checksum and digest of its text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.md5(text).alias("digest"))


def ordered_groups(rows: DataFrame, digits: int = 3) -> Ordered:
    """Sums the rows of each digest (combined before the shuffle) and places the groups."""
    spans = 16 ** digits
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
    span = F.conv(F.substring("digest", 1, digits), 16, 10).cast("int")
    within = Window.partitionBy("range").orderBy("digest")
    placed = stored(groups.withColumn("range", span).select(
        "range", "digest", "bytes", F.sum("bytes").over(within).alias("upto")), "shard-groups")
    totals = {r["range"]: r for r in placed.groupBy("range").agg(
        F.sum("bytes").alias("bytes"), F.max("bytes").alias("most")).collect()}
    starts = [0]
    for i in range(spans):
        starts.append(starts[-1] + (totals[i]["bytes"] if i in totals else 0))
    return Ordered(placed, starts, max((r["most"] for r in totals.values()), default=0))


def furthest(spark: SparkSession, groups: Ordered, limits: dict[int, int]) -> dict[int, tuple[int, str | None]]:
    """For each limit the last group end that does not pass it, and that group's digest if it stands in the range
    the limit falls into. One job for all limits; it reads only the ranges they fall into."""
    probes, found = [], {}
    for key, limit in limits.items():
        span = min(bisect_right(groups.starts, limit), len(groups.starts) - 1) - 1
        found[key] = (groups.starts[span], None)
        probes.append(f"({key}L, {span}, {limit - groups.starts[span]}L, {groups.starts[span]}L)")
    if probes:
        asked = spark.sql(f"SELECT * FROM VALUES {', '.join(probes)} AS t(key, span, room, start)")
        ends = (groups.placed.join(F.broadcast(asked), (F.col("range") == F.col("span")) & (F.col("upto") <= F.col("room")))
                .groupBy("key").agg(F.max(F.struct(F.col("start") + F.col("upto"), "digest")).alias("end")))
        for row in ends.collect():
            found[row["key"]] = (row["end"][0], row["end"][1])
    return found


def greedy(spark: SparkSession, groups: Ordered, capacities: list[int], shards: int) -> list[tuple[int, list]]:
    """Fills shards from the front for every capacity at once: where each ends up, and its cuts."""
    reached, cuts = [0] * len(capacities), [[] for _ in capacities]
    for _ in range(shards):
        open_ = {i: reached[i] + c for i, c in enumerate(capacities) if reached[i] < groups.total}
        for i in [i for i, limit in open_.items() if limit >= groups.total]:
            reached[i] = groups.total
            del open_[i]
        if open_:
            for i, (end, digest) in furthest(spark, groups, open_).items():
                reached[i] = end
                cuts[i].append((end, digest))
    return list(zip(reached, cuts, strict=True))


def range_capacity(groups: Ordered, shards: int, least: int) -> int:
    """A capacity that is enough: the best one if whole ranges were the groups, found on the driver's totals."""
    sizes = [b - a for a, b in zip(groups.starts, groups.starts[1:], strict=False)]

    def fits(capacity: int) -> bool:
        used, room = 1, capacity
        for size in sizes:
            if size > capacity:
                return False
            if size > room:
                used, room = used + 1, capacity
            room -= size
        return used <= shards

    low, high = max(least, 1), max(groups.total, 1)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


def minimax_cuts(spark: SparkSession, groups: Ordered, shards: int) -> list[str]:
    """The digests that end a shard (all but the last), at the smallest capacity that is enough."""
    if not groups.total:
        return []
    low = max(-(-groups.total // shards), groups.heaviest)
    high = max(low, min(range_capacity(groups, shards, low), low + groups.heaviest))
    while low < high:
        step = max(1, (high - low) // (TRIES + 1))
        tried = list(range(low, high, step))[:TRIES + 1]
        enough = [end >= groups.total for end, _ in greedy(spark, groups, tried, shards)]
        first = enough.index(True) if True in enough else len(tried)
        low, high = (tried[first - 1] + 1 if first else low), (tried[first] if first < len(tried) else high)
    cuts = greedy(spark, groups, [low], shards)[0][1]
    lost = [end for end, digest in cuts if digest is None]
    if lost:  # the cut is the end of a range: its last digest
        last = groups.placed.groupBy("range").agg(F.max("digest").alias("digest")).collect()
        ends = {groups.starts[r["range"] + 1]: r["digest"] for r in last}
        cuts = [(end, digest or ends[end]) for end, digest in cuts]
    return [digest for _, digest in cuts]


def shard_of(digest: Column, cuts: list[str]) -> Column:
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (digest > F.lit(cut)).cast("int")
    return shard.cast("int")


def minimax_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, digest, shard and slot of every row: equal texts in one shard, the heaviest shard
    as light as contiguous cuts allow, slots gapless from 0 in each shard."""
    spark = docs.sparkSession
    rows = stored(sized(docs, id_col, text_col), "shard-rows")
    cuts = minimax_cuts(spark, ordered_groups(rows), shards)
    placed = rows.withColumn("shard", shard_of(F.col("digest"), cuts))
    pieces = max(32, rows.count() // (shards * ROWS_PER_PART))
    spread = F.struct(F.col("doc_id").cast("string"), "digest")
    return numbered(placed, "shard", [F.col("doc_id"), F.col("digest")], spread, pieces, "slot")


@query("op10_minimax_sharding")
def op10_minimax_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return minimax_shards(table(spark, folder, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
