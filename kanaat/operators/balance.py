"""Raise the smaller class to the size of the larger one with synthetic points between neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kanaat.functions.fixed_values import NEIGHBOURS, SEED
from kanaat.operators.neighbours import knn_join
from kanaat.operators.ranking import hash_rank

SPAN = 1 << 60


def _draw(name: str, seed: int) -> Column:
    """A repeatable number in [0, 2^60), wide enough for any class for each synthetic row and purpose."""
    digest = F.md5(F.concat(F.lit(f"{seed}|{name}|"), F.col("n").cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def oversample(rows: DataFrame, k: int = NEIGHBOURS, seed: int = SEED) -> tuple[DataFrame, bool]:
    """rows: (id long, label 0/1, vector array<double>). Gives them plus synthetic rows (negative ids),
    and whether that was possible: a class of k rows or fewer, or a single class, stays as it is."""
    sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    original = rows.select("id", "label", "vector", F.lit(0).alias("synthetic"))
    if len(sizes) < 2 or min(sizes.values()) <= k:
        return original, False
    small = min(sizes, key=lambda v: (sizes[v], v))
    few, deficit = sizes[small], max(sizes.values()) - sizes[small]
    if deficit == 0:
        return original, True
    minority = rows.where(F.col("label") == small).select("id", F.lit(0).alias("grp"), "vector")
    found = knn_join(minority, minority, k, skip_self=True)
    near = found.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "neighbour_id"))).alias("near"))
    numbered = hash_rank(minority, [], "id", seed).select(
        F.col("id").alias("query_id"), (F.col("rank") - 1).alias("slot"), F.col("vector").alias("x")
    )
    bases = numbered.join(near, "query_id")
    draws = rows.sparkSession.range(deficit).withColumnRenamed("id", "n").select(
        "n",
        (_draw("base", seed) % few).alias("slot"),
        (_draw("neighbour", seed) % k + 1).cast("int").alias("pick"),
        (_draw("step", seed) / F.lit(float(SPAN))).alias("u"),
    )
    chosen = draws.join(bases, "slot").select(
        "n", "x", "u", F.element_at("near", F.col("pick")).getField("neighbour_id").alias("id")
    )
    made = chosen.join(minority.select("id", F.col("vector").alias("y")), "id").select(
        (-F.col("n") - 1).alias("id"),
        F.lit(small).cast(rows.schema["label"].dataType).alias("label"),
        F.expr("zip_with(x, y, (a, b) -> a + u * (b - a))").alias("vector"),
        F.lit(1).alias("synthetic"),
    )
    return original.unionByName(made), True
