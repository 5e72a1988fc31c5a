"""Order-dependent results over few, very large groups.

A window over (category, label) would put a whole class into one task. Here each group is cut into
buckets that keep the order; only per-bucket totals are accumulated across the group, and rows are
sorted within their own bucket. A random order is cut by the leading digits of its hash, a numeric
one at approximate quantiles. Group and order columns must not be null.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kanaat.functions.fixed_values import SEED
from kanaat.functions.keys import shuffle_key
from kanaat.session import small_side

HASH_DIGITS = 4
ROWS_PER_BUCKET = 1_000_000


def hash_bucket(key: str) -> Column:
    return F.conv(F.substring(key, 1, HASH_DIGITS), 16, 10).cast("int")


def with_hash_order(df: DataFrame, identity: str, seed: int = SEED) -> DataFrame:
    return df.withColumn("_key", shuffle_key(F.col(identity), seed)).withColumn("_bucket", hash_bucket("_key"))


def with_order_bucket(df: DataFrame, order: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add ``_bucket``, rising with the numeric column ``order``. As many buckets as the rows need, so that none
    grows with the table; the column is read for its count and for its quantiles."""
    value = F.col(order).cast("double")
    buckets = max(2, -(-df.count() // rows_per_bucket))
    shares = [i / buckets for i in range(1, buckets)]
    cuts = df.agg(F.percentile_approx(value, shares, F.lit(max(10_000, 10 * buckets)))).first()[0]
    inner = sorted(set(cuts)) if cuts else [0.0]
    splits = [float("-inf"), *inner, float("inf")]
    placed = Bucketizer(splits=splits, inputCol="_order", outputCol="_slot", handleInvalid="keep").transform(
        df.withColumn("_order", value)
    )
    return placed.withColumn("_bucket", F.col("_slot").cast("int")).drop("_order", "_slot")


def _through(groups: list[str], from_row: int, to_row: int):
    partition = groups or [F.lit(0)]
    return Window.partitionBy(*partition).orderBy("_bucket").rowsBetween(from_row, to_row)


def running(
    df: DataFrame,
    groups: list[str],
    order: list[str],
    sums: dict[str, Column] | None = None,
    maxima: dict[str, Column] | None = None,
    previous: dict[str, Column] | None = None,
) -> DataFrame:
    """Running sums, running maxima and values of the row before, per group; df carries ``_bucket``."""
    sums, maxima, previous = sums or {}, maxima or {}, previous or {}
    keys = [*groups, "_bucket"]
    ordered = df.select("*", *[c.alias(f"_in_{n}") for n, c in {**sums, **maxima, **previous}.items()])
    place = F.struct(*order)
    totals = ordered.groupBy(*keys).agg(
        *[F.sum(f"_in_{n}").alias(f"_t_{n}") for n in sums],
        *[F.max(f"_in_{n}").alias(f"_t_{n}") for n in maxima],
        *[F.max_by(F.struct(F.col(f"_in_{n}").alias("v")), place).alias(f"_t_{n}") for n in previous],
    )
    earlier = _through(groups, Window.unboundedPreceding, -1)
    carry = totals.select(
        *keys,
        *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_c_{n}") for n in sums],
        *[F.max(f"_t_{n}").over(earlier).alias(f"_c_{n}") for n in maxima],
        *[F.last(f"_t_{n}").over(earlier).alias(f"_c_{n}") for n in previous],
    )
    within = Window.partitionBy(*keys).orderBy(*order)
    to_here = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first_here = F.row_number().over(within) == 1
    return ordered.join(carry, keys).select(
        *df.columns,
        *[(F.coalesce(F.sum(f"_in_{n}").over(to_here), F.lit(0)) + F.col(f"_c_{n}")).alias(n) for n in sums],
        *[F.greatest(F.max(f"_in_{n}").over(to_here), F.col(f"_c_{n}")).alias(n) for n in maxima],
        *[
            F.when(first_here, F.col(f"_c_{n}.v")).otherwise(F.lag(f"_in_{n}").over(within)).alias(n)
            for n in previous
        ],
    )


def hash_rank(df: DataFrame, groups: list[str], identity: str, seed: int = SEED) -> DataFrame:
    """Position ``rank`` (from 1) of each row in its group's repeatable random order."""
    ranked = running(with_hash_order(df, identity, seed), groups, ["_key", identity], sums={"rank": F.lit(1)})
    return ranked.drop("_key", "_bucket")


def order_rank(df: DataFrame, groups: list[str], order: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Position ``rank`` (from 1) of each row in its group by a unique numeric column."""
    placed = with_order_bucket(df, order, rows_per_bucket)
    return running(placed, groups, [order], sums={"rank": F.lit(1)}).drop("_bucket")


def _bucket_counts(placed: DataFrame, groups: list[str]) -> DataFrame:
    whole = _through(groups, Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = _through(groups, Window.unboundedPreceding, -1)
    return placed.groupBy(*groups, "_bucket").agg(F.count(F.lit(1)).alias("_n")).select(
        *groups,
        "_bucket",
        "_n",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(whole).alias("_total"),
    )


def first_placed(placed: DataFrame, groups: list[str], order: list[str], limit: Column) -> DataFrame:
    """The first ``limit`` rows of each group in a bucketed order, with ``rank``. Buckets behind the
    limit drop out before any row is moved. ``limit`` may use the group columns and ``_total``."""
    wanted = _bucket_counts(placed, groups).where(F.col("_before") < limit).select(
        *groups, "_bucket", "_before", limit.cast("long").alias("_limit")
    )
    within = Window.partitionBy(*groups, "_bucket").orderBy(*order)
    return (
        placed.join(small_side(wanted), [*groups, "_bucket"])
        .withColumn("rank", F.row_number().over(within) + F.col("_before"))
        .where(F.col("rank") <= F.col("_limit"))
        .drop("_before", "_limit")
    )


def first_by_hash(df: DataFrame, groups: list[str], identity: str, limit: Column, seed: int = SEED) -> DataFrame:
    placed = with_hash_order(df, identity, seed)
    return first_placed(placed, groups, ["_key", identity], limit).drop("_key", "_bucket")


def first_by_order(df: DataFrame, groups: list[str], order: str, limit: Column) -> DataFrame:
    return first_placed(with_order_bucket(df, order), groups, [order], limit).drop("_bucket")


def split_by_hash(
    df: DataFrame, groups: list[str], identity: str, limit: Column, name: str, seed: int = SEED
) -> DataFrame:
    """Add the boolean ``name``: among the first ``limit`` rows of the group in random order.

    One bucket per group holds the cut; only its rows are ranked, all others are decided by their
    bucket number alone, so no row outside the cut is shuffled."""
    placed = with_hash_order(df, identity, seed)
    cut = _bucket_counts(placed, groups).where(
        (F.col("_before") <= limit) & (limit < F.col("_before") + F.col("_n"))
    ).select(*groups, F.col("_bucket").alias("_cut"), (limit - F.col("_before")).alias("_more"))
    judged = placed.join(small_side(cut), groups, "left")
    plain = judged.where(F.col("_cut").isNull() | (F.col("_bucket") != F.col("_cut"))).select(
        *df.columns, F.coalesce(F.col("_bucket") < F.col("_cut"), F.lit(True)).alias(name)
    )
    within = Window.partitionBy(*groups).orderBy("_key", identity)
    at_cut = judged.where(F.col("_bucket") == F.col("_cut")).select(
        *df.columns, (F.row_number().over(within) <= F.col("_more")).alias(name)
    )
    return plain.unionByName(at_cut)
