"""Order-dependent operators against plain loops, with a group that holds most rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from kanaat.operators import ranking, sampling, sequences, tables


def labelled(spark, seed=1, n=400):
    rng = random.Random(seed)
    rows = [
        (i, "hot" if rng.random() < 0.7 else rng.choice(["b", "c"]), int(rng.random() < 0.3)) for i in range(n)
    ]
    return rows, spark.createDataFrame(rows, "comment_id long, category string, label int")


def key(i, seed=42):
    return hashlib.md5(f"{seed}|{i}".encode()).hexdigest()


def walk(rows, category, order):
    return sorted((r for r in rows if r[1] == category), key=order)


def quota_loop(rows, positive, negative):
    """The labelling walk, step by step."""
    kept, examined, p, n = [], 0, 0, 0
    for i, _, label in rows:
        if p >= positive and n >= negative:
            break
        examined += 1
        if label == 1 and p < positive:
            kept.append(i)
            p += 1
        elif label == 0 and n < negative:
            kept.append(i)
            n += 1
    return kept, examined, p, n


@pytest.mark.parametrize("targets", [(2, 2), (0, 3), (5, 1), (1000, 4), (0, 0)])
def test_quota_sample_and_examined(spark, targets):
    rows, df = labelled(spark)
    sample = {(r.category, r.comment_id) for r in sampling.quota_sample(df, *targets).collect()}
    ordered = {(r.category, r.comment_id) for r in sampling.quota_sample(df, *targets, mode="positive_only").collect()}
    examined = {r.category: r for r in sampling.examined_rows(df, *targets).collect()}
    for category in ("hot", "b", "c"):
        kept, seen, p, n = quota_loop(walk(rows, category, lambda r: (key(r[0]), r[0])), *targets)
        assert {i for c, i in sample if c == category} == set(kept)
        in_order, _, _, _ = quota_loop(walk(rows, category, lambda r: r[0]), *targets)
        assert {i for c, i in ordered if c == category} == set(in_order)
        if targets != (0, 0):
            assert examined[category].examined == seen
            assert (examined[category].found_positive, examined[category].found_negative) == (p, n)


def test_quota_example(spark):
    rows = [(i, "c", y) for i, y in enumerate([1, 1, 1, 0, 1, 0, 0], 1)]
    df = spark.createDataFrame(rows, "comment_id long, category string, label int")
    kept = sampling.quota_sample(df, 2, 2, mode="positive_only")
    assert sorted(r.comment_id for r in kept.collect()) == [1, 2, 4, 6]
    assert sampling.quota_sample(df, 2, 2, mode="all_comments").count() == 7


@pytest.mark.parametrize("size, expected", [(0, 0), (39, 39), (40, 40), (41, 40)])
def test_class_cap(spark, size, expected):
    rows = [(i, "c", 1) for i in range(size)] + [(1000, "c", 0)]
    df = spark.createDataFrame(rows, "comment_id long, category string, label int")
    marked = sampling.capped_class_sample(df, 40).where("label = 1")
    assert marked.where("in_sample").count() == expected
    assert marked.where("not in_sample").count() == size - expected


def test_split_is_complete_disjoint_and_sized(spark):
    rows, df = labelled(spark)
    got = sampling.stratified_split(df, 0.3).collect()
    assert sorted((r.comment_id, r.category, r.label) for r in got) == sorted(rows)
    for category in ("hot", "b", "c"):
        for label in (0, 1):
            part = [r for r in got if r.category == category and r.label == label]
            assert sum(r.is_test for r in part) == int(len(part) * 0.3 + 0.5)


def test_folds_differ_by_one(spark):
    _, df = labelled(spark)
    sizes = sampling.stratified_folds(df, 7).groupBy("category", "label", "fold").count().collect()
    for category in ("hot", "b", "c"):
        for label in (0, 1):
            counts = [r["count"] for r in sizes if (r.category, r.label) == (category, label)]
            assert max(counts) - min(counts) <= 1 or len(counts) < 7


def test_order_rank_over_many_buckets(spark):
    values = random.Random(3).sample(range(10**12), 500)
    df = spark.createDataFrame([(v, "hot" if v % 3 else "cold") for v in values], "v long, g string")
    got = {r.v: r["rank"] for r in ranking.order_rank(df, ["g"], "v", rows_per_bucket=20).collect()}
    for group in (0, 1):
        mine = sorted(v for v in values if bool(v % 3) == bool(group))
        assert [got[v] for v in mine] == list(range(1, len(mine) + 1))


def test_running_previous_over_many_buckets(spark):
    df = spark.createDataFrame([(i, i * i % 7) for i in range(300)], "i long, x int")
    placed = ranking.with_order_bucket(df, "i", rows_per_bucket=11)
    assert placed.select("_bucket").distinct().count() > 20
    got = ranking.running(
        placed, [], ["i"], sums={"s": F.col("x")}, maxima={"m": F.when(F.col("x") > 3, F.col("i"))}, previous={"p": F.col("x")}
    ).orderBy("i").collect()
    total, last = 0, None
    for r in got:
        total += r.x
        last = r.i if r.x > 3 else last
        assert (r.s, r.m, r.p) == (total, last, None if r.i == 0 else (r.i - 1) ** 2 % 7)


def test_stagnation_example(spark):
    df = spark.createDataFrame([("w", i, v) for i, v in enumerate([5, 9, 9, 9, 9, 9, 9])], "w string, i long, n int")
    got = sequences.stagnation(df, "w", "i", "n").orderBy("i").collect()
    assert [r.unchanged for r in got] == [0, 0, 1, 2, 3, 4, 5]
    assert [r.finished for r in got] == [0, 0, 0, 0, 0, 0, 1]


def test_pages_until_failure_example(spark):
    df = spark.createDataFrame([("t", 1, False), ("t", 2, False), ("t", 3, True), ("t", 4, False), ("u", 1, True), ("v", 1, False)],
                               "topic string, page int, bad boolean")
    got = sequences.until_first_failure(df, "topic", "page", F.col("bad")).select("topic", "page").collect()
    assert sorted(tuple(r) for r in got) == [("t", 1), ("t", 2), ("v", 1)]


def test_keep_first_with_hot_key(spark):
    rows = [(i, "same" if i % 3 else f"t{i}", None if i % 5 else "d") for i in range(300)]
    df = spark.createDataFrame(rows, "id long, text string, date string")
    got = tables.keep_first(df, [F.col("date"), F.col("text")], "id").collect()
    first = {}
    for i, t, d in rows:
        first.setdefault((d, t), i)
    assert sorted(r.id for r in got) == sorted(first.values())


def test_tables(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, lang string")
    assert tables.with_default(df, "lang", "?").where("lang is null").count() == 1
    assert tables.with_default(df, "Tarih", "Tarih Yok").where("Tarih = 'Tarih Yok'").count() == 2
    assert tables.category_columns(df, ["id"]) == ["lang"]
    with pytest.raises(tables.MissingColumns):
        tables.require(df, ["Yorum"])
    assert tables.usable([df], ["Yorum"]) == []
    assert tables.not_empty([df, df.where("false")]) == [df]
    joined = tables.union_all([df, df.select("id")])
    assert joined.columns == ["id", "lang"] and joined.count() == 4
