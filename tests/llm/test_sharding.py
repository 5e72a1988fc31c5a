"""Shards against an exact search on the driver."""

import zlib

import pytest
from pyspark.sql import types as T

from kanaat.llm import sharding

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("shard", T.StringType()), T.StructField("digest", T.StringType())])


def least_capacity(sizes, shards):
    low, high = max(max(sizes), -(-sum(sizes) // shards)), sum(sizes)
    while low < high:
        middle, used, room = (low + high) // 2, 1, (low + high) // 2
        for size in sizes:
            if size > room:
                used, room = used + 1, middle
            room -= size
        low, high = (low, middle) if used <= shards else (middle + 1, high)
    return low


@pytest.mark.parametrize("texts", [
    [], [None], ["a", "a", None, ""], ["é" * (i % 37) + str(i % 50) for i in range(300)],
    ["hot"] * 150 + ["x" * i for i in range(150)] + ["long" * 5000]], ids=["none", "null", "few", "many", "hot"])
def test_shards_are_minimax_and_gapless(spark, texts):
    docs = spark.createDataFrame([(i // 2, t, "s", "d") for i, t in enumerate(texts)], SCHEMA)
    rows = sharding.minimax_shards(docs, 8).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == sorted(
        (i // 2, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in enumerate(texts))
    for s in {r.shard for r in rows}:
        assert 0 <= s < 8
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    groups = {}
    for r in rows:
        groups.setdefault(r.digest, []).append(r)
    assert all(len({r.shard for r in g}) == 1 for g in groups.values())
    if rows:
        sizes = [sum(r.size for r in groups[d]) for d in sorted(groups)]
        heaviest = max(sum(r.size for r in rows if r.shard == s) for s in range(8))
        assert heaviest == least_capacity(sizes, 8)
