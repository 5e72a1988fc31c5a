"""Packing: whole, gapless, near the lower bound; the genetic steps on small cases."""

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kanaat.llm import grouping, packing
from kanaat.llm.pretokens import loaded, tokenizer_path


def solution_is_whole(sizes, capacity, of):
    fill = np.bincount(of, sizes)
    return len(of) == len(sizes) and (fill <= capacity).all() and (fill > 0).all()


def test_crossover_keeps_every_item_once():
    pick = random.Random(4)
    sizes = [pick.randrange(1, 90) for _ in range(300)]
    a = grouping.packed(sizes, 100, sizes)
    b = grouping.packed(sizes, 100, [pick.random() for _ in sizes])
    for _ in range(20):
        for child in (grouping.crossover(a, b, pick), grouping.shaken(a, pick)):
            assert sorted(i for items in child.bins for i in items) == list(range(300))
            assert solution_is_whole(sizes, 100, np.array(grouping.labels(child)))
            assert child.room == [100 - sum(sizes[i] for i in items) for items in child.bins]


def test_evolution_beats_best_fit():
    # Triples that fill a bin exactly, on which best fit decreasing leaves room.
    pick, sizes = random.Random(8), []
    for _ in range(40):
        a, b = pick.randrange(380, 490), pick.randrange(250, 300)
        sizes += [a, b, 1000 - a - b]
    first = len(grouping.packed(sizes, 1000, sizes).bins)
    best = grouping.evolved(sizes, 1000, [], 1, 400, 8)[0]
    assert solution_is_whole(sizes, 1000, np.array(best))
    assert max(best) + 1 < first


def check(rows, texts):
    tokenizer = loaded(tokenizer_path())
    expected = []
    for doc_id, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        start = 0
        for piece in range(-(-len(ids) // 2048)):
            length = (len(ids) - 1) % 2048 + 1 if piece == 0 else 2048
            expected.append((doc_id, piece, start, length, zlib.crc32(ids[start:start + length].tobytes())))
            start += length
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted([tuple(r[:5]) for r in rows], key=key) == sorted(expected, key=key)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(sequences), -(-sum(r.length for r in rows) // 2048)


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = packing.op1_grouping_genetic_packing(spark, folder).collect()
    used, least = check(rows, [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()])
    assert used <= least + 1


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_ITEMS", 50)
    pick = random.Random(1)
    pieces = spark.createDataFrame([(i, pick.randrange(1, 1500)) for i in range(900)], "doc_id long, length long")
    out = packing.packed(packing.stored(pieces, "test"), 2048).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert max(r.n for r in out) <= 2048
    assert len(out) <= -(-sum(r.n for r in out) // 2048) * 1.02 + 1


def test_odd_rows(spark):
    texts = [(None, None), (1, ""), (1, ""), (1, "a b"), (2, "word " * 5000)]
    docs = spark.createDataFrame([(i, t, 5) for i, t in texts], "doc_id long, text string, offset int")
    rows = packing.packed_sequences(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset").collect()
    check(rows, texts)
    assert packing.packed_sequences(docs.limit(0)).count() == 0


def test_texts_are_encoded_in_small_chunks(spark, monkeypatch):
    """What a worker holds at once is set by the chunk, not by the rows that Arrow sends."""
    docs, seen, real = spark.createDataFrame([(0, "x")], "doc_id long, text string"), [], packing.encoded
    monkeypatch.setattr(packing, "encoded", lambda texts, path: (seen.append(len(texts.data)), real(texts, path))[1])
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: run)
    batch = pa.RecordBatch.from_arrays([pa.array(range(900)), pa.array(["ab cd " * 170] * 900)], ["doc_id", "text"])
    rows = sum(out.num_rows for out in packing.token_pieces(docs)(iter([batch])))
    assert rows == 900 and max(seen) <= 1 << 18
