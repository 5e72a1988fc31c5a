"""Collocations against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from kanaat.llm import collocations as C


def plain(rows, least, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang or "und"] += len(words)
            for size in range(1, 6):
                f.update((lang or "und", *words[i:i + size]) for i in range(len(words) - size + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    inside = {(p[0], *p[i:j]) for p, a in candidates.items() for i in range(1, len(p)) for j in range(i + 2, len(p) + 1)
              if j - i < len(p) - 1 and 100 * a >= 100 * f[(p[0], *p[i:j])]}
    out = {}
    for p, a in candidates.items():
        if p not in inside:
            cuts = [(1000 * a * n[p[0]] // (f[p[:k]] * f[(p[0], *p[k:])]), k, f[p[:k]], f[(p[0], *p[k:])]) for k in range(2, len(p))]
            score, _, left, right = min(cuts)
            out.setdefault(p[0], []).append((-score, -a, " ".join(p[1:]).encode(), left, right, n[p[0]]))
    return sorted((lang, rank, phrase.decode(), -a, left, right, total, -score) for lang, found in out.items()
                  for rank, (score, a, phrase, left, right, total) in enumerate(sorted(found)[:top], 1))


def made(n, seed=3):
    pick = random.Random(seed)
    words = ["the", "The", "cat", "sat", "on", "mat.", "New", "york", "city", "é", "ÉA", "中", "x,y", "a", "b", "\t", "\n", "\x0b", "z!", "\x85", " "]
    texts = [" ".join(pick.choice(words) for _ in range(pick.choice([0, 2, 9, 60]))) for _ in range(n)]
    return [(t, pick.choice(["en", "en", "en", "de", None, "und"])) for t in texts] + [(None, "en"), ("", None), ("only", "fr")]


SCHEMA = "text string, lang string"


@pytest.mark.parametrize("least, ranges", [(3, 10**9), (3, 200), (12, 50)])
def test_equals_plain_counting(spark, least, ranges):
    rows = made(300)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = C.collocations(docs, least=least, range_records=ranges)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain(rows, least)


def test_a_hot_phrase_spans_ranges_and_top_is_kept(spark):
    rows = [("hot pair w%d x%d y%d" % (i % 7, i % 11, i % 13), "en") for i in range(3000)] + made(50)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert sorted(map(tuple, C.collocations(docs, least=20, top=30, range_records=100).collect())) == plain(rows, 20, 30)


def test_nothing_and_other_columns(spark):
    docs = spark.createDataFrame([("a b", "en", 1, "p")], "text string, lang string, n int, phrase string")
    assert [r.phrase for r in C.collocations(docs, least=1).collect()] == ["a b"]
    assert C.collocations(docs.limit(0)).count() == 0
    assert C.collocations(docs).count() == 0


def test_scores_beyond_64_bits(spark):
    row = spark.createDataFrame([(10**11, 10**14, 10**11 + 7, 3 * 10**11)], "f long, n long, l long, r long")
    assert row.selectExpr(f"{C.SCORE} as s").first().s == 1000 * 10**11 * 10**14 // ((10**11 + 7) * 3 * 10**11)


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(C, "CHUNK", 400)
    text = ". ".join("w%d v%d w%d" % (i % 5, i % 3, i % 2) for i in range(2000))
    batch = pa.RecordBatch.from_arrays([pa.array([text, "w1 v1"]), pa.array(["en", "de"])], ["text", "lang"])
    pieces = list(C.word_pieces([batch]))
    assert len(pieces) > 10 and sum(p.n for p in pieces) == 6002
    found = Counter()
    for p in pieces:
        names = list(zip(p.names["lang"].to_pylist(), p.names["word"].to_pylist()))
        for r in p.records(np.ones(len(names), bool)).tolist():
            found[tuple(names[x - 1][1].decode() for x in r if x)] += 1
    assert found[("w1", "v1")] == 1 and sum(c for p, c in found.items() if len(p) == 3) == 2000


def test_runs_go_both_ways():
    texts = next(C.chunks(pa.array(["a b c d e f a b. a b", "b a b"])), None)
    piece = C.Words(texts, pa.array(["en", "de"]))
    records = piece.records(np.ones(len(piece.names), bool))
    records, counts = C.combined(records, np.ones(len(records), np.int64))
    counts = counts + (1 << 33)
    back = C.merged([C.run_of(C.run_bytes(records, counts, piece.names))] * 2)
    assert back[0].to_pylist() == piece.names.to_pylist()
    assert back[1].tolist() == records.tolist() and back[2].tolist() == (2 * counts).tolist()
    large = C.packed(records, 1 << 22)
    assert np.lexsort(large[::-1]).tolist() == list(range(len(records)))


def test_query_equals_sql(spark, duck, small):
    from compare import difference, duck_result, spark_result

    assert difference(spark_result(C.op12_stream_collocations(spark, small)), duck_result(duck, C.SQL)) is None


def test_records_end_inside_rare_pairs_and_buckets_go_both_ways():
    texts = next(C.chunks(pa.array(["a b c. a b d", "a b"])), None)
    piece = C.Words(texts, pa.array(["en", "en"]))
    hashes, joined = C.place_hashes(texts, pa.array(["en", "en"]))
    assert (hashes == piece.hashes[piece.ids]).all() and (joined == piece.joined).all()
    known = C.buckets(hashes[:1], hashes[1:2])
    pairs = np.zeros(C.FILTER_BITS // C.WORD_BITS, np.uint32)
    pairs[known.astype(np.int64) % C.FILTER_BITS // C.WORD_BITS] = np.uint32(1) << (known.astype(np.int64) % C.WORD_BITS).astype(np.uint32)
    every = np.ones(len(piece.names), bool)
    # Only a b is frequent: of the five phrase starts (a, b, a, b, a) those with a are left, and no record is longer.
    assert len(piece.records(every)) == 5 and (piece.records(every, pairs) > 0).sum(axis=1).tolist() == [2, 2, 2]
    keys, counts = C.summed(np.array([7, 2**30 - 1, 7, 0], np.uint32), np.array([1, 2, 1 << 33, 4]))
    back = C.buckets_of(C.bucket_bytes(keys, counts))
    assert back[0].tolist() == [0, 7, 2**30 - 1] and back[1].tolist() == [4, (1 << 33) + 1, 2]


def test_pairs_are_dealt_by_bucket(spark, monkeypatch):
    monkeypatch.setattr(C, "PART_PAIRS", 500)
    monkeypatch.setattr(C, "HELD_PAIRS", 50)
    rows = made(300)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert sorted(map(tuple, C.collocations(docs, least=12, range_records=300).collect())) == plain(rows, 12)
