"""Exact round trips, damage, and the query against the library."""

import random
import zlib

import numpy as np
import pytest

from kanaat.llm import range_coder, token_files, token_ids
from kanaat.llm.pretokens import loaded, tokenizer_path


def samples():
    pick = np.random.default_rng(6)
    common = pick.zipf(1.3, 40_000) % 50_257
    yield np.zeros(0, np.uint32)
    yield np.array([50_256], np.uint32)
    yield np.array([2 ** 20 - 2, 0, 2 ** 20], np.uint32)
    yield np.zeros(9_000, np.uint32)
    yield common.astype(np.uint32)
    yield pick.integers(0, 50_257, 20_000).astype(np.uint32)
    yield np.tile(common[:60], 1000).astype(np.uint32)
    yield np.concatenate([common[:5000], common[:5000], np.arange(50_257)]).astype(np.uint32)


def test_round_trip_and_single_blocks(monkeypatch):
    monkeypatch.setattr(range_coder, "LANES", 5)
    for ids in samples():
        frame = range_coder.encode_frame(ids, b"more")
        assert (range_coder.decode_frame(frame) == ids).all()
        head = range_coder.frame_head(frame)
        assert head["extra"] == b"more"
        for b in {0, head["blocks"] - 1} if head["blocks"] else ():
            assert (range_coder.decode_frame(frame, [b]) == ids[head["block"] * b:head["block"] * (b + 1)]).all()


def test_repetition_costs_little():
    ids = next(s for i, s in enumerate(samples()) if i == 6)
    assert len(range_coder.encode_frame(ids)) < len(ids) // 2


def test_damage_is_noticed():
    frame = bytearray(range_coder.encode_frame(next(s for i, s in enumerate(samples()) if i == 4)))
    for at in (2, 40, len(frame) - 900, len(frame) // 2):
        bad = frame.copy()
        bad[at] ^= 0x5A
        with pytest.raises(range_coder.Checksum):
            range_coder.decode_frame(bytes(bad))


def test_joined_checksums():
    raw = random.Random(1).randbytes(1000)
    for cut in (0, 1, 500, 1000):
        assert token_files.joined_crc32(zlib.crc32(raw[:cut]), zlib.crc32(raw[cut:]), 1000 - cut) == zlib.crc32(raw)


def check(rows, docs):
    tokenizer, start = loaded(tokenizer_path()), 0
    assert len(rows) == len(docs)
    by_start = sorted(rows, key=lambda r: r.start)
    assert [r.doc_id for r in by_start] == sorted((d for d, _ in docs), key=lambda d: (d is not None, d or 0))
    texts = {}
    for d, t in docs:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        texts.setdefault(d, []).append((len(ids), zlib.crc32(ids.tobytes())))
    for r in by_start:
        assert r.start == start
        texts[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        start += r.n_tokens


def test_query(spark, small):
    check(token_files.op7_context_mixing_files(spark, small).collect(),
          [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()])


@pytest.mark.parametrize("rows", [[], [(5, None), (None, "x"), (5, ""), (2, "word " * 3000), (2, "a\n" * 900), (7, "b"), (7, "b")]])
def test_odd_rows_and_documents_across_frames(spark, tmp_path, monkeypatch, rows):
    monkeypatch.setattr(token_files, "FRAME_IDS", 700)
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, start int")
    path = str(tmp_path / "files")
    token_files.write(docs, path)
    check(token_files.counted(spark, path).collect(), rows)
    ids = [i for r in sorted(token_files.read(spark, path).collect(), key=lambda r: (r.part, r.frame, r.number)) for i in r.ids]
    assert len(ids) == sum(r.n_tokens for r in token_files.counted(spark, path).collect())


def test_many_blocks_are_worked_on_together():
    """A full frame is decoded in at most 2048 steps, all lanes in each."""
    assert range_coder.BLOCK <= 2048 <= range_coder.LANES
    ids = (np.random.default_rng(1).zipf(1.2, 300_000) % 50_257).astype(np.uint32)
    head = range_coder.frame_head(range_coder.encode_frame(ids))
    assert head["block"] == 512 and head["blocks"] == -(-len(ids) // 512)


def test_kept_encodings_are_found_when_the_table_grows():
    pick, kept, seen = np.random.default_rng(2), token_ids.Kept(), {}
    for step in range(6):
        # The same low bits: many pieces want one place.
        hashes = np.unique(pick.integers(1, 1 << 40, 9000).astype(np.uint64) << np.uint64(8 * (step % 3)))
        new = hashes[kept.numbers(hashes) < 0]
        assert {int(h) for h in hashes} - {int(h) for h in new} == {int(h) for h in hashes} & seen.keys()
        counts = pick.integers(1, 4, len(new))
        ids = pick.integers(0, 50_257, int(counts.sum())).astype(np.uint32)
        kept.add(new, ids, counts)
        seen |= {int(h): own.tolist() for h, own in zip(new, np.split(ids, np.cumsum(counts)[:-1]), strict=True)}
    hashes = np.array(list(seen), np.uint64)
    number = kept.numbers(hashes)
    assert all(kept.ids[kept.start[n]:kept.start[n] + kept.count[n]].tolist() == seen[int(h)] for h, n in zip(hashes, number, strict=True))
    assert (kept.numbers(hashes ^ np.uint64(1 << 63)) < 0).all()
