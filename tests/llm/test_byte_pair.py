"""The trie walk and the split into pieces against the installed library."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from kanaat.llm import byte_pair, token_ids
from kanaat.llm.batches import chunks
from kanaat.llm.pretokens import loaded, pieces, tokenizer_path

PATH = tokenizer_path()
SPECIAL = ["", " ", "  ", "\n", "a\n\nb", "  a", " \n a", "a  ", "don't I'll we've '' 's ''s x'S 'se 'revolt", "'", "x '", "a'", "it's's",
           "<|endoftext|>", "a<|endoftext|> b<|endoftext|>", "é ß 中文字 ¹²³ ½ 1234567890   x ‍ 👩‍👩‍👧 \U0001d7d8",
           "a" * 3000, "\t \t", "!!!'s", " 's", "\x85\x1c a", "'re'ROOM", "'l", "'v e", "́à", "﻿x"]


def random_texts(n, seed=5):
    pick = random.Random(seed)
    parts = ["th", "e", " ", "  ", "\n", "'s", "'", "re", "ll", "é", "中", "12", "!", "ing", "Ab", " ", "tion", "'ve", "𝟘", "ı", "_"]
    return ["".join(pick.choice(parts) for _ in range(pick.randrange(30))) for _ in range(n)]


@pytest.mark.parametrize("way", ["trie", "library"])
def test_ids_equal_the_library(way):
    texts = SPECIAL + random_texts(1500)
    expected = [e.ids for e in loaded(PATH).encode_batch(texts, add_special_tokens=False)]
    got = []
    for most in (64, 1 << 20):
        got = []
        for part in chunks(pa.array([*texts, None]), most):
            ids, counts = byte_pair.encode_texts(part, PATH) if way == "trie" else token_ids.encoded(part, PATH)
            got += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        assert got == [*expected, []]


def test_pieces_equal_the_library():
    for text in SPECIAL + random_texts(800, 9):
        part = next(chunks(pa.array([text])), None)
        start, end, _ = pieces(part, PATH)
        raw = text.encode()
        expected = [text[a:b].encode() for _, (a, b) in loaded(PATH).pre_tokenizer.pre_tokenize_str(text)]
        assert [raw[a:b] for a, b in zip(start, end)] == expected, text


def test_words_of_random_bytes_match_plain_merging():
    vocabulary, pick = byte_pair.vocabulary(PATH), random.Random(3)
    words = [bytes(pick.choice(b"aeinorst hzz..\xc3\xa9") for _ in range(pick.randrange(1, 14))) for _ in range(2000)]
    assert vocabulary.walk(words) == [vocabulary.by_rank(w) for w in words]


def test_query(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = byte_pair.op8_trie_bpe(spark, small).collect()
    assert len(rows) == len(texts)
    tokenizer = loaded(PATH)
    for r in rows:
        ids = tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_operator_keeps_nulls_and_repeats(spark):
    docs = spark.createDataFrame([(1, None, 3), (1, "ab", 3), (None, "ab", 3)], "doc_id long, text string, ids int")
    rows = byte_pair.decode(byte_pair.encode(docs)).collect()
    assert sorted((r.doc_id or 0, r.text) for r in rows) == [(0, "ab"), (1, ""), (1, "ab")]
    assert byte_pair.decode(byte_pair.encode(docs.limit(0))).count() == 0
