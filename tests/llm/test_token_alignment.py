"""Alignment of two tokenizers against plain loops over the installed libraries."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from kanaat.llm import byte_pair
from kanaat.llm import token_alignment as A
from kanaat.llm.batches import chunks
from kanaat.llm.pretokens import tokenizer_path

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [None, "", " ", "  two  blanks ", "a\tb\n", "é½ 中文 👩‍👩‍👧", "<|endoftext|> <s> </s> <0x0A>", "▁x a▁b", "\x00x", "x" * 500, "don't we'll 's",
       " 　 y", "ends ", "a", "1234567 89"]


def tools():
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(tokenizer_path())
    first.no_truncation()
    first.no_padding()
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(A.PIECE_FILE))


def plain(rows):
    first, second = tools()
    letters = byte_pair.byte_letters()
    docs = []
    for _, text in rows:
        text = text or ""
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        bytes_a = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(second.id_to_piece(i)[3:-1], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = (" " + text).encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            docs.append(([], [], []))
            continue
        ends = [set(np.cumsum([len(x) for x in side]).tolist()) for side in (bytes_a, bytes_b)]
        groups, at, i, j = [], 0, 0, 0
        for end in sorted(ends[0] & ends[1]):
            group, pos = ([], []), at
            while pos < end:
                group[0].append(a[i])
                pos += len(bytes_a[i])
                i += 1
            pos = at
            while pos < end:
                group[1].append(b[j])
                pos += len(bytes_b[j])
                j += 1
            groups.append(group)
            at = end
        docs.append((a, b, groups))
    count = Counter()
    for _, _, groups in docs:
        count.update({(x, y) for g in groups for x in g[0] for y in g[1]})
    highest = {}
    for (x, _), n in count.items():
        highest[x] = max(highest.get(x, 0), n)
    out = []
    for (doc, _), (a, b, groups) in zip(rows, docs):
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        written = ";".join(",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups)
        out.append((doc, len(a), len(b), len(groups), len(links), sum(count[p] == highest[p[0]] for p in links), sum(count[p] for p in links),
                    hashlib.sha256(written.encode()).hexdigest() if written else ""))
    return sorted(out, key=str)


def random_texts(n, seed=4):
    pick = random.Random(seed)
    parts = ["the", " ", " ", "  ", "ing", "é", "中", "12", "!", "\n", "Ab", "quality", "tion", "▁", "<s>", "zq", "'s"]
    return ["".join(pick.choice(parts) for _ in range(pick.randrange(40))) for _ in range(n)]


def test_equals_plain_loops(spark):
    rows = [(i, t) for i, t in enumerate(ODD + random_texts(400))] + [(None, "the same"), (7, "the same"), (7, "the same")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, chunk int").repartition(5)
    got = A.aligned(docs).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows)


def test_several_rounds_and_small_blocks(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(random_texts(120, 6))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(24)
    monkeypatch.setattr(A, "FAN_IN", 3)
    assert sorted(map(tuple, A.aligned(docs).select(*COLUMNS).collect()), key=str) == plain(rows)


def test_empty_table_and_no_tokens(spark):
    docs = spark.createDataFrame([("x", None), ("y", "▁")], "doc_id string, text string")
    assert sorted(map(tuple, A.aligned(docs).select(*COLUMNS).collect())) == [("x", 0, 0, 0, 0, 0, 0, ""), ("y", 0, 0, 0, 0, 0, 0, "")]
    assert A.aligned(docs.limit(0)).count() == 0


@pytest.mark.parametrize("block", [1, 3, 8192])
def test_heap_merge(monkeypatch, block):
    monkeypatch.setattr(A, "BLOCK", block)
    pick, total, streams = random.Random(block), Counter(), []
    for _ in range(20):
        own = {pick.randrange(60): pick.randrange(1, 9) for _ in range(pick.randrange(40))}
        total.update(own)
        streams.append((np.array(sorted(own), np.int64), np.array([own[k] for k in sorted(own)], np.int64)))
    key, count = A.merged(streams)
    assert dict(zip(key.tolist(), count.tolist())) == total and key.tolist() == sorted(total)


def test_a_long_group_is_spread_in_blocks(monkeypatch):
    text = "".join(random.Random(2).choice("qxzjkw") for _ in range(3000))
    piece = next(chunks(pa.array([text, "of the"])), None)
    expected = [x.tolist() for x in A.Aligned(piece, tokenizer_path(), tokenizer_path(A.PIECE_FILE)).pairs()]
    monkeypatch.setattr(A, "LINKS", 7)
    found = A.Aligned(piece, tokenizer_path(), tokenizer_path(A.PIECE_FILE))
    assert [x.tolist() for x in found.pairs()] == expected
    assert found.n_links.sum() == sum(expected[2])


def test_columns_go_both_ways():
    columns = [np.array([3, -1, 2**40]), np.zeros(0, np.int64), np.array([5])]
    assert [c.tolist() for c in A.spread_out(A.squeezed(*columns))] == [c.tolist() for c in columns]


def test_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, A.op13_token_alignment(spark, small).collect()), key=str) == plain(rows)
