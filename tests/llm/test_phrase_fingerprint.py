"""Phrase parse, signatures and neighbours by id against plain loops."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from kanaat.llm import phrase_fingerprint as P
from kanaat.llm.batches import chunks

COLUMNS = "doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next".split(", ")


def plain_phrases(text: bytes) -> list[bytes]:
    seen, out, at = set(), [], 0
    while at < len(text):
        n = 1
        while at + n < len(text) and text[at:at + n] in seen:
            n += 1
        out.append(text[at:at + n])
        seen.add(text[at:at + n])
        at += n
    return out


def random_texts(n, seed=7):
    pick = random.Random(seed)
    parts = ["the ", "cat ", "sat", " on ", "é", "中文", "\n", "aaaa", "b", ".", "0123", "xyz "]
    return ["".join(pick.choice(parts) for _ in range(pick.choice([0, 1, 3, 40, 400]))) for _ in range(n)]


def plain_signature(text: str) -> list[int]:
    found = set()
    for phrase in plain_phrases(text.encode()):
        piece = np.frombuffer(phrase, np.uint8)
        found.add(int(P.span_hashes(piece, np.array([0]), np.array([len(piece)]))[0]) >> 32)
    return sorted(found)[:P.SIZE]


def plain_likeness(a: list[int], b: list[int]) -> float:
    union = sorted(set(a) | set(b))
    if max(len(a), len(b)) >= P.SIZE:
        union = union[:P.SIZE]
    return sum(x in set(a) and x in set(b) for x in union) / len(union) if union else 1.0


def test_phrases_are_those_of_a_plain_parse():
    for text in ["", "a", "aaaaaaaaaa", "ab" * 400, *random_texts(200)]:
        raw = text.encode()
        ends = P.phrase_ends(raw)
        assert [raw[a:b] for a, b in zip([0, *ends], ends)] == plain_phrases(raw)


@pytest.mark.parametrize("most", [16, 1 << 20])
def test_signatures_do_not_depend_on_pieces(most):
    texts = random_texts(120) + ["", None]
    got = []
    for piece in chunks(pa.array(texts, pa.string()), most):
        hashes, counts = P.signatures(piece)
        got += [x.tolist() for x in np.split(hashes, np.cumsum(counts)[:-1])]
    assert got == [plain_signature(t or "") for t in texts]


def test_stored_form_goes_both_ways():
    hashes, counts = np.array([1, 2**32 - 1, 5], np.uint32), np.array([2, 0, 1])
    assert P.as_text(hashes, counts).to_pylist() == ["00000001ffffffff", "", "00000005"]
    held = P.as_bytes(hashes, counts)
    assert [b.hex() for b in held.to_pylist()] == P.as_text(hashes, counts).to_pylist()
    back = P.from_bytes(held)
    assert back[0].tolist() == hashes.tolist() and back[1].tolist() == counts.tolist()


def test_a_shared_head_is_parsed_once():
    for a, b, c in zip(random_texts(50), random_texts(50, 8), random_texts(50, 9)):
        a, b, c = a.encode(), b.encode(), c.encode()
        assert P.forked_ends(a, [b, c, b""]) == [P.phrase_ends(a + b), P.phrase_ends(a + c), P.phrase_ends(a)]


def expected(rows):
    def key(r):
        return (r[0] is None, -(r[0] or 0))

    order, out = sorted(rows, key=key), []
    for i, (doc, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        new = text[:len(text) - half] + following[:half]
        own, other, after = plain_signature(text), plain_signature(new), plain_signature(following)
        digits = ["".join(f"{x:08x}" for x in s) for s in (own, other)]
        out.append((doc, len(text), hashlib.sha256(new.encode()).hexdigest(), *digits, plain_likeness(own, other), plain_likeness(own, after)))
    return sorted(out, key=str)


@pytest.mark.parametrize("ranges", [1, 4, 40])
def test_neighbours_by_id(spark, ranges):
    texts = random_texts(60, 3)
    rows = [(i * 3, t, "x") for i, t in enumerate(texts)] + [(-5, None, "y"), (1000, "", "z"), (None, "last one", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").repartition(5)
    got = P.along_ids(docs, ranges=ranges).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == expected([r[:2] for r in rows])


def test_one_row_none_and_repeated_rows(spark):
    one = spark.createDataFrame([(1, "abcd")], "doc_id long, text string")
    assert [tuple(r) for r in P.along_ids(one).select(*COLUMNS).collect()] == expected([(1, "abcd")])
    assert P.along_ids(one.limit(0)).count() == 0
    same = spark.createDataFrame([(1, "abab cd")] * 30, "doc_id long, text string")
    assert [tuple(r) for r in P.along_ids(same, ranges=3).select(*COLUMNS).collect()] == expected([(1, "abab cd")] * 30)


def test_fingerprints_keep_other_columns(spark):
    docs = spark.createDataFrame([(1, "a b a b", 5), (2, None, 6)], "doc_id long, text string, n_chars int")
    rows = {r.doc_id: r for r in P.fingerprints(docs).collect()}
    assert rows[1].n_chars == 5 and rows[2].fingerprint == "" and len(rows[1].fingerprint) == 8 * len(plain_signature("a b a b"))


def test_edits_stay_near_and_long_texts_are_read_whole():
    pick = random.Random(1)
    words = ["w%d" % i for i in range(3000)]
    text = " ".join(pick.choice(words) for _ in range(40_000))
    other = " ".join(pick.choice(words) for _ in range(40_000))
    tail = text[:-2000] + "".join(reversed(text[-2000:]))
    parts = [P.signatures(next(chunks(pa.array([t])))) for t in (text, tail, other)]
    near, far = P.likeness(parts[0], parts[1])[0], P.likeness(parts[0], parts[2])[0]
    assert near > 0.8 > 0.6 > far
    assert P.likeness(parts[0], parts[0])[0] == 1.0


def test_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    got = P.op11_phrase_fingerprints(spark, small).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == expected([tuple(r) for r in docs])
