"""Statistics against plain loops; trees on held-out labels; monotonic scores."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from kanaat.llm import boosting, quality_rules
from kanaat.llm.batches import chunks
from kanaat.llm.statistics import FEATURES, text_statistics

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered)}


TEXTS = [None, "", " ", "\n\n", "a", "é ß|# $", "a b c d e f a b c d e g", "x\nx\n x\nx\n\n", "w " * 500, "a b\n" * 40 + "ü",
         "one two three four five\vsix seven\x0beight", "no end\n", "\nstart", "１２ ﻿ x y", "a b c d e", "a b c d", "q r s t u q r s t u"]


def test_counts_equal_plain_loops(spark, small):
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    for most in (1, 200, 1 << 22):
        got = []
        for part in chunks(pa.array(texts), most):
            s = text_statistics(part)
            got += [{k: int(s[k][i]) for k in quality_rules.COUNTS} for i in range(part.rows)]
        assert got == [plain(t) for t in texts]


def test_trees_keep_their_monotonic_features():
    pick = np.random.default_rng(3)
    x = pick.random((3000, len(FEATURES)))
    y = (x[:, 0] + 0.3 * pick.random(3000) < 0.6).astype(int) ^ (pick.random(3000) < 0.05)
    signs = list(FEATURES.values())
    trees = boosting.fit(x, y, signs, rounds=30)
    assert ((trees.probability(x) >= 0.5) == y).mean() > 0.85
    for f, sign in enumerate(signs):
        if sign:
            more = x.copy()
            more[:, f] += pick.random(3000)
            assert (sign * (trees.raw(more) - trees.raw(x)) >= -1e-9).all()


def test_one_class_or_none_gives_a_constant():
    x = np.random.default_rng(1).random((20, len(FEATURES)))
    for y in (np.ones(20, int), np.zeros(0, int)):
        trees = boosting.fit(x[:len(y)], y, list(FEATURES.values()))
        assert len(set(trees.raw(x))) == 1


def test_query_and_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in quality_rules.op3_boosted_quality_rules(spark, folder).collect()}
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert rows.keys() == docs.keys()
    for i, r in rows.items():
        assert {k: r[k] for k in quality_rules.COUNTS} == plain(docs[i].text)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    learn, held = labels.where("doc_id % 3 != 0"), labels.where("doc_id % 3 = 0").collect()
    source = spark.read.parquet(f"{folder}/documents.parquet")
    judged = {r.doc_id: r for r in quality_rules.judged(source, quality_rules.fitted(source, learn)).collect()}
    good = [r for r in held if not judged[r.doc_id].base_failed]
    assert sum(judged[r.doc_id].kept == bool(r.quality) for r in good) / len(good) > 0.93


@pytest.mark.parametrize("rows", [[], [(None, None, True), (1, "x", None), (1, "x", None)]])
def test_odd_tables(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept boolean")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_rules.judged(docs, quality_rules.fitted(docs, none)).count() == len(rows)
    out = quality_rules.clean(docs, none)
    assert out.schema == docs.schema and out.count() == 0
