"""Held-out quality and odd inputs."""

import zlib

import pytest

from kanaat.llm import toxicity


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    rows = {r.doc_id: r for r in toxicity.op4_compression_toxicity(spark, folder).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert rows.keys() == texts.keys()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in rows.items())
    held = [(rows[i].predicted, y) for i, y in labels.items() if rows[i].held_out]
    hits, alarms = sum(p for p, y in held if y == 1), sum(p for p, y in held if y == 0)
    print(hits, alarms, len(held), sum(y for _, y in held))
    assert hits / sum(y == 1 for _, y in held) > 0.65  # about a fourth of the toxic labels are on texts without any sign
    assert alarms / sum(y == 0 for _, y in held) < 0.05


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 0)]])
def test_odd_rows(spark, labels):
    docs = spark.createDataFrame([(None, None, 1.0), (1, "", 1.0), (1, "some words", 1.0), (2, "x " * 3000, 1.0), (2, "x " * 3000, 1.0)], "doc_id long, text string, score double")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    rows = toxicity.scored(docs, toxicity.fitted(docs, known)).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.scored(docs.limit(0), toxicity.fitted(docs.limit(0), known)).count() == 0


def test_marks_of_a_rare_kind(spark):
    """A word in 2 % of the toxic texts marks, and so does a phrase of ordinary words; a word spread by chance does not."""
    rows = [("common", 900, 0), ("rare", 20, 0), ("go back home", 20, 0), ("the common", 50, 0), ("chance", 100, 900), ("few", 3, 20)]
    counts = spark.createDataFrame(rows + [(f"w{i}", 3, 30) for i in range(200)], "word string, toxic long, ordinary long")
    assert toxicity.marking(counts, 1000, 9000) == ["common", "rare", "go back home"]
    assert toxicity.marking(counts, 0, 9000) == []


def test_phrase_of_ordinary_words(spark):
    """Each word of the phrase is as common in ordinary texts, so only windows of several words can tell."""
    import random

    draw = random.Random(3)
    vocabulary = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(400)]
    made = []
    for i in range(1600):
        text = [draw.choice(vocabulary) for _ in range(60)]
        for word in ("never", "come", "again"):
            text.insert(draw.randrange(len(text)), word)
        if i % 8 == 0:
            text[30:30] = ["never", "come", "again"]
        made.append((i, " ".join(text), int(i % 8 == 0)))
    docs = spark.createDataFrame(made, "doc_id long, text string, toxic int")
    model = toxicity.fitted(docs, docs.select("doc_id", "toxic"))
    scores = {r.doc_id: r.score for r in toxicity.scored(docs.where(toxicity.held_out(docs.doc_id)), model).collect()}
    toxic, ordinary = ([s for i, s in scores.items() if (i % 8 == 0) == y] for y in (True, False))
    assert sum(s >= 0.3 for s in toxic) / len(toxic) > 0.8 and sum(s >= 0.3 for s in ordinary) / len(ordinary) < 0.1
