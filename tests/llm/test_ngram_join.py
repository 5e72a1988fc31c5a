"""Components against all pairs in plain Python."""

import random
import re

import pytest

from kanaat.llm import ngram_join

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts):
    sets = []
    for text in texts:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} - {()})
    top = list(range(len(texts)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            a, b = root(i), root(j)
            if a != b and min(len(sets[i]), len(sets[j])) * 5 >= 4 * max(len(sets[i]), len(sets[j]), 1):
                both = len(sets[i] & sets[j])
                if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    top[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in enumerate(sets)}


def made(seed):
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [None, "", " \n", "one two", "One  two", "one two three", "é É", "a b c d e", "A B C D E"]
    for _ in range(12):
        base = [pick.choice(vocabulary) for _ in range(pick.randrange(6, 150))]
        for _ in range(pick.randrange(1, 14)):
            words = list(base)
            for _ in range(pick.randrange(0, 5)):
                at = pick.randrange(len(words))
                if pick.random() < 0.5:
                    words[at] = pick.choice(vocabulary)
                else:
                    words[at:at + 1] = [pick.choice(vocabulary) for _ in range(pick.randrange(0, 9))]
            texts.append(pick.choice([" ", "\n"]).join(words))
    pick.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_all_pairs(spark, seed, monkeypatch):
    monkeypatch.setattr(ngram_join, "FREQUENT", 50)
    texts = made(seed)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, node string").repartition(3)
    rows = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_documents(docs).collect()}
    assert rows == brute(texts)


def test_query(spark, small):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect())
    expected = brute([t for _, t in docs])
    rows = ngram_join.op9_rare_first_join(spark, small).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {docs[i][0]: (n, docs[c][0]) for i, (n, c) in expected.items()}


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, "a b"), (3, "a b"), (3, "a b"), (None, None), (7, None), (None, "z")], "doc_id long, text string")
    rows = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.similar_documents(docs).collect()), key=str)
    assert rows == sorted([(None, 1, 3), (3, 1, 3), (3, 1, 3), (None, 0, None), (7, 0, 7), (None, 1, None)], key=str)
    assert ngram_join.similar_documents(docs.limit(0)).count() == 0


def test_wordless_row_beside_a_copy_of_its_id(spark):
    text = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, text), (2, text), (2, None), (2, ""), (2, " ")], "doc_id long, text string")
    rows = [(r.doc_id, r.text) for r in ngram_join.one_of_each(docs).collect()]
    assert sorted(rows, key=str) == sorted([(1, text), (2, None), (2, ""), (2, " ")], key=str)


def test_family_beside_outsiders_costs_its_size(spark, monkeypatch):
    pick = random.Random(5)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(600):  # near copies of one text, then texts that share a good part of it but too little
        words = list(base)
        for _ in range(1 if i < 400 else 12):
            words[pick.randrange(200)] = f"v{pick.randrange(10**9)}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    counts, write = {}, ngram_join.stored

    def counting(df, name):
        done = write(df, name)
        counts.setdefault(name, []).append(done.count())
        return done

    monkeypatch.setattr(ngram_join, "stored", counting)
    rows = {r.doc_id: r.component_id for r in ngram_join.similar_documents(docs).collect()}
    assert rows == {i: c for i, (_, c) in brute(texts).items()}
    assert max(rows[i] for i in range(400)) == 0
    shared = counts["join-shared"][0]
    assert counts["join-label-pairs"][0] < shared and counts["join-meeting"][0] < shared
