"""The pipeline against its operators' plain versions, stage by stage, and the registered queries."""

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from kanaat.llm import quality_rules, site_quality
from test_ngram_join import brute
from test_packing import check
from pyspark.sql import functions as F
from test_secrets import base_spans

FOLDER = "/root/testdata/sf0.001"


def test_stages_work_on_all_that_is_kept(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    stages = dict(corpus_pipeline.STAGES)
    outs = {}
    for name in names:
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        before, docs = docs, stages[name](spark, docs, FOLDER)
        outs[name] = (before, spark.createDataFrame(docs.collect(), docs.schema))
        docs = outs[name][1]
    before, after = outs[names[0]]
    model = site_quality.fitted(before, labels)
    kept = site_quality.judged(site_quality.with_evidence(before, model), model, "source", "lang").where("kept")
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in kept.collect())
    before, after = outs[names[1]]
    verdicts = quality_rules.judged(before, quality_rules.fitted(before, labels)).where("kept")
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in verdicts.collect())
    before, after = outs[names[2]]
    rows = sorted((r.doc_id, r.text) for r in before.collect())
    parts = brute([t for _, t in rows])
    assert sorted(r.doc_id for r in after.collect()) == [rows[i][0] for i in sorted({c for _, c in parts.values()})]
    before, after = outs[names[3]]
    assert before.count() == after.count()
    old = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        assert not base_spans(r.text) and r.n_chars == len(r.text)
        if not base_spans(old[r.doc_id]) and "<secret>" not in r.text:
            assert r.text == old[r.doc_id]
    before, after = outs[names[4]]
    used, least = check(after.collect(), [(r.doc_id, r.text) for r in before.collect()])
    assert used <= least + 1


def test_near_copies_keeps_one_of_repeated_rows(spark):
    docs = spark.createDataFrame([(5, "a b c d e f"), (5, "a b c d e f"), (4, "a b c d e f"), (None, "A b c d e f"), (None, "x"), (None, "x"), (7, ""), (8, None), (9, "q")],
                                 "doc_id long, text string")
    rows = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_copies(spark, docs, FOLDER).collect()), key=str)
    assert rows == sorted([(4, "a b c d e f"), (None, "x"), (7, ""), (8, None), (9, "q")], key=str)


def test_registered():
    names = queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in names and set(oracle_sql()) <= set(names)


def test_own_columns_stay_whatever_their_names(spark):
    names = ["secrets", "strong_secrets", "_key", "_strong", "_weak", "_linked", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "base_failed", "quality_score", "kept", "score", "host_rate", "path_rate", "_p", "_host", "_path", "n_path", "s_path", "n_host", "s_host",
             "node", "n", "shingles", "label", "component_id", "_node", "_n", "_gone", "_many", "_k", "_label", "_id"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("*", *[F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")).alias(c) for c in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, FOLDER)
        assert after.schema.simpleString() == docs.schema.simpleString(), name
        rows = after.collect()
        assert rows and all(r[c] == f"{c} of {r.doc_id}" for r in rows for c in names), name
        plain = stage(spark, docs.drop(*names), FOLDER)
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in plain.collect()), name
    assert corpus_pipeline.sequence_packing(spark, docs, FOLDER).count() >= docs.count()
