"""Rates against plain sums, shrinkage, held-out labels, odd rows."""

import math

import pytest

from kanaat.llm import site_quality


def test_rates_equal_plain_sums(spark):
    rows = [(i, ["a", "a", "a", "b", None][i % 5], ["x", None][i % 2], 0.1 + 0.8 * ((i * 7) % 10) / 10) for i in range(60)]
    evidence = spark.createDataFrame(rows, "doc_id long, host string, path string, _p double")
    model = site_quality.Model(None, True)
    got = {r.doc_id: r for r in site_quality.judged(evidence, model, "host", "path").collect()}
    _, prior = site_quality.site_rates(evidence, "host", "path")
    assert len(got) == len(rows)
    mean = sum(r[3] for r in rows) / len(rows)
    assert math.isclose(prior["mean"], mean)
    for i, host, path, p in rows:
        of_host = [r[3] for r in rows if r[1] == host and r[0] != i]
        of_path = [r[3] for r in rows if r[1] == host and r[2] == path and r[0] != i]
        host_rate = (sum(of_host) + prior["host"] * mean) / (len(of_host) + prior["host"])
        path_rate = (sum(of_path) + prior["path"] * host_rate) / (len(of_path) + prior["path"])
        shift = max(-1.5, min(1.5, math.log(path_rate / (1 - path_rate)) - math.log(mean / (1 - mean))))
        assert math.isclose(got[i].path_rate, path_rate)
        assert math.isclose(got[i].score, 1 / (1 + math.exp(-(math.log(p / (1 - p)) + shift))))


def test_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = site_quality.fitted(docs, labels.where("doc_id % 3 != 0"))
    kept = {r.doc_id: r.kept for r in site_quality.judged(site_quality.with_evidence(docs, model), model, "source", "lang").collect()}
    held = [(kept[r.doc_id], r.quality) for r in labels.where("doc_id % 3 = 0").collect()]
    assert sum(k == bool(q) for k, q in held) / len(held) > 0.94
    assert sum(k for k, q in held if q == 1) / sum(q for _, q in held) > 0.985


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, 2.0), (1, "x", "a", "s", 2.0), (1, "x", "a", "s", 2.0), (2, "w " * 4000, None, "s", 1.0)]])
def test_odd_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = site_quality.clean(docs, none)
    assert out.count() == len(rows) and out.columns == docs.columns
