"""Linear classifiers fitted side by side against MLlib's, one at a time."""

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.sql import functions as F

from kanaat.operators import linear, training
from test_forests import as_rows, table
from test_learning import corpus

FITS = [linear.Fit("logistic", 0.05), linear.Fit("logistic", 0.004, unseen=2), linear.Fit("hinge", 0.05), linear.Fit("hinge", 0.004, unseen=0)]


def value(fit, line, x, y, fold):
    seen = fold != fit.unseen
    away = (2 * y[seen] - 1) * line.score(x[seen])
    loss = np.logaddexp(0, -away) if fit.loss == "logistic" else np.maximum(0, 1 - away)
    return loss.mean() + 0.5 * fit.penalty * (line.weights ** 2).sum()


@pytest.mark.parametrize("rows_of_a_block", [4096, 90])
def test_lines_are_those_of_single_fits(spark, monkeypatch, rows_of_a_block):
    monkeypatch.setattr(linear, "BLOCK_ROWS", rows_of_a_block)
    x, y = table()
    x[:, 4] = 0.0  # a term that no row has
    df, fold = as_rows(spark, x, y).persist(), np.arange(len(y)) % 4
    for fit, line in zip(FITS, linear.fit(df, FITS, x.shape[1], len(y)), strict=True):
        seen = df if fit.unseen is None else df.where(F.col("fold") != fit.unseen)
        kind = LogisticRegression if fit.loss == "logistic" else LinearSVC
        alone = kind(maxIter=100, regParam=fit.penalty, standardization=False).fit(seen.coalesce(1).persist())
        other = linear.Line(alone.coefficients.toArray(), alone.intercept)
        ours, least = value(fit, line, x, y, fold), value(fit, other, x, y, fold)
        assert ours < least * (1 + 1e-3) and line.weights[4] == 0
        if fit.loss == "logistic":
            assert np.allclose(line.score(x), other.score(x), atol=0.05)
        assert ((line.score(x) > 0) == (other.score(x) > 0)).mean() > 0.97


def jobs(spark, name, call):
    context = spark.sparkContext
    context.setJobGroup(name, name)
    try:
        call()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return len(context.statusTracker().getJobIdsForGroup(name))


def test_many_fits_take_the_jobs_of_one(spark):
    x, y = table()
    df = as_rows(spark, x, y).persist()
    alone = jobs(spark, "line", lambda: linear.fit(df, FITS[:1], x.shape[1], len(y)))
    folds = [linear.Fit("logistic", 0.05, unseen=fold) for fold in (None, 0, 1, 2, 3)]
    assert jobs(spark, "lines", lambda: linear.fit(df, folds, x.shape[1], len(y))) <= alone + 6


def test_jobs_of_a_search_do_not_grow_with_its_linear_fits(spark):
    members = {"lr": {"C": 0.2}, "svm": {"C": 0.2, "maxIter": 3}}
    few = training.replace(training.SEVEN, folds=2, members=members, grids={"svm": [{"C": 0.1}]})
    many = training.replace(few, folds=8)
    data = training.prepare(corpus(spark), few)
    counts = [jobs(spark, f"search {p.folds}", lambda p=p: training.search(p, data)) for p in (few, many)]
    assert counts[1] <= counts[0] * 1.5
