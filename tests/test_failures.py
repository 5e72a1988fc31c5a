"""A failure in training or prediction is never a query's result."""

import pytest

from kanaat.operators import training
from kanaat.plans import models
from kanaat.sources.models import Trained
from test_learning import corpus


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    rows = corpus(spark)
    rows.selectExpr("comment_id AS doc_id", "text", "'tr' AS lang", "'x' AS source", "length(text) AS n_chars").write.parquet(f"{folder}/documents.parquet")
    rows.selectExpr("comment_id AS doc_id", "label AS quality", "1 - label AS toxic").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def failing(*_):
    raise ArithmeticError("search")


def test_a_failed_search_is_no_search(spark, tables, monkeypatch):
    monkeypatch.setattr(training, "search", failing)
    with pytest.raises(RuntimeError, match="ArithmeticError: search"):
        models.searched_parameters(spark, tables).collect()


def test_only_a_training_without_fallbacks_raises(spark, monkeypatch):
    monkeypatch.setattr(training, "search", failing)
    small = training.replace(training.SEVEN, members={"mnb": {}}, grids={"mnb": [{"smoothing": 1.0}, {"smoothing": 2.0}]})
    model, _ = training.train_category("Teslimat", corpus(spark), small)
    assert model.path == "default after ArithmeticError"
    with pytest.raises(ArithmeticError):
        training.train_category("Teslimat", corpus(spark), small, fallbacks=False)


def test_metrics_are_of_the_searched_ensemble_only(spark, tables, monkeypatch):
    monkeypatch.setattr(training, "search", failing)
    with pytest.raises(RuntimeError, match="ArithmeticError: search"):
        models.trained_categories(spark, tables).collect()


def test_a_model_that_cannot_be_applied_is_no_zero(spark, tables, monkeypatch):
    broken = training.CategoryModel("Bozuk", training.SEVEN, None, [])
    monkeypatch.setattr(models, "trained", lambda *_, **__: Trained([broken], None, None))
    with pytest.raises(RuntimeError, match="not predicted: Bozuk"):
        models.predicted_categories(spark, tables).collect()


def test_predictions_are_of_the_searched_ensemble_only(spark, tables, monkeypatch):
    monkeypatch.setattr(training, "search", failing)
    with pytest.raises(RuntimeError, match="ArithmeticError: search"):
        models.predicted_categories(spark, tables).collect()
