"""The joint search over stored columns, and trainings stored by content."""

import duckdb
import pytest
from pyspark.sql import functions as F

from kanaat.operators import training
from kanaat.sources import models
from test_learning import corpus

SMALL = training.replace(
    training.SEVEN, folds=3, members={"rf": {"numTrees": 6}, "lr": {"C": 1.0}, "svm": {"maxIter": 5}, "mnb": {}, "bagging": {"numTrees": 3, "terms": 0.7}},
    grids={"rf": [{"maxDepth": d, "numTrees": n} for d in (2, 4) for n in (3, 6)], "svm": [{"C": 0.1}, {"C": 1.0}]},
)


@pytest.fixture(scope="module")
def noisy(spark):
    """Every seventh label is wrong, so that settings differ."""
    return corpus(spark).withColumn("label", F.when(F.col("comment_id") % 7 == 0, 1 - F.col("label")).otherwise(F.col("label"))).persist()


def test_joint_accuracies_equal_sql_over_the_stored_columns(spark, noisy):
    data = training.prepare(noisy, SMALL)
    found = training.search(SMALL, data)
    assert [own for own, _, _ in found.tried] == [{"rf": r, "svm": s} for r in SMALL.grids["rf"] for s in SMALL.grids["svm"]]
    assert set(found.scores.columns) == {"id", "label", "fold", *(f"p_rf_{i}" for i in range(4)), "p_lr_0", "p_svm_0", "p_svm_1", "p_mnb_0", "p_bagging_0"}
    assert found.scores.count() == data.rows
    held = found.scores.toPandas()
    for own, columns, accuracy in found.tried:
        vote = " + ".join(columns)
        sql = f"SELECT avg(a) FROM (SELECT avg(((({vote}) / 5 > 0.5)::INT = label)::INT) AS a FROM held GROUP BY fold)"
        assert abs(duckdb.sql(sql).fetchall()[0][0] - accuracy) < 1e-12
    best = max(range(8), key=lambda j: (found.tried[j][2], -j))
    assert found.chosen_of == found.tried[best][0] and found.chosen["rf"] == {"numTrees": 6, **found.chosen_of["rf"]}


def test_an_equal_training_is_read_back(spark, noisy, tmp_path, monkeypatch):
    folder = str(tmp_path)
    one = models.trained(noisy, SMALL, folder=folder)
    assert one.tried.count() == 8 and one.tried.agg(F.sum("chosen")).first()[0] >= 1
    monkeypatch.setattr(training, "train_all", None)  # a second training would fail
    two = models.trained(noisy.repartition(7), SMALL, folder=folder)
    comments = noisy.select("comment_id", "text")
    answers = [sorted(map(tuple, training.predict_wide(comments, t.models).collect())) for t in (one, two)]
    assert answers[0] == answers[1]
    assert [m.path for m in two.models] == ["tuned"] and two.report.count() == 2
    with pytest.raises(TypeError):
        models.trained(noisy.where("comment_id > 0"), SMALL, folder=folder)
    with pytest.raises(TypeError):
        models.trained(noisy, training.replace(SMALL, terms=20), folder=folder)


def test_a_training_that_fails_is_not_stored(spark, noisy, tmp_path):
    one_class = noisy.withColumn("category", F.lit("Tek")).withColumn("text", F.lit("x y"))
    with pytest.raises(RuntimeError):
        models.trained(noisy.unionByName(one_class), SMALL, tune=False, folder=str(tmp_path))
    assert models._entry(spark, str(tmp_path), models.content_key(noisy, SMALL, False)) is None
