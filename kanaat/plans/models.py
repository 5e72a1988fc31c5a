"""Training, search, voting and prediction over the given labels. Trained numbers have no SQL form;
the queries report them, and the tests check what must hold for any training."""

from __future__ import annotations

from pyspark.sql import functions as F

from kanaat.functions.fixed_values import TEST, TRAIN
from kanaat.operators import learners, metrics, sampling, tables, training
from kanaat.operators.sentiment import score_category_hits
from kanaat.operators.training import ELEVEN, SEVEN
from kanaat.plans.inputs import comments, labelled_comments, rounded
from kanaat.plans.registry import query
from kanaat.session import shared_path
from kanaat.sources.models import trained
from kanaat.sources.sinks import write_report
from kanaat.sources.tables import spread


def _by_category(rows, profile):
    """Each category and its rows, as training takes them."""
    if profile.cap is not None:
        rows = sampling.capped_class_sample(rows, profile.cap).where("in_sample").drop("in_sample")
    words = training.staged(rows, profile)
    names = sorted(r.category for r in words.select("category").distinct().collect())
    return [(name, words.where(F.col("category") == name)) for name in names]


def _learner(name):
    def run(spark, folder):
        def one(category, rows):
            data = training.prepare(rows, ELEVEN)
            fitted = learners.fit(name, ELEVEN.members[name], data.train, data.rows)
            return training.report(training.CategoryModel(category, ELEVEN, data.vectorizer, [fitted]), data)

        parted = _by_category(labelled_comments(spark, folder), ELEVEN)
        made = learners.at_once(spark, [lambda c=c, r=r: one(c, r) for c, r in parted])
        return rounded(tables.union_all(made).withColumn("model", F.lit(name)))

    return run


for _name in ELEVEN.members:
    query(f"trained_{_name}")(_learner(_name))


@query("voted_ensemble")
def voted_ensemble(spark, folder):
    made = trained(labelled_comments(spark, folder), ELEVEN)
    paths = spark.createDataFrame([(m.category, m.path) for m in made.models], "category string, path string")
    return rounded(made.report.join(F.broadcast(paths), "category").select(*made.report.columns, "path"))


@query("searched_parameters")
def searched_parameters(spark, folder):
    """Every joint choice of settings and its accuracy on unseen rows. A search that fails raises."""
    return rounded(trained(labelled_comments(spark, folder), SEVEN, fallbacks=False).tried.drop("columns"))


@query("trained_categories")
def trained_categories(spark, folder):
    """Metrics of every category's searched ensemble. A search or an ensemble that fails raises."""
    made = trained(labelled_comments(spark, folder), SEVEN, fallbacks=False).report
    return rounded(metrics.model_summary(
        made.where(F.col("split") == TRAIN), made.where(F.col("split") == TEST), ["category", "model"]
    ))


def _length_logits():
    """A scorer standing in for a language model: longer texts lean to the positive side."""
    return lambda texts: [(1.0, len(t) / 1000.0) for t in texts]


@query("predicted_categories")
def predicted_categories(spark, folder):
    """Predict every category for every comment by the stored models, score the hits' sentiment. A training that fails
    or a model that cannot be applied raises."""
    loaded = trained(labelled_comments(spark, folder), SEVEN, fallbacks=False).models
    path = shared_path(spark, "predictions")
    # Predictions are a table of their own, as in any run that keeps them; sentiment starts from it.
    write_report(training.predict_wide(spread(comments(spark, folder)).select("comment_id", "text"), loaded, fallbacks=False), path)
    wide = spark.read.parquet(path)
    names = [m.category for m in loaded]
    return score_category_hits(wide, names, _length_logits).select(
        "comment_id", *names, F.round("polarity", 6).alias("polarity"), "sentiment"
    )


@query("predicted_rest")
def predicted_rest(spark, folder):
    """Train on a capped sample of each class, predict the rows left over, beside their truth."""
    rows = labelled_comments(spark, folder)
    models = trained(rows, ELEVEN).models
    rest = training.predict_long(training.rows_to_score(rows, ELEVEN), models)
    return rest.select("comment_id", "category", "label", F.round("p1", 6).alias("p1"), "predicted")
