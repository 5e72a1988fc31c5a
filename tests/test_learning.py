import math
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from kanaat.operators import balance, ensemble, features, learners, metrics, neighbours, sentiment, training
from kanaat.sources.models import load_models, save_models


def points(spark, n, dims=4, groups=2, seed=0, copies=0):
    rng = np.random.default_rng(seed)
    rows = [(i, int(rng.integers(groups)), rng.normal(size=dims).tolist()) for i in range(n)]
    rows += [(n + i, 0, [1.0] * dims) for i in range(copies)]
    return rows, spark.createDataFrame(rows, "id long, grp int, vector array<double>")


def brute(rows, k):
    found = {}
    for i, g, x in rows:
        near = sorted((sum((a - b) ** 2 for a, b in zip(x, y)), j) for j, h, y in rows if h == g and j != i)
        found[i] = [j for _, j in near[:k]]
    return found


@pytest.mark.parametrize("how", [{}, {"broadcast_rows": 0, "chunk_rows": 16, "pivots": 8}, {"broadcast_rows": 0, "chunk_rows": 7, "pivots": 1}])
def test_neighbours_equal_brute_force(spark, how):
    rows, df = points(spark, 120, copies=60)  # a third of all points are copies of one
    got = neighbours.knn_join(df, df, 5, skip_self=True, **how).collect()
    expected = brute(rows, 5)
    for i, near in expected.items():
        assert [r.neighbour_id for r in sorted((r for r in got if r.query_id == i), key=lambda r: r["rank"])] == near


def test_oversample(spark):
    rows = [(i, int(i < 12), [float(i), random.Random(i).random()]) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, label int, vector array<double>")
    out, done = balance.oversample(df)
    made = out.where("synthetic = 1").collect()
    assert done and len(made) == 36 and all(r.label == 1 for r in made)
    small = [np.array(v) for i, y, v in rows if y]
    for r in made:
        p = np.array(r.vector)
        assert any(
            abs(np.linalg.norm(p - a) + np.linalg.norm(p - b) - np.linalg.norm(a - b)) < 1e-9 for a in small for b in small
        )
    assert sorted(map(str, out.collect())) == sorted(map(str, balance.oversample(df)[0].collect()))


def test_oversample_leaves_a_tiny_class(spark):
    df = spark.createDataFrame([(0, 1, [0.0])] + [(i, 0, [float(i)]) for i in range(1, 9)], "id long, label int, vector array<double>")
    out, done = balance.oversample(df)
    assert not done and out.count() == 9


DOCS = ["aa bb aa cc", "bb cc dd", "aa dd dd ee", "ff", "bb bb"]


def plain_tfidf(docs, size):
    words = [d.split() for d in docs]
    ctf, df = {}, {}
    for w in words:
        for t in w:
            ctf[t] = ctf.get(t, 0) + 1
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    top = set(sorted(ctf, key=lambda t: (-ctf[t], t))[:size])
    out = {}
    for i, w in enumerate(words):
        raw = {t: w.count(t) * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t in set(w) & top}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        out.update({(i, t): v / norm for t, v in raw.items()})
    return out


def test_weights_equal_formula_and_vectors(spark):
    docs = spark.createDataFrame([(i, "c", d) for i, d in enumerate(DOCS)], "comment_id long, category string, text string")
    worded = features.with_words(docs, "text", [], bigrams=False)
    vocab = features.fit_vocabulary(worded, ["category"], 4)
    got = {(r.comment_id, r.term): r.weight for r in features.weights(worded, vocab, ["category"]).collect()}
    expected = plain_tfidf(DOCS, 4)
    assert got.keys() == expected.keys()
    assert all(abs(got[k] - v) < 1e-12 for k, v in expected.items())
    terms = [r.term for r in vocab.orderBy("term_index").collect()]
    vectors = features.vectorizer(spark, vocab).transform(worded).select("comment_id", vector_to_array("features").alias("v"))
    for r in vectors.collect():
        for t, v in zip(terms, r.v):
            assert abs(v - expected.get((r.comment_id, t), 0.0)) < 1e-12


def test_weighted_metrics(spark):
    rows = [("a", 1, 1), ("a", 1, 0), ("a", 0, 0), ("z", 1, 0), ("z", 0, 0)]
    got = {r.c: r for r in metrics.weighted_metrics(spark.createDataFrame(rows, "c string, label int, predicted int"), ["c"]).collect()}
    assert got["a"].accuracy == got["a"].recall == pytest.approx(2 / 3)
    assert got["a"].precision == pytest.approx(2 / 3 * 1 + 1 / 3 * 0.5)
    assert got["z"].precision == 0.25  # no positive guess: its precision counts as 0


def test_vote_order_and_tie(spark):
    df = spark.createDataFrame([(0.9, 0.2, 0.4), (0.5, 0.5, 0.5)], "a double, b double, c double")
    one = [r.predicted for r in ensemble.vote(df, ["a", "b", "c"]).collect()]
    assert one == [r.predicted for r in ensemble.vote(df, ["c", "a", "b"]).collect()] == [0, 0]


def corpus(spark, n=160):
    rng, rows = random.Random(2), []
    for i in range(n):
        label = int(i % 4 == 0)
        words = rng.choices(["kargo", "geldi", "ürün", "paket", "sipariş"], k=6) + (["harika"] * 2 if label else ["berbat"] * 2)
        rng.shuffle(words)
        rows.append((i, "Teslimat", label, " ".join(words)))
    return spark.createDataFrame(rows, "comment_id long, category string, label int, text string")


TRIAL = training.shortened(
    training.ELEVEN, gb={"maxIter": 3}, ada={"rounds": 3}, rf={"numTrees": 5, "maxDepth": 4},
    et={"numTrees": 5, "maxDepth": 4}, bagging={"numTrees": 3, "maxDepth": 4}, svm={"maxIter": 5}, dt={"maxDepth": 4},
)


def test_ensemble_learns_saves_and_loads(spark, tmp_path):
    model, report = training.train_category("Teslimat", corpus(spark), TRIAL, tune=False)
    assert [m.name for m in model.members] == list(training.ELEVEN.members)
    assert all(r.accuracy > 0.9 for r in report.collect())  # the larger class alone gives 0.75
    save_models(spark, [model], str(tmp_path))
    loaded = load_models(spark, str(tmp_path))[0]
    rows = training.worded(corpus(spark), TRIAL).withColumn("id", F.col("comment_id"))
    both = model.score(rows).select("id", "p1").join(loaded.score(rows).select("id", F.col("p1").alias("q")), "id").collect()
    assert len(both) == 160 and all(abs(r.p1 - r.q) < 1e-9 for r in both)


def test_neighbour_votes_by_join_equal_broadcast(spark):
    _, df = points(spark, 80, groups=1)
    base = df.select("id", (F.col("id") % 2).cast("double").alias("label"), "vector")
    from pyspark.ml.functions import array_to_vector

    rows = df.select("id", array_to_vector("vector").alias("features"))
    small = learners.Neighbours("knn", base).score(rows).select("id", "p_knn").collect()
    large = learners.Neighbours("knn", base, most_rows=0).score(rows).select("id", "p_knn").collect()
    assert sorted(map(tuple, small)) == sorted(map(tuple, large))


def test_broken_member_falls_back(spark, monkeypatch):
    real = learners.fit

    def broken(name, params, train, rows):
        if name != "rf":
            raise RuntimeError(name)
        return real(name, params, train, rows)

    monkeypatch.setattr(training.learners, "fit", broken)
    model, _ = training.train_category("Teslimat", corpus(spark), TRIAL, tune=False)
    assert [m.name for m in model.members] == ["rf"] and model.path.startswith("forest")


def test_wide_prediction_and_failed_model(spark):
    short = training.shortened(training.SEVEN)
    short = training.replace(short, members={"lr": {"C": 1.0}})
    models, _, failed = training.train_all(corpus(spark), short, tune=False)
    assert not failed
    broken = training.CategoryModel("Bozuk", short, None, [])
    wide = training.predict_wide(corpus(spark).select("comment_id", "text"), [*models, broken])
    assert wide.columns == ["comment_id", "text", "Teslimat", "Bozuk"]
    assert wide.agg(F.sum("Bozuk")).first()[0] == 0 and wide.agg(F.sum("Teslimat")).first()[0] > 20


def test_files_to_predictions_with_text_ids(spark, tmp_path):
    """The README example: labelled files, training, a changed profile that survives reload, a model that can't be read."""
    from kanaat.sources import files

    rows = corpus(spark).collect()
    (tmp_path / "labels").mkdir()
    lines = "".join(f'2024-01-01,"{r.text}",{r.label}\n' for r in rows)
    for name in ("Teslimat", "Kargo"):
        (tmp_path / "labels" / f"{name}.csv").write_text("Tarih,Yorum,Sonuç\n" + lines)
    labelled = files.canonical_labels(files.read_labelled_csv(spark, str(tmp_path / "labels")))
    assert dict(labelled.dtypes)["comment_id"] == "string"
    changed = training.replace(training.SEVEN, members={"lr": {"C": 1.0}, "knn": {}}, bigrams=False, stop_words=("paket",))
    models, report, failed = training.train_all(labelled, changed, tune=False)
    assert failed == {} and [m.category for m in models] == ["Kargo", "Teslimat"]
    save_models(spark, models, str(tmp_path / "store"))
    loaded = load_models(spark, str(tmp_path / "store"))
    assert [m.profile for m in loaded] == [m.profile for m in models]
    comments = labelled.select("comment_id", "text")
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(training.predict_wide(comments, loaded)) == key(training.predict_wide(comments, models))
    (next((tmp_path / "store" / "models").glob("*Kargo")) / "vectorizer").rename(tmp_path / "elsewhere")
    broken = {}
    left = load_models(spark, str(tmp_path / "store"), failed=broken)
    wide = training.predict_wide(comments, left, missing=list(broken))
    assert list(broken) == ["Kargo"] and wide.agg(F.sum("Kargo"), F.sum("Teslimat")).first()[0] == 0
    assert {tuple(r.failed_categories) for r in wide.collect()} == {("Kargo",)}


def test_a_failing_category_is_left_out(spark):
    one_class = corpus(spark).withColumn("category", F.lit("Tek")).where("label = 0")
    one_class = one_class.withColumn("text", F.lit("x y"))  # no word of two letters
    models, _, failed = training.train_all(corpus(spark).unionByName(one_class), training.replace(training.SEVEN, members={"mnb": {}}), tune=False)
    assert [m.category for m in models] == ["Teslimat"] and list(failed) == ["Tek"]


def fragile():
    def score(texts):
        if any("boom" in t for t in texts):
            raise RuntimeError
        return [(0.0, float(len(t) - 3)) for t in texts]

    return score


def test_sentiment_scorer(spark):
    df = spark.createDataFrame([("abcd", 1, 0), ("a", 0, 1), ("boom", 1, 0), ("xyz", 0, 0)], "text string, k1 int, k2 int")
    got = {r.text: r for r in sentiment.score_category_hits(df, ["k1", "k2"], fragile).collect()}
    assert {t: r.sentiment for t, r in got.items()} == {"abcd": "Pozitif", "a": "Negatif", "boom": "Nötr", "xyz": "Nötr"}
    assert got["boom"].polarity == 0.0
    empty = sentiment.distribution(df.select(F.lit("Pozitif").alias("sentiment")).where("false")).first()
    assert empty.total == 0 and empty.positive_share is None


def test_boosted_stumps_score_as_their_chain(spark, monkeypatch, tmp_path):
    """The flat scorer against MLlib's own stumps, one transform after another."""
    from test_forests import as_rows, table

    kept, take = [], learners.Boosted.add
    monkeypatch.setattr(learners.Boosted, "add", lambda self, stump: (kept.append(stump), take(self, stump)))
    df = as_rows(spark, *table())
    made = learners.fit("ada", {"rounds": 4}, df, 0)
    out = df
    for i, stump in enumerate(kept):
        odds = learners.Boosted.log_odds(learners._probability("ada"))
        out = learners._tidy(stump.transform(out).withColumn(f"o{i}", odds), "ada")
    chain = out.withColumn("q", 1 / (1 + F.exp(-(F.col("o0") + F.col("o1") + F.col("o2") + F.col("o3")) / 4)))
    assert all(abs(r.q - r.p_ada) < 1e-12 for r in made.score(chain).select("q", "p_ada").collect())
    made.save(str(tmp_path / "ada"))
    assert learners.load(spark, "ada", str(tmp_path / "ada")) == made


def test_a_large_base_is_streamed_in_bounded_rows(spark, monkeypatch):
    """No row of either side is multiplied by cells, a common vector stays k + 1 rows, queries are dealt to several parts."""
    rows, df = points(spark, 300, dims=16, groups=3, copies=500)
    monkeypatch.setattr(neighbours, "LEAST_PART_ROWS", 40)
    seen, stream = spark.sparkContext.accumulator(0), neighbours._streamed

    def counted(k, skip_self, chunk_rows, batches):
        def watched():
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return stream(k, skip_self, chunk_rows, watched())

    monkeypatch.setattr(neighbours, "_streamed", counted)
    got = neighbours.knn_join(df, df, 5, skip_self=True, broadcast_rows=0).collect()
    expected = brute(rows, 5)
    assert len(got) == 5 * 800
    for r in got:
        assert expected[r.query_id][r["rank"] - 1] == r.neighbour_id
    assert seen.value < 800 + 306 * 20


def test_neighbours_of_text_ids(spark):
    rows, df = points(spark, 90, copies=10)
    named = df.withColumn("id", F.format_string("n%03d", "id"))
    got = neighbours.knn_join(named, named, 4, skip_self=True, broadcast_rows=0).collect()
    expected = brute(rows, 4)
    assert sorted((r.query_id, r["rank"], r.neighbour_id) for r in got) == sorted(
        (f"n{i:03d}", n + 1, f"n{j:03d}") for i, near in expected.items() for n, j in enumerate(near))


def test_calibration_folds_lie_in_few_pieces(spark, monkeypatch):
    """A job for each step of a fit: a small table's folds must not be dealt to every shuffle partition."""
    made, take = [], learners.margins
    monkeypatch.setattr(learners, "margins", lambda name, model, rows: (made.append(rows.rdd.getNumPartitions()), take(name, model, rows))[1])
    data = training.prepare(corpus(spark), TRIAL)
    learners.fit("svm", {"maxIter": 3}, data.train, data.rows)
    assert made == [1, 1, 1]


def test_counts_of_terms_run_no_lambda_over_each_word(spark):
    docs = spark.createDataFrame([(i, "c", d.split()) for i, d in enumerate(DOCS)] + [(9, "c", [])], "comment_id long, category string, words array<string>")
    counts = features.term_counts(docs, ["category"])
    assert "lambda" not in counts._jdf.queryExecution().optimizedPlan().toString()
    assert {r.term: (r.ctf, r.df) for r in counts.collect()} == {
        "aa": (3, 2), "bb": (4, 3), "cc": (2, 2), "dd": (3, 2), "ee": (1, 1), "ff": (1, 1)}
