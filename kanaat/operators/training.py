"""Per-category ensembles: features, balance, search, vote, metrics, reports.

The driver loops over the (few) categories and learners; every fit, score and count is a Spark job."""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from itertools import product

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kanaat.functions import fixed_values as V
from kanaat.functions import text as T
from kanaat.operators import balance, features, forests, learners, linear, metrics, sampling, tables
from kanaat.operators.ensemble import vote
from kanaat.operators.ranking import hash_rank
from kanaat.session import durable, shared_path
from kanaat.sources.sinks import write_labels
from kanaat.sources.tables import spread


@dataclass(frozen=True)
class Profile:
    """How one trainer prepares texts and which learners it joins."""

    name: str
    terms: int
    bigrams: bool
    stop_words: tuple
    cleaned: bool
    test_fraction: float
    cap: int | None
    folds: int
    members: dict
    grids: dict
    wider_grids: dict


# ---- Fixed values: the two ensembles and their search grids -------------------------------------
SEVEN = Profile(
    name="seven", terms=300, bigrams=True, stop_words=tuple(V.STOP_WORDS_LONG), cleaned=True,
    test_fraction=0.30, cap=None, folds=10,
    members={
        "rf": {"numTrees": 100, "maxDepth": 8, "minInstancesPerNode": 5, "minRowsToSplit": 10},
        "et": {"numTrees": 100, "maxDepth": 8, "minInstancesPerNode": 5, "minRowsToSplit": 10},
        "bagging": {"numTrees": 100, "rows": 0.7, "terms": 0.7},
        "lr": {"C": 0.2},
        "svm": {"C": 0.2},
        "mnb": {"smoothing": 2.0},
        "gb": {"maxIter": 100, "maxDepth": 3, "stepSize": 0.03, "subsamplingRate": 0.7, "early_stop": True},
    },
    grids={
        "gb": [{"subsamplingRate": 0.6}, {"subsamplingRate": 0.7}],
        "rf": [{"maxDepth": d, "minInstancesPerNode": m, "minRowsToSplit": s, "numTrees": n}
               for d in (5, 6) for m in (5, 8) for s in (10, 15) for n in (100, 150)],
        "svm": [{"C": 0.1}, {"C": 0.2}],
    },
    wider_grids={},
)
ELEVEN = Profile(
    name="eleven", terms=1000, bigrams=False, stop_words=tuple(V.STOP_WORDS_SHORT), cleaned=False,
    test_fraction=0.20, cap=V.CLASS_CAP, folds=3,
    members={
        "rf": {}, "et": {}, "bagging": {}, "lr": {}, "knn": {}, "svm": {"C": 1.0}, "dt": {}, "gnb": {}, "mnb": {},
        "gb": {}, "ada": {"rounds": 50},
    },
    grids={"rf": [{"numTrees": 100, "maxDepth": 30}], "svm": [{"C": 1.0}]},
    wider_grids={"rf": [{"maxDepth": d, "numTrees": n} for d in (30, 20) for n in (100, 200)]},
)


@dataclass
class CategoryModel:
    category: str
    profile: Profile
    vectorizer: PipelineModel
    members: list
    path: str = "tuned"

    def score(self, rows: DataFrame) -> DataFrame:
        """rows (id, words) get ``p_<learner>``, ``p1`` and ``predicted``."""
        return self.judge(self.vectorizer.transform(rows).drop("_counts", "_scaled"))

    def judge(self, vectors: DataFrame) -> DataFrame:
        scored = vectors
        for member in self.members:
            scored = member.score(scored)
        return vote(scored, [f"p_{m.name}" for m in self.members])


def worded(rows: DataFrame, profile: Profile) -> DataFrame:
    """(comment_id, text, ..) with the profile's words; texts left blank by cleaning drop out."""
    keep = T.has_content(F.col("text")) if profile.cleaned else T.not_blank(F.col("text"))
    return _with_profile_words(rows.where(keep), profile)


def _with_profile_words(rows: DataFrame, profile: Profile) -> DataFrame:
    ready = rows.withColumn("_ready", T.clean_text(F.col("text")) if profile.cleaned else F.col("text"))
    return features.with_words(ready, "_ready", list(profile.stop_words), profile.bigrams).drop("_ready")


def staged(labelled: DataFrame, profile: Profile) -> DataFrame:
    """Labelled texts cut into words once and kept by category, so that training a category reads only
    its own rows."""
    spark = labelled.sparkSession
    path = shared_path(spark, "words")
    rows = worded(labelled, profile).select("comment_id", "category", "label", "words")
    write_labels(rows, path, append=False)
    return spark.read.schema(rows.schema).parquet(path)


@dataclass
class Prepared:
    vectorizer: PipelineModel
    train: DataFrame
    test: DataFrame
    rows: int
    balanced: bool


def prepare(rows: DataFrame, profile: Profile) -> Prepared:
    """Split, fit the vocabulary on the training part only, vectorise, balance: one category's rows,
    as staged or as (comment_id, category, label, text)."""
    if "words" not in rows.columns:
        rows = staged(rows, profile)
    parted = sampling.stratified_split(spread(rows), profile.test_fraction)
    # Comment ids may be of any type and may repeat; inside a training a row's place in random order names it.
    ranked = hash_rank(parted, [], "comment_id")
    parted = durable(ranked.select("category", F.col("rank").cast("long").alias("id"), "label", "words", "is_test"))
    spark = rows.sparkSession
    vocab = features.vocabulary(parted.where(~F.col("is_test")), ["category"], profile.terms)
    vectorizer = features.vectorizer(spark, vocab)
    vectors = vectorizer.transform(parted).drop("_counts", "_scaled")
    arrays = vectors.where(~F.col("is_test")).select(
        "id", F.col("label").cast("int").alias("label"), vector_to_array("features").alias("vector")
    )
    balanced, done = balance.oversample(durable(arrays))
    train = durable(
        balanced.select("id", F.col("label").cast("double").alias("label"), array_to_vector("vector").alias("features"))
    )
    test = vectors.where("is_test").select("id", F.col("label").cast("double").alias("label"), "features")
    rows = train.count()
    return Prepared(vectorizer, tables.in_pieces(train, rows), tables.in_pieces(durable(test), rows), rows, done)


@dataclass
class Search:
    """What a joint search found. ``chosen``: whole settings, ``chosen_of``: what the grids gave of them. ``scores``: the stored table (id, label, fold, a column for each learner's setting)
    of probabilities of rows that their model has not seen; ``tried``: for each joint set its columns and accuracy."""

    chosen: dict
    chosen_of: dict
    tried: list[tuple[dict, list[str], float]]
    scores: DataFrame
    curves: dict


def joint_sets(profile: Profile, grids: dict) -> list[dict]:
    """Every joint choice of one setting for each learner with a grid, the last learner's changing fastest."""
    names = list(grids)
    return [dict(zip(names, picked, strict=True)) for picked in product(*(range(len(grids[n])) for n in names))]


def search(profile: Profile, data: Prepared, grids: dict | None = None) -> Search:
    """Cross-validated accuracy of the whole ensemble for every joint choice of settings; the first best wins.

    A vote is a mean of its learners' probabilities, so each learner's setting is fitted once for each fold, whatever
    the others are set to, and a joint choice is a mean of stored columns: the sum of the settings is fitted, not
    their product. Trees of all folds and settings grow together, as linear learners are fitted; settings of trees that
    differ in depth or number share them."""
    grids = profile.grids if grids is None else grids
    spark = data.train.sparkSession
    ranked = sampling.stratified_folds(data.train.withColumn("category", F.lit("")), profile.folds, identity="id")
    folded = tables.in_pieces(ranked.select("id", "label", "features", "fold"), data.rows).persist()
    settings = {n: [{**base, **g} for g in grids.get(n, [{}])] for n, base in profile.members.items()}
    column = {(n, i): f"p_{n}_{i}" for n, own in settings.items() for i in range(len(own))}
    curves = {}

    def grown() -> DataFrame | None:
        return _tree_scores(folded, {n: own for n, own in settings.items() if n in learners.TREES}, profile.folds)

    def lined() -> DataFrame | None:
        return _margins(folded, {n: own for n, own in settings.items() if n in learners.LINEAR}, profile.folds, data.rows)

    def fitted(name: str, i: int, fold: int) -> DataFrame:
        seen, left = folded.where(F.col("fold") != fold), folded.where(F.col("fold") == fold)
        scored = learners.fit(name, settings[name][i], seen, data.rows).score(left)
        return scored.select("id", F.lit(column[name, i]).alias("name"), F.col(f"p_{name}").alias("p"))

    apart = [(n, i) for n, i in column if n not in learners.TREES + learners.LINEAR]
    trees, lines, *parts = learners.at_once(spark, [grown, lined, *(lambda n=n, i=i, k=k: fitted(n, i, k) for n, i in apart for k in range(profile.folds))])
    wide = folded.select("id", "label", "fold")
    if trees is not None:
        wide = wide.join(trees, "id")
    if lines is not None:
        lines = durable(folded.select("id", "label").join(lines, "id"))
        odds = {}
        for name, i in column:
            if name == "svm":
                curves[i] = learners.curve_of(lines.select("label", F.col(column[name, i]).alias("margin")))
                odds[column[name, i]] = learners.chance(F.col(column[name, i]), curves[i])
            elif name in learners.LINEAR:
                odds[column[name, i]] = 1.0 / (1.0 + F.exp(-F.col(column[name, i])))
        wide = wide.join(lines.select("id", *[p.alias(c) for c, p in odds.items()]), "id")
    if parts:
        plain = [column[own] for own in apart]
        wide = wide.join(tables.union_all(parts).groupBy("id").agg(*[F.max(F.when(F.col("name") == c, F.col("p"))).alias(c) for c in plain]), "id")
    path = shared_path(spark, "searched")
    wide.write.parquet(path)
    folded.unpersist()
    scores = spark.read.parquet(path)
    sets = joint_sets(profile, grids)
    voters = [[column[n, own.get(n, 0)] for n in profile.members] for own in sets]
    right = [F.avg(((sum_of(cols) / len(cols) > 0.5).cast("int") == F.col("label")).cast("double")).alias(f"a{j}") for j, cols in enumerate(voters)]
    by_fold = scores.groupBy("fold").agg(*right).collect()
    accuracy = [sum(r[f"a{j}"] for r in by_fold) / len(by_fold) for j in range(len(sets))]
    best = max(range(len(sets)), key=lambda j: (accuracy[j], -j))
    tried = [({n: grids[n][i] for n, i in own.items()}, cols, a) for own, cols, a in zip(sets, voters, accuracy, strict=True)]
    chosen = {n: settings[n][i] for n, i in sets[best].items()}
    return Search(chosen, tried[best][0], tried, scores, {"svm": curves.get(sets[best].get("svm", 0))})


def sum_of(columns: list[str]):
    return reduce(lambda a, b: a + b, [F.col(c) for c in columns])


def _tree_scores(folded: DataFrame, settings: dict, folds: int) -> DataFrame | None:
    """(id, p_<learner>_<setting>, ..): settings alike but for depth and number are one growth, the deepest and largest."""
    if not settings:
        return None
    growths: dict = {}
    for name, own in settings.items():
        for i, params in enumerate(own):
            shape = learners.forest(name, params)
            growths.setdefault((name, replace(shape, trees=0, depth=0)), []).append((i, shape))
    forests_, use = [], []
    for (name, _), alike in growths.items():
        for fold in range(folds):
            grown = replace(alike[0][1], trees=max(s.trees for _, s in alike), depth=max(s.depth for _, s in alike), unseen=fold)
            forests_.append(grown)
            use.append((name, fold, [(i, s.depth, s.trees) for i, s in alike]))
    terms = learners.number_of_terms(folded)
    grown = forests.grow(folded, forests_, terms)
    return forests.unseen_scores(folded, [(f"p_{name}_{i}", fold, trees, depth, many) for (name, fold, own), trees in zip(use, grown, strict=True)
                                          for i, depth, many in own], terms)


def _margins(folded: DataFrame, settings: dict, folds: int, rows: int) -> DataFrame | None:
    """(id, p_<learner>_<setting>, ..): margins of linear learners, all folds and settings fitted together."""
    wanted = [(n, i, k) for n, own in settings.items() for i in range(len(own)) for k in range(folds)]
    if not wanted:
        return None
    terms = learners.number_of_terms(folded)
    lines = linear.fit(folded, [learners.line(n, settings[n][i], rows, k) for n, i, k in wanted], terms, rows)
    return forests.unseen_scores(folded, [(f"p_{n}_{i}", k, own, None, None) for (n, i, k), own in zip(wanted, lines, strict=True)], terms)


def _accuracy(model: CategoryModel, vectors: DataFrame) -> float:
    right = (F.col("predicted") == F.col("label")).cast("double")
    return model.judge(vectors).agg(F.avg(right)).first()[0] or 0.0


def fit_members(profile: Profile, data: Prepared, chosen: dict | None = None, curve=None) -> list:
    """The members with their settings. ``curve``: of margins that a search has already made on unseen rows."""
    settings = {**profile.members, **(chosen or {})}
    grown = learners.fit_trees(settings, data.train) if sum(n in learners.TREES for n in settings) > 1 else {}

    def one(name: str) -> dict:
        return {name: learners.fit(name, settings[name], data.train, data.rows)}

    apart = [n for n in settings if n not in grown and n not in learners.LINEAR]
    made = learners.at_once(data.train.sparkSession, [lambda: learners.fit_linear(settings, data.train, data.rows, curve), *(lambda n=n: one(n) for n in apart)])
    made = {**grown, **{n: member for own in made for n, member in own.items()}}
    return [made[n] for n in profile.members]


def train_category(
    category: str, labelled: DataFrame, profile: Profile, tune: bool = True, searches: dict | None = None, fallbacks: bool = True
) -> tuple[CategoryModel, DataFrame]:
    """One category's ensemble and its train / test metrics.

    Search, then the default ensemble if the search fails, then the forest alone if that fails too;
    ``path`` tells which. Without ``fallbacks`` what fails raises, so that a result is always the whole training's. A search over a single joint set is settled without fits. Low training accuracy starts the
    wider search where the profile has one. ``searches`` gets what the search of the category found."""
    data = prepare(labelled, profile)
    data.train.persist()
    path, members = "tuned", None
    try:
        chosen, curve = {}, None
        if not tune:
            path = "default"
        elif all(len(g) == 1 for g in profile.grids.values()):
            chosen = {n: {**profile.members[n], **g[0]} for n, g in profile.grids.items()}
        else:
            found = search(profile, data)
            chosen, curve = found.chosen, found.curves["svm"]
            if searches is not None:
                searches[category] = found
        members = fit_members(profile, data, chosen, curve)
    except Exception as reason:
        if not fallbacks:
            data.train.unpersist()
            raise
        path = f"default after {type(reason).__name__}"
        try:
            members = fit_members(profile, data)
        except Exception as reason:
            path = f"forest after {type(reason).__name__}"
            members = [learners.fit("rf", profile.members.get("rf", {}), data.train, data.rows)]
    model = CategoryModel(category, profile, data.vectorizer, members, path)
    if tune and profile.wider_grids and path == "tuned" and _accuracy(model, data.train) < V.RETRY_ACCURACY:
        found = search(profile, data, profile.wider_grids)
        model = CategoryModel(category, profile, data.vectorizer, fit_members(profile, data, found.chosen, found.curves["svm"]), "wider")
    made = durable(report(model, data))
    data.train.unpersist()
    return model, made


def report(model: CategoryModel, data: Prepared) -> DataFrame:
    both = tables.union_all([
        model.judge(data.train).select("label", "predicted", F.lit(V.TRAIN).alias("split")),
        model.judge(data.test).select("label", "predicted", F.lit(V.TEST).alias("split")),
    ])
    named = both.withColumns({"category": F.lit(model.category), "model": F.lit("ensemble")})
    return metrics.weighted_metrics(named, ["category", "model", "split"])


def train_all(
    labelled: DataFrame, profile: Profile, tune: bool = True, most_categories: int = 1000, searches: dict | None = None, fallbacks: bool = True
) -> tuple[list[CategoryModel], DataFrame | None, dict[str, str]]:
    """Train every category of (comment_id, category, label, text); one that fails is left out and named, one without any usable text has nothing to train and is skipped.
    ``fallbacks``: as in ``train_category``.

    With a cap, each class gives at most that many random rows to training; score the others with
    ``rows_to_score``."""
    if profile.cap is not None:
        marked = sampling.capped_class_sample(labelled, profile.cap)
        labelled = marked.where("in_sample").drop("in_sample")
    rows = staged(labelled, profile)
    names = [r.category for r in rows.select("category").distinct().limit(most_categories + 1).collect()]
    if len(names) > most_categories:
        raise ValueError(f"more than {most_categories} categories")
    models, reports, failed = [], [], {}

    def one(name: str):
        try:
            return train_category(name, rows.where(F.col("category") == name), profile, tune, searches, fallbacks)
        except Exception as reason:
            return f"{type(reason).__name__}: {reason}"

    for name, made in zip(sorted(names), learners.at_once(rows.sparkSession, [lambda n=n: one(n) for n in sorted(names)]), strict=True):
        if isinstance(made, str):
            failed[name] = made
        else:
            models.append(made[0])
            reports.append(made[1])
    return models, (tables.union_all(reports) if reports else None), failed


def rows_to_score(labelled: DataFrame, profile: Profile) -> DataFrame:
    return sampling.capped_class_sample(labelled, profile.cap).where(~F.col("in_sample")).drop("in_sample")


def row_name():
    """Names a row to score by what it holds: ids may be of any type, and only equal rows share a name."""
    return F.sha2(F.concat_ws("\u0000", F.col("comment_id").cast("string"), "text"), 256)


def predict_wide(comments: DataFrame, models: list[CategoryModel], missing: list[str] | None = None, fallbacks: bool = True) -> DataFrame:
    """One 0/1 column per category on every comment, in a single pass over the texts. A model that
    cannot be applied, or is ``missing`` as it could not be loaded, leaves zeros; with ``missing`` given,
    ``failed_categories`` lists both kinds. Without ``fallbacks`` a model that cannot be applied raises."""
    given, out = comments.columns, comments.withColumn("id", row_name())
    cut, names, broken = {}, [], list(missing or [])
    for model in models:
        way = (model.profile.cleaned, model.profile.bigrams, model.profile.stop_words)
        if way not in cut:  # texts are cut into words once for all models that want them alike
            cut[way] = f"_words{len(cut)}"
            out = _with_profile_words(out, model.profile).withColumnRenamed("words", cut[way])
    for model in models:
        words = cut[(model.profile.cleaned, model.profile.bigrams, model.profile.stop_words)]
        names.append(model.category)
        try:
            judged = model.score(out.withColumn("words", F.col(words)))
            out = judged.withColumn(model.category, F.col("predicted"))
        except Exception as reason:
            if not fallbacks:
                raise RuntimeError(f"not predicted: {model.category}: {type(reason).__name__}: {reason}") from reason
            out = out.withColumn(model.category, F.lit(0))
            broken.append(model.category)
        out = out.select(*given, "id", *cut.values(), *names)
    out = out.drop("id", *cut.values())
    if missing is None:
        return out
    zeros = {name: F.lit(0) for name in missing}
    return out.withColumns({**zeros, "failed_categories": F.array(*map(F.lit, broken)).cast("array<string>")})


def predict_long(labelled: DataFrame, models: list[CategoryModel]) -> DataFrame:
    """Each labelled row scored by its own category's model, with truth and prediction side by side."""
    parts = []
    for model in models:
        rows = worded(labelled.where(F.col("category") == model.category), model.profile)
        scored = model.score(rows.withColumn("id", row_name()))
        parts.append(scored.select("comment_id", "category", "text", "label", "p1", "predicted"))
    return tables.union_all(parts)


def shortened(profile: Profile, **changes) -> Profile:
    """The same profile with some learners set differently, for trial runs."""
    return replace(profile, members={**profile.members, **changes})
