"""The base learners behind one interface: fit on (id, features, label), add a column with the
probability of class 1, save and load.

Forests, extra trees, bagged trees and single trees are grown by `forests`, logistic regression and support vectors
are fitted by `linear`, all of a call together. The support vector machine is linear with calibrated probabilities."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    NaiveBayes,
    NaiveBayesModel,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kanaat.functions.fixed_values import NEIGHBOURS, SEED
from kanaat.operators import forests, linear
from kanaat.operators.neighbours import BROADCAST_ROWS, knn_classify, matrix_of, nearest
from kanaat.operators.ranking import hash_rank
from kanaat.operators.tables import in_pieces
from kanaat.session import durable, fits

SMALLEST = 1e-10


def _columns(name: str) -> dict:
    return {"predictionCol": f"_{name}_class", "probabilityCol": f"_{name}_p", "rawPredictionCol": f"_{name}_raw"}


def _probability(name: str) -> Column:
    return vector_to_array(F.col(f"_{name}_p"))[1]


def _tidy(df: DataFrame, name: str) -> DataFrame:
    return df.drop(f"_{name}_class", f"_{name}_p", f"_{name}_raw")


@dataclass
class Plain:
    """A fitted MLlib classifier that gives probabilities."""

    name: str
    model: object

    def score(self, df: DataFrame) -> DataFrame:
        scored = self.model.transform(df).withColumn(f"p_{self.name}", _probability(self.name))
        return _tidy(scored, self.name)

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)


@dataclass
class Linear:
    """A line and its margins; ``p_<name>`` is their logistic curve."""

    name: str
    line: linear.Line

    def margin(self, df: DataFrame) -> Column:
        return forests.scorer(df.sparkSession, self.line, len(self.line.weights))(F.col("features"))

    def score(self, df: DataFrame) -> DataFrame:
        return df.withColumn(f"p_{self.name}", F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin(df))))

    def save(self, path: str) -> None:
        row = [([float(w) for w in self.line.weights], self.line.intercept)]
        SparkSession.active().createDataFrame(row, "weights array<double>, intercept double").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def read(cls, spark: SparkSession, name: str, path: str) -> Linear:
        held = spark.read.parquet(path).first()
        return cls(name, linear.Line(np.array(held.weights), held.intercept))


@dataclass
class Calibrated:
    """A linear margin with a logistic curve laid over it."""

    name: str
    model: Linear
    curve: LogisticRegressionModel

    def score(self, df: DataFrame) -> DataFrame:
        return df.withColumn(f"p_{self.name}", chance(self.model.margin(df), self.curve))

    def save(self, path: str) -> None:
        self.model.save(f"{path}/margin")
        self.curve.write().overwrite().save(f"{path}/curve")


@dataclass
class Neighbours:
    """The training rows themselves. A base of checked size travels to the tasks, a larger one is joined."""

    name: str
    base: DataFrame
    k: int = NEIGHBOURS
    most_rows: int = BROADCAST_ROWS

    def score(self, df: DataFrame) -> DataFrame:
        if not fits(self.base, self.most_rows):
            queries = df.select(
                F.col("id"), F.lit(0).alias("grp"), vector_to_array("features").alias("vector")
            )
            votes = knn_classify(queries.dropDuplicates(["id"]), self.base.withColumn("grp", F.lit(0)), self.k)
            return df.join(
                votes.select(F.col("query_id").alias("id"), F.col("p1").alias(f"p_{self.name}")), "id", "left"
            )
        held = self.base.orderBy("id").toPandas()
        ids, labels, k = held["id"].to_numpy(), held["label"].to_numpy().astype(float), self.k
        matrix = matrix_of(held["vector"])
        by_id = dict(zip(ids.tolist(), labels.tolist()))

        @F.pandas_udf("double")
        def share(vectors: pd.Series) -> pd.Series:
            if vectors.empty:
                return pd.Series(dtype="float64")
            found = nearest(range(len(vectors)), matrix_of(vectors), ids, matrix, k, False)
            voted = found["neighbour_id"].map(by_id).groupby(found["query_id"].to_numpy()).mean()
            return pd.Series(voted.reindex(range(len(vectors))).to_numpy())

        return df.withColumn(f"p_{self.name}", share(vector_to_array("features")))

    def save(self, path: str) -> None:
        self.base.write.mode("overwrite").parquet(path)


@dataclass
class Boosted:
    """Stumps, each fitted to the rows the ones before were unsure about, as flat arrays: the term and cut of each, and
    the log odds of class 1 up to the cut and beyond. All are scored in one pass."""

    name: str
    term: list = field(default_factory=list)
    cut: list = field(default_factory=list)
    low: list = field(default_factory=list)
    high: list = field(default_factory=list)
    terms: int = 0

    @staticmethod
    def log_odds(p: Column) -> Column:
        inside = F.least(F.greatest(p, F.lit(SMALLEST)), F.lit(1.0 - SMALLEST))
        return F.log(inside / (F.lit(1.0) - inside))

    def add(self, stump) -> None:
        """Takes over a fitted stump; one without a cut says the same of every row."""
        root = stump._java_obj.rootNode()
        self.terms = stump.numFeatures

        def odds(node) -> float:
            stats = list(node.impurityStats().stats())
            p = min(max(stats[1] / sum(stats), SMALLEST), 1.0 - SMALLEST)
            return float(np.log(p / (1.0 - p)))

        if stump.depth:
            sides = root.leftChild(), root.rightChild()
            self.term.append(int(root.split().featureIndex()))
            self.cut.append(float(root.split().threshold()))
        else:
            sides = root, root
            self.term.append(0)
            self.cut.append(0.0)
        self.low.append(odds(sides[0]))
        self.high.append(odds(sides[1]))

    def score(self, df: DataFrame) -> DataFrame:
        return df.withColumn(f"p_{self.name}", forests.scorer(df.sparkSession, Stumps(*map(np.array, (self.term, self.cut, self.low, self.high))), self.terms)(F.col("features")))

    def save(self, path: str) -> None:
        rows = list(zip(range(len(self.term)), self.term, self.cut, self.low, self.high, [self.terms] * len(self.term)))
        SparkSession.active().createDataFrame(rows, "place int, term int, cut double, low double, high double, terms int").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def read(cls, spark: SparkSession, name: str, path: str) -> Boosted:
        rows = spark.read.parquet(path).orderBy("place").collect()
        return cls(name, *([r[c] for r in rows] for c in ("term", "cut", "low", "high")), rows[0].terms)


@dataclass
class Stumps:
    term: np.ndarray
    cut: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def score(self, weights: np.ndarray) -> np.ndarray:
        odds = np.where(weights[:, self.term] <= self.cut, self.low, self.high).mean(axis=1)
        return 1.0 / (1.0 + np.exp(-odds))


@dataclass
class Grown:
    """A forest as flat arrays."""

    name: str
    trees: forests.Trees
    terms: int

    def score(self, df: DataFrame) -> DataFrame:
        return df.withColumn(f"p_{self.name}", forests.scorer(df.sparkSession, self.trees, self.terms)(F.col("features")))

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        row = [(self.terms, bytearray(self.trees.bytes()))]
        spark.createDataFrame(row, "terms int, trees binary").coalesce(1).write.mode("overwrite").parquet(path)


TREES = ("rf", "et", "bagging", "dt")
LINEAR = ("lr", "svm")


def forest(name: str, params: dict, unseen: int | None = None) -> forests.Forest:
    """How a learner's trees grow."""
    shape = {"depth": params.get("maxDepth", 30), "min_leaf": params.get("minInstancesPerNode", 1), "min_split": params.get("minRowsToSplit", 2),
             "unseen": unseen}
    trees = params.get("numTrees", {"bagging": 10, "dt": 1}.get(name, 100))
    if name == "rf":
        return forests.Forest(trees=trees, seed=SEED, **shape)
    if name == "et":
        return forests.Forest(trees=trees, rows=None, drawn=True, seed=SEED + 1, **shape)
    if name == "bagging":
        return forests.Forest(trees=trees, rows=params.get("rows", 1.0), per_node=1.0, per_tree=params.get("terms", 1.0), seed=SEED + 2, **shape)
    if name == "dt":
        return forests.Forest(trees=1, rows=None, per_node=1.0, seed=SEED, **shape)
    raise ValueError(name)


def number_of_terms(train: DataFrame) -> int:
    return train.first().features.size


def fit_trees(settings: dict[str, dict], train: DataFrame) -> dict[str, Grown]:
    """All tree learners of ``settings``, grown together."""
    names = [n for n in settings if n in TREES]
    if not names:
        return {}
    terms = number_of_terms(train)
    grown = forests.grow(train, [forest(n, settings[n]) for n in names], terms)
    return {n: Grown(n, trees, terms) for n, trees in zip(names, grown, strict=True)}


def at_once(spark: SparkSession, calls: list) -> list:
    """Results of calls that each run Spark jobs, a few at a time: a small table's jobs leave most cores idle."""
    with ThreadPoolExecutor(min(16, max(2, spark.sparkContext.defaultParallelism), max(1, len(calls)))) as pool:
        return [done.result() for done in [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]]


def estimator(name: str, params: dict):
    """The MLlib estimator of a learner."""
    given = params
    shared = {"featuresCol": "features", "labelCol": "label", **_columns(name)}
    if name == "gnb":
        return NaiveBayes(modelType="gaussian", **shared, **given)
    if name == "mnb":
        return NaiveBayes(modelType="multinomial", **shared, **{"smoothing": 1.0, **given})
    if name == "gb":
        shared_gb = {"featuresCol": "features", "labelCol": "label", "predictionCol": f"_{name}_class"}
        made = GBTClassifier(**{"maxIter": 100, "maxDepth": 3, "stepSize": 0.1, "seed": SEED, **given}, **shared_gb)
        return made.setProbabilityCol(f"_{name}_p").setRawPredictionCol(f"_{name}_raw")
    raise ValueError(name)


def fit(name: str, params: dict, train: DataFrame, rows: int):
    """Fit one learner on (id, features, label double)."""
    if name in TREES:
        return fit_trees({name: params}, train)[name]
    if name in LINEAR:
        return fit_linear({name: params}, train, rows)[name]
    if name == "knn":
        base = train.select("id", F.col("label"), vector_to_array("features").alias("vector"))
        return Neighbours(name, base, params.get("k", NEIGHBOURS))
    if name == "ada":
        return _boost(name, train, params.get("rounds", 50))
    if name == "gb" and params.get("early_stop"):
        inner = {k: v for k, v in params.items() if k != "early_stop"}
        held_out = F.md5(F.concat(F.lit("stop|"), F.col("id").cast("string"))) < "3333"
        watched = train.withColumn("_held_out", held_out)
        return Plain(name, estimator(name, inner).setValidationIndicatorCol("_held_out").fit(watched))
    return Plain(name, estimator(name, params).fit(train))


def _boost(name: str, train: DataFrame, rounds: int, store_every: int = 10) -> Boosted:
    weighted, made = train.withColumn("_weight", F.lit(1.0)), Boosted(name)
    shared = {"featuresCol": "features", "labelCol": "label", "weightCol": "_weight", **_columns(name)}
    for i in range(rounds):
        stump = DecisionTreeClassifier(maxDepth=1, seed=SEED + i, **shared).fit(weighted)
        made.add(stump)
        sure = Boosted.log_odds(_probability(name)) * F.when(F.col("label") == 1, 1.0).otherwise(-1.0)
        scored = stump.transform(weighted).withColumn("_weight", F.col("_weight") * F.exp(sure * -0.5))
        weighted = _tidy(scored, name)
        if i % store_every == store_every - 1:
            weighted = durable(weighted)
    return made


def curve_of(margins: DataFrame) -> LogisticRegressionModel:
    """The logistic curve from (label, margin) of rows that their model has not seen to the chance of class 1."""
    return LogisticRegression().fit(margins.select("label", array_to_vector(F.array("margin")).alias("features")))


def chance(margin: Column, curve: LogisticRegressionModel) -> Column:
    slope, shift = float(curve.coefficients[0]), float(curve.intercept)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(margin * slope + shift)))


def margins(name: str, model: Linear, rows: DataFrame) -> DataFrame:
    return rows.select("id", "label", model.margin(rows).alias("margin"))


def line(name: str, params: dict, rows: int, unseen: int | None = None) -> linear.Fit:
    """How a linear learner is fitted. ``C`` is the inverse penalty per training row."""
    if extra := set(params) - {"C", "maxIter"}:
        raise ValueError(f"{name}: {sorted(extra)}")
    loss, steps = {"lr": ("logistic", 1000), "svm": ("hinge", 100)}[name]
    return linear.Fit(loss, 1.0 / (params.get("C", 1.0) * rows), params.get("maxIter", steps), unseen)


def fit_linear(settings: dict[str, dict], train: DataFrame, rows: int, curve: LogisticRegressionModel | None = None, folds: int = 3) -> dict:
    """All linear learners of ``settings``, fitted together. The curve over the support vector machine's margins, if
    none is given, is fitted to margins of rows their model has not seen."""
    names = [n for n in settings if n in LINEAR]
    if not names:
        return {}
    terms, parts = number_of_terms(train), None
    wanted = [line(n, settings[n], rows) for n in names]
    if "svm" in names and curve is None:
        parts = hash_rank(train, ["label"], "id").withColumn("fold", ((F.col("rank") - 1) % folds).cast("int")).drop("rank")
        parts = in_pieces(parts, rows).persist()
        wanted += [line("svm", settings["svm"], rows, i) for i in range(folds)]
    lines = linear.fit(train if parts is None else parts, wanted, terms, rows)
    out = {n: Linear(n, own) for n, own in zip(names, lines)}
    if parts is not None:
        unseen = [margins("svm", Linear("svm", own), parts.where(F.col("fold") == i)) for i, own in enumerate(lines[len(names):])]
        curve = curve_of(durable(reduce(lambda a, b: a.unionByName(b), unseen)))
        parts.unpersist()
    if "svm" in names:
        out["svm"] = Calibrated("svm", out["svm"], curve)
    return out


LOADERS = {
    "gnb": NaiveBayesModel, "mnb": NaiveBayesModel, "gb": GBTClassificationModel,
}


def load(spark: SparkSession, name: str, path: str):
    if name in TREES:
        held = spark.read.parquet(path).first()
        return Grown(name, forests.Trees.of(bytes(held.trees)), held.terms)
    if name == "knn":
        return Neighbours(name, spark.read.parquet(path))
    if name == "ada":
        return Boosted.read(spark, name, path)
    if name == "svm":
        return Calibrated(name, Linear.read(spark, name, f"{path}/margin"), LogisticRegressionModel.load(f"{path}/curve"))
    if name == "lr":
        return Linear.read(spark, name, path)
    return Plain(name, LOADERS[name].load(path))
