"""Quality classifier by hierarchical empirical Bayes: a document's own evidence, and that of its site.

A logistic regression over document statistics (`statistics.FEATURES`), fitted on a bounded sample of labelled rows,
gives each text a probability of good quality. Summed by host and path these become rates: a path's rate is shrunk to
its host's and a host's to the corpus's, by beta priors whose strengths come from how much hosts and paths differ. A
document's log odds are its own plus what its path (without itself) lies above or below the corpus, at most
`SITE_LIMIT`, so that a clean document on a poor site stays and a sparse site decides nothing.

Sums are combined before they are shuffled, so a host with a third of all rows is no hot key; the table of rates is
sent to all tasks while it is small and joined by shuffle beyond. Null hosts and paths are sites of their own. Null and
empty texts are scored as texts without words. Repeated rows get equal verdicts apart from leaving themselves out once;
null ids are kept. Without labels of both classes nothing is rejected. `judged` replaces columns that have a computed
column's name, `clean` returns the rows' own columns unchanged, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kanaat.llm import logistic
from kanaat.llm.batches import set_aside, with_text_columns
from kanaat.llm.labelled import SAMPLE_ROWS, sampled_features
from kanaat.llm.registry import query, table
from kanaat.llm.statistics import features, text_statistics
from kanaat.llm.storage import stored
from kanaat.session import small_side

KEEP_FROM, SITE_LIMIT = 0.5, 1.5
# Probabilities stay inside these, prior strengths too.
SUREST, STRENGTHS = 0.998, (1.0, 1000.0)


@dataclass
class Model:
    of_text: logistic.Logistic
    decides: bool


def fitted(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    x, y = sampled_features(docs, labels, "quality", sample_rows)
    return Model(logistic.fit(x, y), len(np.unique(y)) == 2)


def with_evidence(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) with ``_p``, the probability by the text alone."""
    def make(texts):
        return {"_p": np.clip(model.of_text.probability(features(text_statistics(texts))), 1 - SUREST, SUREST)}

    return with_text_columns(docs, text_col, make, "_p double", keep)


def strength(mean: float, variance: float, spread: float, groups: int, rows: int) -> float:
    """Beta prior strength from the squares of group means around ``mean`` (weighted by rows), less what chance makes."""
    between = max((spread - (groups - 1) * variance) / max(rows, 1), 1e-9)
    return float(np.clip(mean * (1 - mean) / between - 1, *STRENGTHS))


def site_rates(evidence: DataFrame, host_col: str, path_col: str) -> tuple[DataFrame, dict]:
    """For each (host, path) its rows and sum of ``_p`` and its host's, and the corpus's mean and prior strengths."""
    paths = stored(evidence.groupBy(F.col(host_col).alias("_host"), F.col(path_col).alias("_path")).agg(
        F.count(F.lit(1)).alias("n_path"), F.sum("_p").alias("s_path"), F.sum(F.col("_p") * F.col("_p")).alias("q")), "site-sums")
    hosts = paths.groupBy(F.col("_host").alias("_h")).agg(F.sum("n_path").alias("n_host"), F.sum("s_path").alias("s_host"))
    n, s, q = paths.agg(F.sum("n_path"), F.sum("s_path"), F.sum("q")).first()
    n, mean = n or 0, (s / n if n else 0.5)
    variance = max(q / n - mean * mean, 1e-9) if n else 1e-9
    rates = paths.join(hosts, F.col("_host").eqNullSafe(F.col("_h"))).drop("_h", "q")
    in_host = rates.agg(F.sum(F.col("n_path") * F.pow(F.col("s_path") / F.col("n_path") - F.col("s_host") / F.col("n_host"), 2)), F.count(F.lit(1))).first()
    of_hosts = hosts.agg(F.sum(F.col("n_host") * F.pow(F.col("s_host") / F.col("n_host") - mean, 2)), F.count(F.lit(1))).first()
    return rates, {"mean": mean, "host": strength(mean, variance, of_hosts[0] or 0.0, of_hosts[1], n),
                   "path": strength(mean, variance, in_host[0] or 0.0, in_host[1], n)}


def log_odds(p):
    return F.log(p / (1 - p))


def judged(evidence: DataFrame, model: Model, host_col: str, path_col: str) -> DataFrame:
    """``evidence`` with ``host_rate``, ``path_rate``, ``score`` and ``kept``."""
    rates, prior = site_rates(evidence.select(host_col, path_col, "_p"), host_col, path_col)
    joined = evidence.join(small_side(rates), F.col(host_col).eqNullSafe(F.col("_host")) & F.col(path_col).eqNullSafe(F.col("_path")), "left")
    k, h, mean = prior["host"], prior["path"], prior["mean"]
    host = (F.col("s_host") - F.col("_p") + k * mean) / (F.col("n_host") - 1 + k)
    path = (F.col("s_path") - F.col("_p") + h * F.col("host_rate")) / (F.col("n_path") - 1 + h)
    inside = lambda c: F.least(F.greatest(c, F.lit(1 - SUREST)), F.lit(SUREST))
    site = log_odds(F.col("path_rate")) - float(np.log(mean / (1 - mean))) if 0 < mean < 1 else F.lit(0.0)
    bounded = F.least(F.greatest(site, F.lit(-SITE_LIMIT)), F.lit(SITE_LIMIT))
    return (joined.withColumn("host_rate", inside(host)).withColumn("path_rate", inside(path))
            .withColumn("score", 1 / (1 + F.exp(-(log_odds(F.col("_p")) + bounded))))
            .withColumn("kept", (F.col("score") >= KEEP_FROM) if model.decides else F.lit(True))
            .drop("_host", "_path", "n_path", "s_path", "n_host", "s_host"))


def clean(docs: DataFrame, labels: DataFrame, host_col: str = "source", path_col: str = "lang") -> DataFrame:
    """The rows that are kept, with their own columns."""
    model = fitted(docs, labels)
    rows, own = set_aside(docs, ["text"])
    host, path = (rows.columns[docs.columns.index(c)] for c in (host_col, path_col))
    return own(judged(with_evidence(rows, model), model, host, path).where("kept"))


@query("op6_site_empirical_bayes")
def op6_site_empirical_bayes(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = fitted(docs, table(spark, folder, "labels"))
    # The table has a host for each text and no path; its language takes that place.
    evidence = stored(with_evidence(docs, model, keep=["doc_id", "source", "lang"]), "site-evidence")
    return judged(evidence, model, "source", "lang").select("doc_id", F.col("_p").alias("text_score"), "host_rate", "path_rate", "score", "kept")
