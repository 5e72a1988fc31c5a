"""Quality rules: fixed limits first, then gradient-boosted trees over document statistics.

Statistics of every whole text are computed in numpy on Arrow batches. The trees are fitted on the driver on a bounded
sample of labelled rows (`labelled.SAMPLE_ROWS`), travel to the tasks as a few flat arrays and score a batch level
by level. More symbols, repetition, shouting or capitals never raise the score, more distinct words never lower it.

Null and empty texts have no words and fail the limits. Repeated rows get equal verdicts, null ids are kept.
Without labels of both classes only the limits decide. `judged` replaces columns that have a computed column's name,
`clean` returns the rows' own columns unchanged, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kanaat.llm import boosting
from kanaat.llm.batches import set_aside, with_text_columns
from kanaat.llm.labelled import SAMPLE_ROWS, sampled_features
from kanaat.llm.registry import query, table
from kanaat.llm.statistics import FEATURES, features, text_statistics

# Fixed limits: fewer words than this, or more than this percentage of words in repeated windows, fail.
LEAST_WORDS, MOST_REPEATED = 10, 20
# Kept at this probability of good quality or more.
KEEP_FROM = 0.5
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FIELDS = ", ".join(f"{c} bigint" for c in COUNTS) + ", base_failed boolean, quality_score double, kept boolean"


def fitted(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> boosting.Trees:
    """Trees for ``labels.quality``, fitted on the sample's texts."""
    x, y = sampled_features(docs, labels, "quality", sample_rows)
    return boosting.fit(x, y, list(FEATURES.values()))


def judged(docs: DataFrame, trees: boosting.Trees, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) with the counts, the score and the verdict ``kept``."""
    def make(texts):
        stats = text_statistics(texts)
        n, repeated = stats["n_words"], stats["n_repeat_words"]
        failed = (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED * n)
        score = trees.probability(features(stats))
        good = score >= KEEP_FROM if len(trees.value) else np.ones(len(n), bool)
        return {c: stats[c] for c in COUNTS} | {"base_failed": failed, "quality_score": score, "kept": ~failed & good}

    return with_text_columns(docs, text_col, make, FIELDS, keep)


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that pass, with their own columns."""
    rows, own = set_aside(docs, ["text"])
    return own(judged(rows, fitted(docs, labels)).where("kept"))


@query("op3_boosted_quality_rules")
def op3_boosted_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    trees = fitted(docs, table(spark, folder, "labels"))
    return judged(docs, trees, keep=["doc_id"]).select("doc_id", *COUNTS, "base_failed", "kept", F.col("quality_score"))
