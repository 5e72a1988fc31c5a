"""The corpus pipeline: documents that two quality stages keep, one of each group of near copies, without secrets,
packed into sequences. Each stage works on all that the one before kept; run() writes and rereads what each returns.

Null and empty texts have too few words and go in the quality rules; where they reach a later stage, they stay and are
one end token each. Texts of any length are taken whole. Rows that are repeated or alike are one row after the n-gram
join, the one with the smallest id. Null ids stay unless their text is a copy of a row with an id. Empty tables pass.
All stages but the last return the columns of their rows as they were, also those whose names an operator computes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kanaat.llm import ngram_join, packing, quality_rules, secrets, site_quality
from kanaat.llm.batches import set_aside
from kanaat.llm.registry import table
from kanaat.llm.storage import stored


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the site-aware classifier keeps."""
    return site_quality.clean(docs, table(spark, sf_dir, "labels"))


def quality_rule_trees(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the limits and the boosted trees keep."""
    return quality_rules.clean(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, the one with the smallest id."""
    return ngram_join.one_of_each(docs)


def secret_masking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark; n_chars is the new text's."""
    rows, own = set_aside(docs, ["text", "n_chars"])
    found = secrets.with_secrets(rows).withColumn("text", secrets.masked(F.col("text"), F.col("secrets")))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.size("secrets") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return own(found)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents with their sequences and places."""
    return packing.packed_sequences(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rule_trees),
    ("ngram_jaccard_join", near_copies),
    ("secret_scan", secret_masking),
    ("best_fit_packing", sequence_packing),
]
# Tokenising, boosting and linking have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
