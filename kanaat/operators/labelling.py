"""Labels from a pluggable labeller (a language model, a rule), asked once per distinct question."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kanaat.functions.fixed_values import LABEL_ATTEMPTS, SEED
from kanaat.functions.labels import parse_answer, render_prompt
from kanaat.functions.text import not_blank
from kanaat.operators import sampling
from kanaat.operators.categories import MOST_CATEGORIES, dimension
from kanaat.operators.ranking import HASH_DIGITS, with_hash_order
from kanaat.session import durable, shared_path

Labeller = Callable[[str], str]


# Rows whose prompts are held as Python strings, and whose answers are sent back, at once.
ASKED_ROWS = 128


def _ask(load: Callable[[], Labeller], attempts: int, pause: float, batches):
    ask = load()
    for batch in batches:
        for start in range(0, batch.num_rows, ASKED_ROWS):
            part = batch.slice(start, ASKED_ROWS)
            answers, used, failed = [], [], []
            for prompt in part.column("prompt"):
                prompt = prompt.as_py()
                for attempt in range(1, attempts + 1):
                    try:
                        answer, broken = ask(prompt), 0
                        break
                    except Exception:  # try again, then settle for 0 and say so
                        answer, broken = None, 1
                        if attempt < attempts:
                            time.sleep(pause)
                answers.append(answer)
                used.append(attempt)
                failed.append(broken)
            yield pa.RecordBatch.from_arrays(
                [part.column("question"), part.column("text"), pa.array(answers, pa.string()), pa.array(used, pa.int32()),
                 pa.array(failed, pa.int32())], ["question", "text", "answer", "attempts", "failed"])


ANSWERS = "question string, version string, label int, attempts int, failed int"


@dataclass(frozen=True)
class LabelCache:
    """Answers that outlast a job: a table of (question digest, labeller's version) below ``folder``, appended to.

    An answer is found again by slices, later runs and feeds of the same labeller. Failed questions are written, so
    that a run can report them, and not found again: they are asked anew. Of two answers to one question, written at
    once by two runs, the smaller label counts."""

    folder: str
    version: str = "1"

    def known(self, spark: SparkSession) -> DataFrame:
        """(question, label, attempts, failed): one row for each question that has been answered."""
        try:
            held = spark.read.schema(ANSWERS).parquet(self.folder)
        except AnalysisException as missing:
            if "PATH_NOT_FOUND" not in str(missing):
                raise
            held = spark.createDataFrame([], ANSWERS)
        answered = held.where((F.col("version") == self.version) & (F.col("failed") == 0))
        best = answered.groupBy("question").agg(F.min(F.struct("label", "attempts", "failed")).alias("a"))
        return best.select("question", "a.*")

    def add(self, answers: DataFrame) -> DataFrame:
        """Writes (question, label, attempts, failed) once and reads it back: nothing is asked a second time."""
        spark = answers.sparkSession
        place = shared_path(spark, "answers")
        answers.write.parquet(place)
        fresh = spark.read.schema(answers.schema).parquet(place)
        fresh.select("question", F.lit(self.version).alias("version"), "label", "attempts", "failed").write.mode("append").parquet(self.folder)
        return fresh


def label_comments(
    comments: DataFrame,
    load: Callable[[], Labeller],
    pairs: list[tuple[str, str]] | None = None,
    attempts: int = LABEL_ATTEMPTS,
    pause: float = 1.0,
    cache: LabelCache | None = None,
) -> DataFrame:
    """comments (comment_id, category, text) get ``label``, ``attempts`` and ``failed``.

    Equal (category, text) questions are asked once. Questions are keyed by a digest and carry their
    text along, so the join back moves only ids and digests of the comments, and a text copied into a
    third of all rows is one question. A category without a description can't be asked about: its
    comments stay, with label 0, no attempt and ``failed`` set. With a ``cache`` only questions it does not hold are
    asked, when this is called, and their answers are added to it."""
    asked = comments.where(not_blank(F.col("text"))).withColumn(
        "question", F.sha2(F.concat_ws("\u0000", "category", "text"), 256)
    )
    distinct = asked.select("question", "category", "text").dropDuplicates(["question"])
    known = F.broadcast(dimension(comments.sparkSession, pairs))
    held = cache.known(comments.sparkSession) if cache else None
    if held is not None:
        held = held.join(distinct.select("question"), "question", "left_semi")
        distinct = distinct.join(held.select("question"), "question", "left_anti")
    prompts = distinct.join(known, "category").select(
        "question", "text", render_prompt(F.col("text"), F.col("category"), F.col("description")).alias("prompt")
    )
    answers = prompts.mapInArrow(
        partial(_ask, load, attempts, pause), "question string, text string, answer string, attempts int, failed int"
    ).withColumn("label", F.coalesce(parse_answer(F.col("answer")), F.lit(0)))
    if cache:
        answers = cache.add(answers.select("question", "text", "label", "attempts", "failed"))
        texts = asked.select("question", "text").dropDuplicates(["question"])
        answers = answers.unionByName(durable(held.join(texts, "question")))
    found = asked.drop("text").join(answers.drop("answer"), "question").select(
        *comments.columns, "label", "attempts", "failed"
    )
    unknown = asked.join(known.select("category"), "category", "left_anti").select(
        *comments.columns, F.lit(0).alias("label"), F.lit(0).alias("attempts"), F.lit(1).alias("failed")
    )
    return found.unionByName(unknown)


def label_until_quota(
    comments: DataFrame,
    load: Callable[[], Labeller],
    target_positive: int,
    target_negative: int,
    pairs: list[tuple[str, str]] | None = None,
    first_share: float = 0.01,
    seed: int = SEED,
    pause: float = 1.0,
    cache: LabelCache | None = None,
) -> DataFrame:
    """The quota sample without labelling everything: comments are labelled in slices of the random
    order, each twice the one before, until every category is full. The sample is the same as over all. Answers are
    kept in ``cache``, by default one of this call's own, so that a question is asked once over all slices."""
    cache = cache or LabelCache(shared_path(comments.sparkSession, "labels"))
    placed = with_hash_order(comments, "comment_id", seed)
    size, done, share = 16**HASH_DIGITS, 0, first_share
    labelled, done_with = None, []
    categories = comments.select("category").distinct().count()
    while done < size:
        until = min(size, max(done + 1, int(size * share)))
        part = placed.where((F.col("_bucket") >= done) & (F.col("_bucket") < until)).drop("_key", "_bucket")
        if done_with:  # what is full needs no more labels
            part = part.where(~F.coalesce(F.col("category").isin(done_with), F.lit(False)))
        fresh = durable(label_comments(part, load, pairs, pause=pause, cache=cache))
        labelled = fresh if labelled is None else labelled.unionByName(fresh)
        done, share = until, share * 2
        full = labelled.groupBy("category").agg(
            F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n")
        ).where((F.col("p") >= target_positive) & (F.col("n") >= target_negative)).select("category").limit(MOST_CATEGORIES).collect()
        done_with = [r.category for r in full]
        if len(full) == categories:
            break
    return sampling.quota_sample(labelled, target_positive, target_negative, seed=seed)


def unlabelled(comments: DataFrame, labels: DataFrame) -> DataFrame:
    """Resume: comments whose (comment_id, category) has no label yet."""
    return sampling.remaining(comments, labels, ["comment_id", "category"])
