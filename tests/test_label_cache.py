"""Answers that outlast a job."""

from pyspark.sql import functions as F

from kanaat.operators import labelling

PAIRS = [("a", "x"), ("b", "y")]


def yes():
    return lambda prompt: "evet"


def moody():
    def ask(prompt):
        if "boom" in prompt:
            raise RuntimeError
        return "hayır" if "no" in prompt.split('YORUM: "', 1)[1][:12] else "evet"

    return ask


def rows(spark, texts, category="a"):
    return spark.createDataFrame([(i, category, t) for i, t in enumerate(texts)], "comment_id long, category string, text string")


def labels(df):
    return {r.comment_id: (r.label, r.failed) for r in df.collect()}


def test_answers_are_found_again_and_failures_asked_anew(spark, tmp_path):
    cache = labelling.LabelCache(str(tmp_path / "labels"))
    first = rows(spark, ["no 1", "ok 2", "boom", "no 1"])
    assert labels(labelling.label_comments(first, moody, PAIRS, pause=0.0, cache=cache)) == {0: (0, 0), 1: (1, 0), 2: (0, 1), 3: (0, 0)}
    second = rows(spark, ["no 1", "boom", "new"])
    # The other labeller would say yes to everything: what was answered stays, what failed is asked again.
    assert labels(labelling.label_comments(second, yes, PAIRS, pause=0.0, cache=cache)) == {0: (0, 0), 1: (1, 0), 2: (1, 0)}
    held = spark.read.parquet(cache.folder)
    assert held.where("failed = 0").groupBy("question").count().agg(F.max("count")).first()[0] == 1 and held.count() == 5
    other = labelling.LabelCache(cache.folder, "2")
    assert labels(labelling.label_comments(second, yes, PAIRS, pause=0.0, cache=other))[0] == (1, 0)


def test_a_question_is_asked_once_over_all_slices(spark, tmp_path):
    cache = labelling.LabelCache(str(tmp_path / "labels"))
    texts = [f"{'no' if i % 3 else 'ok'} {i % 40}" for i in range(600)]
    df = rows(spark, texts).unionByName(rows(spark, texts[:50], "b")).unionByName(rows(spark, ["lost"], None))
    found = labelling.label_until_quota(df, moody, 5, 300, PAIRS, pause=0.0, cache=cache)
    assert found.where("category = 'a'").groupBy("label").count().collect()
    held = spark.read.parquet(cache.folder)
    assert held.count() == held.select("question").distinct().count()
    asked = {(r.category, r.text) for r in df.where("category is not null").collect()}
    assert held.count() <= len(asked)


def test_answers_go_back_while_others_are_asked():
    """A batch's prompts and texts are never all Python strings at once."""
    import pyarrow as pa

    asked, texts = [], [f"t{i}" for i in range(1000)]
    batch = pa.RecordBatch.from_pydict({"question": texts, "text": texts, "prompt": [None, *texts[1:]]})
    given = labelling._ask(lambda: lambda prompt: (asked.append(prompt), "evet")[1], 1, 0.0, iter([batch]))
    first = next(given)
    assert first.num_rows == len(asked) == labelling.ASKED_ROWS and asked[:2] == [None, "t1"]
    rest = [row for part in given for row in part.to_pylist()]
    assert [r["text"] for r in first.to_pylist() + rest] == texts and rest[-1] == {"question": "t999", "text": "t999", "answer": "evet", "attempts": 1, "failed": 0}
