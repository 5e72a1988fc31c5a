"""Memory between the tasks of a worker."""

import re
from pathlib import Path

import numpy as np
import pyarrow as pa

from kanaat.llm.batches import BATCH_BYTES, BATCH_SETTING, small_batches, tidy


def anonymous_mb():
    return int(re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024


def test_a_task_gives_its_memory_back():
    kept = []

    def run(batches):
        held = [np.ones(12_000) for _ in range(2000)]
        kept.append(np.ones(12_000))  # stands behind the others, so that they are not at the end of the heap
        assert len(held) == 2000
        yield from batches

    before = anonymous_mb()
    assert list(tidy(run)(iter([1, 2]))) == [1, 2]
    assert anonymous_mb() - before < 60
    found = tidy(run)(iter([1, 2]))
    next(found)
    found.close()
    assert anonymous_mb() - before < 60


def test_batches_are_small_unless_the_session_says(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    docs = spark.range(3000).selectExpr("repeat('x', 10000) AS text").coalesce(1)
    spark.conf.unset(BATCH_SETTING)
    try:
        found = [r.n for r in small_batches(docs).mapInArrow(sizes, "n long").collect()]
        assert sum(found) > 30_000_000 and max(found) < 2 * BATCH_BYTES
        spark.conf.set(BATCH_SETTING, "1000000")
        assert spark.conf.get(BATCH_SETTING) == "1000000" and small_batches(docs) is docs and spark.conf.get(BATCH_SETTING) == "1000000"
    finally:
        spark.conf.unset(BATCH_SETTING)
