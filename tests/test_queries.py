"""Every registered query that has SQL gives the same whole result as DuckDB."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import difference, duck_result, spark_result

WITH_SQL = sorted(oracle_sql())
JOINS_OF_ALL_PAIRS = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", WITH_SQL)
def test_same_result_as_sql(spark, duck, small, name, capsys):
    df = queries()[name](spark, small)
    assert difference(spark_result(df), duck_result(duck, oracle_sql()[name])) is None
    plan = df._jdf.queryExecution().toString()
    assert not any(join in plan for join in JOINS_OF_ALL_PAIRS)


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["category", "total", "positives", "share"]
    assert df.count() == 2
