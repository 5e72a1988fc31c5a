"""The registered queries: name, Spark form and, where the result can be written in SQL, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


# Pieces several SQL texts share.
SPACE = r"\x09-\x0D\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def sql_clean(text: str) -> str:
    bare = rf"regexp_replace(lower({text}), '\p{{Nd}}+|[^\p{{L}}\p{{N}}_{SPACE}]+', '', 'g')"
    return f"trim(regexp_replace({bare}, '[{SPACE}]+', ' ', 'g'))"


def sql_words(text: str) -> str:
    return f"len(regexp_extract_all({text}, '[^{SPACE}]+'))"


LABELS = """labelled AS (
  SELECT doc_id AS comment_id, 'quality' AS category, quality AS label FROM labels
  UNION ALL SELECT doc_id, 'toxic', toxic FROM labels)"""
