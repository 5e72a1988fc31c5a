"""File sources and sinks over the given tables: written to the shared folder, read back through the operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from kanaat.operators import tables
from kanaat.plans.registry import query
from kanaat.session import shared_path
from kanaat.sources import files, sinks
from kanaat.sources.tables import table

MOST_CATEGORIES = 1000


@query("csv_read_back", "SELECT doc_id::VARCHAR AS doc_id, lang AS category, text FROM documents WHERE text <> ''")
def csv_read_back(spark, folder):
    """Quotes and line breaks survive; padded headers get their canonical spelling; needed columns are asked for."""
    path = shared_path(spark, "csv")
    rows = table(spark, folder, "documents").where("text != ''").select("doc_id", F.col("lang").alias("category"), F.col("text").alias(" Yorum "))
    sinks.write_csv(rows, path)
    read = tables.require(files.normalise_headers(files.read_csv(spark, path)), ["Yorum", "category"])
    return read.select("doc_id", "category", F.col("Yorum").alias("text"))


@query(
    "first_file_per_category",
    """SELECT lang AS category, arg_min(path, name) AS path FROM (
  SELECT lang, lang || '_' || source || '_' || doc_id || '.csv' AS name, '/in/' || doc_id AS path FROM documents) GROUP BY lang""",
)
def first_file_per_category(spark, folder):
    """The file a category is read from, by the beginnings of file names."""
    docs = table(spark, folder, "documents")
    names = docs.select(F.concat(F.lit("/in/"), "doc_id").alias("path"), F.concat("lang", F.lit("_"), "source", F.lit("_"), "doc_id", F.lit(".csv")).alias("name"))
    known = [r.lang for r in docs.select("lang").distinct().limit(MOST_CATEGORIES + 1).collect()]
    if len(known) > MOST_CATEGORIES:
        raise ValueError(f"more than {MOST_CATEGORIES} categories")
    return files.one_file_per_category(names, known)


@query(
    "indicator_columns",
    """SELECT source, count(*) FILTER (lang = 'de')::BIGINT AS de, count(*) FILTER (lang = 'en')::BIGINT AS en FROM documents GROUP BY source""",
)
def indicator_columns(spark, folder):
    """Columns that are not among the known ones are categories and are counted."""
    docs = table(spark, folder, "documents")
    wide = docs.select("doc_id", "source", *[(F.col("lang") == c).cast("int").alias(c) for c in ("de", "en")])
    found = tables.category_columns(wide, ["doc_id", "source"])
    return wide.groupBy("source").agg(*[F.sum(c).alias(c) for c in found])


@query("json_read_back", "SELECT conv_id, turn, role, text FROM conversations")
def json_read_back(spark, folder):
    path, rows = shared_path(spark, "json"), table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    sinks.write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query("report_read_back", "SELECT category, count(*)::BIGINT AS n FROM (SELECT lang AS category FROM documents) GROUP BY category")
def report_read_back(spark, folder):
    path = shared_path(spark, "report")
    counts = table(spark, folder, "documents").groupBy(F.col("lang").alias("category")).agg(F.count(F.lit(1)).alias("n"))
    sinks.write_report(counts, path)
    return spark.read.schema(counts.schema).parquet(path)


@query(
    "usable_tables",
    """SELECT 'documents' AS name, count(*)::BIGINT AS n FROM documents WHERE trim(text) <> ''
  UNION ALL SELECT 'pages', count(*)::BIGINT FROM documents WHERE false""",
)
def usable_tables(spark, folder):
    """Tables that lack a needed column or hold nothing are left out; the rest is counted."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    given = {"documents": docs.where(F.trim("text") != ""), "pages": table(spark, folder, "pages")}
    kept = {name: tables.usable([df], ["text"]) for name, df in given.items()}
    parts = [
        (tables.not_empty(kept[name]) or [docs.where(F.lit(False))])[0].agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name in given
    ]
    return tables.union_all(parts)
