"""Comment and label files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kanaat.functions.fixed_values import LABELLED_FILE_PREFIXES, NA_TOKENS
from kanaat.functions.text import strip_space
from kanaat.operators.tables import require, union_all, usable

KNOWN_HEADERS = {"yorum": "Yorum", "sonuç": "Sonuç", "sonuc": "Sonuç", "tarih": "Tarih"}


def read_csv(spark: SparkSession, path: str, na_tokens: bool = False, line_breaks: bool = True) -> DataFrame:
    """A CSV with header, every column as text. ``line_breaks`` reads quoted line breaks but keeps each
    file in one task; turn it off for large files without them. ``na_tokens`` nulls the words pandas
    takes for missing."""
    df = spark.read.option("header", True).option("multiLine", line_breaks).option("escape", '"').csv(path)
    return null_tokens(df) if na_tokens else df


def null_tokens(df: DataFrame) -> DataFrame:
    return df.select(*[F.when(~F.col(f"`{c}`").isin(NA_TOKENS), F.col(f"`{c}`")).alias(c) for c in df.columns])


def normalise_headers(df: DataFrame) -> DataFrame:
    """Strip header names and bring the known ones to their canonical spelling."""
    return df.toDF(*[KNOWN_HEADERS.get(c.strip().lower(), c.strip()) for c in df.columns])


def file_stem(name: Column) -> Column:
    return F.split_part(name, F.lit("."), F.lit(1))


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Path, name and stem of the files of a folder; their content is not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path")
    name = F.substring_index("path", "/", -1)
    return found.select("path", name.alias("name"), file_stem(name).alias("stem"))


def category_of_file(name: Column, prefixes: list[str] | None = None) -> Column:
    """The longest prefix the file name starts with, null if none."""
    ordered = sorted(prefixes or LABELLED_FILE_PREFIXES, key=len, reverse=True)
    return F.coalesce(*[F.when(F.startswith(name, F.lit(p)), F.lit(p)) for p in ordered])


def one_file_per_category(files: DataFrame, prefixes: list[str] | None = None) -> DataFrame:
    """The first file by name of every category that has one."""
    named = files.withColumn("category", category_of_file(F.col("name"), prefixes)).where("category is not null")
    return named.groupBy("category").agg(F.min_by("path", "name").alias("path"))


def read_labelled_csv(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Every labelled file of a folder, category = file stem. Files lacking a needed column are left
    out; a folder holds one file per category, so the loop is over categories."""
    files = list_files(spark, folder, pattern).orderBy("name").collect()
    frames = [
        normalise_headers(read_csv(spark, f.path)).withColumn("category", F.lit(f.stem)) for f in files
    ]
    return _joined(spark, usable(frames, ["Yorum", "Sonuç"]), ["Yorum", "Sonuç", "category"])


def _joined(spark: SparkSession, frames: list[DataFrame], columns: list[str]) -> DataFrame:
    """The union, or no rows where no file is usable."""
    none = ", ".join(f"`{c}` string" for c in columns)
    return union_all(frames) if frames else spark.createDataFrame([], none)


def merge_labelled_csv(spark: SparkSession, folder: str, prefixes: list[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Union of one file per category with its source name and indicator columns, and the categories
    no file was found for."""
    from kanaat.operators.tables import source_indicators

    known = prefixes or LABELLED_FILE_PREFIXES
    found = {r.category: r.path for r in one_file_per_category(list_files(spark, folder, "*.csv"), known).collect()}
    frames = [read_csv(spark, found[c]).withColumn("Kaynak", F.lit(c)) for c in known if c in found]
    merged = _joined(spark, usable(frames, ["Tarih", "Yorum"]), ["Tarih", "Yorum", "Kaynak"])
    return source_indicators(merged, "Kaynak", known), [c for c in known if c not in found]


def canonical_labels(df: DataFrame, identity: Column | None = None) -> DataFrame:
    """Labelled rows in the common layout. A numeric spelling such as 1.0 counts as its whole number."""
    from kanaat.functions.keys import row_id
    from kanaat.functions.labels import normalise_label

    require(df, ["Yorum", "Sonuç", "category"])
    date = F.col("Tarih") if "Tarih" in df.columns else F.lit(None).cast("string")
    spelled = F.regexp_replace(strip_space(F.col("Sonuç")), r"^(\d+)\.0+$", "$1")
    key = identity if identity is not None else row_id(date, F.col("Yorum"), F.col("category"))
    return df.dropna(subset=["Yorum", "Sonuç"]).select(
        key.alias("comment_id"),
        "category",
        date.alias("date_text"),
        F.col("Yorum").alias("text"),
        normalise_label(spelled).alias("label"),
    )
