"""Workbooks (.xlsx) as a Spark source: one file per row, read inside tasks, bad files set aside.

A sheet holds at most about a million rows, so one file is a bounded unit of work."""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
ROWS = "path string, name string, row int, cells map<string,string>, error string"
BATCH = 10_000


def _texts(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    root = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
    return ["".join(t.text or "" for t in item.iterfind(".//m:t", NS)) for item in root.iterfind("m:si", NS)]


def _column(reference: str) -> int:
    number = 0
    for letter in re.match(r"[A-Z]+", reference)[0]:
        number = number * 26 + ord(letter) - 64
    return number


def _value(cell, texts):
    kind = cell.get("t")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iterfind(".//m:t", NS))
    value = cell.find("m:v", NS)
    if value is None or value.text is None:
        return None
    return texts[int(value.text)] if kind == "s" else value.text


def sheet_rows(content: bytes):
    """Rows of the first sheet as {header: text}."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        texts = _texts(book)
        sheet = min(n for n in book.namelist() if re.match(r"xl/worksheets/sheet\d+\.xml$", n))
        header = None
        for _, row in ElementTree.iterparse(io.BytesIO(book.read(sheet))):
            if not row.tag.endswith("}row"):
                continue
            cells = {_column(c.get("r")): _value(c, texts) for c in row.iterfind("m:c", NS)}
            row.clear()
            if header is None:
                header = {i: str(v) for i, v in cells.items() if v is not None}
            else:
                yield {header[i]: v for i, v in cells.items() if i in header}


def _read(frames):
    for pdf in frames:
        for path, content in zip(pdf["path"], pdf["content"]):
            name = path.rsplit("/", 1)[-1]
            try:
                rows = [(path, name, i, cells, None) for i, cells in enumerate(sheet_rows(content), 1)]
            except Exception as reason:  # a bad file is reported and not used at all, the others go on
                rows = [(path, name, 0, None, f"{type(reason).__name__}: {reason}")]
            for at in range(0, len(rows), BATCH):
                yield pd.DataFrame(rows[at : at + BATCH], columns=["path", "name", "row", "cells", "error"])


def read_workbooks(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Rows of all workbooks (path, name, row, cells) and the files that could not be read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xls*").load(folder).select("path", "content")
    rows = files.mapInPandas(_read, ROWS)
    broken = rows.where(F.col("error").isNotNull()).select("path", "name", "error")
    return rows.where(F.col("error").isNull()).select("path", "name", "row", "cells"), broken


def labelled_workbooks(rows: DataFrame) -> DataFrame:
    """Canonical columns by header name, however it is cased or padded."""
    from kanaat.sources.files import file_stem

    lowered = F.map_from_entries(
        F.transform(F.map_entries("cells"), lambda e: F.struct(F.lower(F.trim(e["key"])), e["value"]))
    )
    known = rows.withColumn("_c", lowered)
    return known.select(
        file_stem(F.col("name")).alias("category"),
        F.col("_c")["tarih"].alias("Tarih"),
        F.col("_c")["yorum"].alias("Yorum"),
        F.coalesce(F.col("_c")["sonuç"], F.col("_c")["sonuc"]).alias("Sonuç"),
    )
