"""Token files: documents' ids in ascending id order, compressed by an adaptive context-mixing range coder.

A file holds frames, one binary value each, of at most `FRAME_IDS` ids; see `range_coder` for what is in a frame. The
head of a frame also lists the stretches of documents it holds, so frames can be read alone and in any order, and a
document of any length may cross frames. Files are written and read by Spark, in parts by range of the id.

Null ids stand first, equal ids are ordered by checksum of the text. Null and empty texts are one end token.
Damaged frames raise `range_coder.Checksum`. Only whole-number ids are possible; other columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kanaat.llm import range_coder
from kanaat.llm.batches import chunks, tidy
from kanaat.llm.pretokens import tokenizer_path
from kanaat.llm.registry import query, table
from kanaat.llm.storage import stored
from kanaat.llm.token_ids import encoded, with_end
from kanaat.session import shared_path

FRAME_IDS = range_coder.BLOCK * range_coder.LANES
# x ** 8n modulo the checksum's polynomial, bits reflected.
POLYNOMIAL = 0xEDB88320


def times(a: int, b: int) -> int:
    """Product of two polynomials modulo POLYNOMIAL; the highest bit is the constant term."""
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = (b >> 1) ^ (POLYNOMIAL if b & 1 else 0)
    return out


def joined_crc32(first: int, second: int, length: int) -> int:
    """The checksum of two stretches of bytes, from those of each and the length of the second."""
    power, square, n = 1 << 31, 1 << 30, 8 * length
    while n:
        if n & 1:
            power = times(square, power)
        square = times(square, square)
        n >>= 1
    return times(power, first) ^ second


def stretches(number: int, known: list, lengths: list[int]) -> bytes:
    """The list of a frame's stretches of documents: the number of the first in its part, then ids and lengths."""
    valid = np.array([i is not None for i in known], "u1")
    ids = np.array([i or 0 for i in known], "<i8")
    return np.array([number, len(known)], "<i8").tobytes() + ids.tobytes() + np.array(lengths, "<i8").tobytes() + valid.tobytes()


def read_stretches(extra: bytes) -> tuple[int, list, np.ndarray]:
    number, n = np.frombuffer(extra, "<i8", 2).tolist()
    ids, lengths = np.frombuffer(extra, "<i8", n, 16), np.frombuffer(extra, "<i8", n, 16 + 8 * n)
    valid = np.frombuffer(extra, "u1", n, 16 + 16 * n)
    return number, [i if v else None for i, v in zip(ids.tolist(), valid.tolist(), strict=True)], lengths


def frames(documents: Iterator[tuple[object, np.ndarray]]) -> Iterator[bytes]:
    """Frames of a part's documents in order."""
    number, known, lengths, held, size = 0, [], [], [], 0
    for doc_id, ids in documents:
        at = 0
        while at < len(ids):
            take = min(len(ids) - at, FRAME_IDS - size)
            known.append(doc_id)
            lengths.append(take)
            held.append(ids[at:at + take])
            at, size = at + take, size + take
            if size == FRAME_IDS:
                yield range_coder.encode_frame(np.concatenate(held), stretches(number, known, lengths))
                number += len(known) - (at < len(ids))
                known, lengths, held, size = [], [], [], 0
    if size:
        yield range_coder.encode_frame(np.concatenate(held), stretches(number, known, lengths))


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0) -> None:
    """Tokenises (doc_id, text) and writes token files: one row per frame with its part and number."""
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(
        "doc_id", F.crc32(F.coalesce("text", F.lit("")))).sortWithinPartitions("doc_id", F.crc32(F.coalesce("text", F.lit(""))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path_, part = tokenizer or tokenizer_path(), TaskContext.get().partitionId()

        def documents():
            for batch in batches:
                known = batch.column(0).to_pylist()
                for texts in chunks(batch.column(1)):
                    ids, counts = with_end(*encoded(texts, path_), end_id)
                    for doc_id, end, n in zip(known[texts.first:texts.first + texts.rows], np.cumsum(counts).tolist(), counts.tolist(), strict=True):
                        yield doc_id, ids[end - n:end]

        for number, frame in enumerate(frames(documents())):
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([frame], pa.binary())],
                                             ["part", "frame", "data"])

    # Binary pages don't shrink further; they go to the file as they are.
    ordered.mapInArrow(tidy(run), "part int, frame int, data binary").write.option("compression", "none").parquet(path)


def read_batches(files: DataFrame, with_ids: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, frame, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                number, known, lengths = read_stretches(range_coder.frame_head(data)["extra"])
                ids = range_coder.decode_frame(data)
                raw, end = memoryview(ids.astype("<u4").tobytes()), np.cumsum(lengths)
                crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(end.tolist(), lengths.tolist(), strict=True)]
                rows = len(known)
                out = [pa.array([part] * rows, pa.int32()), pa.array([frame] * rows, pa.int32()), pa.array(np.arange(number, number + rows)),
                       pa.array(known, pa.int64()), pa.array(lengths), pa.array(crc, pa.int64())]
                names = ["part", "frame", "number", "doc_id", "n", "crc"]
                if with_ids:
                    at = np.concatenate([[0], end]).astype(np.int32)
                    out, names = [*out, pa.ListArray.from_arrays(pa.array(at), pa.array(ids.view(np.int32)))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(out, names)

    schema = "part int, frame int, number long, doc_id long, n long, crc long" + ", ids array<int>" * with_ids
    return files.select("part", "frame", "data").mapInArrow(tidy(run), schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The stretches of documents in token files with their ``ids``: (part, number) names a document, frames are in order."""
    return read_batches(spark.read.parquet(path), True)


def counted(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` and ``ids_crc32`` of every document in token files."""
    # Files are decoded once: what is counted is read by every branch of the sums below.
    pieces = stored(read_batches(spark.read.parquet(path), False), "token-counts")
    docs = pieces.groupBy("part", "number").agg(
        F.first("doc_id").alias("doc_id"), F.sum("n").alias("n_tokens"), F.min("crc").alias("_one"), F.count(F.lit(1)).alias("_pieces"),
        F.sort_array(F.collect_list(F.struct("frame", "n", "crc"))).alias("_list"))

    def join_crc(lists: pd.Series) -> pd.Series:
        out = []
        for pieces_ in lists:
            crc = int(pieces_[0]["crc"])
            for piece in pieces_[1:]:
                crc = joined_crc32(crc, int(piece["crc"]), 4 * int(piece["n"]))
            out.append(crc)
        return pd.Series(out, dtype="int64")

    join = F.pandas_udf(join_crc, "long")
    before_part = docs.groupBy("part").agg(F.sum("n_tokens").alias("_n")).select(
        F.col("part").alias("_part"), F.coalesce(F.sum("_n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1))
    placed = docs.withColumn("_inside", F.coalesce(inside, F.lit(0))).join(before_part, F.col("part") == F.col("_part"))
    placed = placed.withColumn("start", F.col("_before") + F.col("_inside"))
    columns = lambda crc: ["doc_id", "start", "n_tokens", crc.alias("ids_crc32")]
    return placed.where("_pieces = 1").select(*columns(F.col("_one"))).unionByName(placed.where("_pieces > 1").select(*columns(join("_list"))))


@query("op7_context_mixing_files")
def op7_context_mixing_files(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "token-files")
    write(table(spark, folder, "documents"), path)
    return counted(spark, path)
