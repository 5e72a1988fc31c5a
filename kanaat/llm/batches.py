"""Whole-text work on Arrow batches: words, spans and their hashes as numpy arrays, no loop per word.

A batch is cut into chunks of about a megabyte, so the memory a task needs is set by ``CHUNK_BYTES`` and by its
longest text, never by the number of rows Arrow sends at once. Null texts count as empty.
"""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK_BYTES = 1 << 20
# Bytes of an Arrow batch that goes to a worker, unless the session says how many.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
# Fixed values of the word hash: an odd multiplier for positions and the constants of a 64-bit finaliser.
STEP = np.uint64(0x9E3779B97F4A7C15)
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


@dataclass
class Texts:
    """Rows ``first .. first + rows`` of a batch: their UTF-8 bytes and where each text begins (rows + 1)."""

    data: np.ndarray
    at: np.ndarray
    first: int

    @property
    def rows(self) -> int:
        return len(self.at) - 1


def chunks(column: pa.Array, most_bytes: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The texts of a string column in pieces of about ``most_bytes``; one longer text is a piece of its own."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(at, at[row] + most_bytes, side="right")) - 1)
        yield Texts(data[at[row]:at[end]], at[row:end + 1] - at[row], row)
        row = end


def small_batches(docs: DataFrame) -> DataFrame:
    """``docs``; its session makes Arrow batches of about ``BATCH_BYTES`` from now on, if it has no size of its own.
    The JVM and the worker of each task hold such batches outside the JVM's heap."""
    conf = docs.sparkSession.conf
    if BATCH_SETTING not in conf.getAll:
        conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return docs


def per_worker(name: str, make: Callable[[], object]) -> object:
    """One object for the life of a Python worker. Functions travel by value, so a module's own globals would be
    made anew for each task; this keeps caches between the tasks of a worker."""
    held = sys.modules.setdefault("_kanaat_worker", types.ModuleType("_kanaat_worker")).__dict__
    if name not in held:
        held[name] = make()
    return held[name]


def give_back() -> None:
    """Gives memory that numpy and Arrow have freed back to the system. A worker lives on between tasks, and what it
    would keep of each step adds up beside the JVM's heap."""
    pa.default_memory_pool().release_unused()
    trim = per_worker("trim", lambda: getattr(ctypes.CDLL(None), "malloc_trim", None))
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's function over batches that gives its memory back when it ends."""
    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def byte_keys() -> np.ndarray:
    """A 64-bit value for each byte."""
    return mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * STEP)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP ** i and its inverse, modulo 2 ** 64, for i below n; kept and grown in the worker."""
    held = per_worker("powers", dict)
    if held.get("n", 0) < n:
        size = max(n, CHUNK_BYTES + 1)
        inverse = np.uint64(pow(int(STEP), -1, 1 << 64))
        for name, base in (("up", STEP), ("down", inverse)):
            held[name] = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size - 1, base)]))
        held["n"] = size
    return held["up"], held["down"]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; equal bytes give equal hashes wherever they stand."""
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte_keys()[data] * up[:len(data)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def words(texts: Texts, also_between: bytes = b"") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word ``[^\\x20\\x09-\\x0D]+``; the bytes ``also_between`` part words too."""
    if not len(texts.data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    parts = np.zeros(256, bool)
    parts[[32, *range(9, 14), *also_between]] = True
    blank = parts[texts.data]
    opens = ~blank
    opens[1:] &= blank[:-1]
    begin = texts.at[:-1][np.diff(texts.at) > 0]
    opens[begin] = ~blank[begin]
    closes = ~blank
    closes[:-1] &= blank[1:]
    last = texts.at[1:][np.diff(texts.at) > 0] - 1
    closes[last] = ~blank[last]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return start, end, np.searchsorted(texts.at, start, side="right") - 1


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, all other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def per_row(row: np.ndarray, rows: int, weights: np.ndarray | None = None) -> np.ndarray:
    """How many entries (or what whole-number weight) each row has."""
    if weights is None:
        return np.bincount(row, minlength=rows).astype(np.int64)
    return np.round(np.bincount(row, weights=weights, minlength=rows)).astype(np.int64)


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal neighbours begin, and how long each is."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return begin, np.diff(np.append(begin, len(keys)))


def spread(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[0] .. start[0] + count[0] - 1, then the same for start[1], and so on."""
    before = np.cumsum(count) - count
    return np.repeat(start - before, count) + np.arange(int(count.sum()))


def gather_lists(flat: np.ndarray, start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The pieces flat[start : start + count] one after another."""
    return flat[spread(start, count)]


def set_aside(docs: DataFrame, used: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all columns but the ``used`` ones under names that no operator computes, and what gives a table
    that still has them the columns of ``docs`` back, and only those."""
    names = [c if c in used else f"_own_{i}" for i, c in enumerate(docs.columns)]
    own = docs.columns

    def back(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(n).alias(c) for n, c in zip(names, own, strict=True)])

    return docs.toDF(*names), back


def with_text_columns(docs: DataFrame, text_col: str, make: Callable[[Texts], dict[str, np.ndarray]], fields: str,
                      keep: list[str] | None = None, most_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``keep`` (all columns by default) and the columns that ``make`` computes from each piece of texts of about
    ``most_bytes``; ``fields`` is their DDL. A column of ``docs`` with the name of a computed one is replaced."""
    added = T.StructType.fromDDL(fields)
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added.names]
    source = small_batches(docs).select(*kept, *([] if text_col in kept else [text_col]))
    place = source.columns.index(text_col)
    schema = T.StructType([source.schema[c] for c in kept] + added.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks(batch.column(place), most_bytes):
                columns = make(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(texts.first, texts.rows) for i in range(len(kept))]
                    + [pa.array(columns[name]) for name in added.names], kept + added.names)

    return source.mapInArrow(tidy(run), schema)
