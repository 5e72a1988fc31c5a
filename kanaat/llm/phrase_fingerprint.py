"""Fingerprints of whole texts from their Lempel-Ziv phrases.

A text's bytes are parsed from left to right into phrases: each is the longest phrase seen before and one byte more,
so the phrases are what a dictionary compressor would store. The set of phrases is hashed; the ``SIZE`` smallest
hashes are the signature. Two signatures are compared by the share of the smallest hashes of both together that both
hold, an estimate of the share of phrases the two texts have in common: texts that compress well together are alike.
Texts of few phrases keep all of them, their likeness is exact. An edit moves the phrases behind it only until the
two parses meet again, and what stands before it not at all.

Neighbours in an order of ids: rows are dealt to ranges of ids by Spark and sorted; in a range every row is read
once and meets the row behind it. The first and last rows of all ranges, a table as small as the number of ranges,
meet in a second step. Texts travel once.

Null texts count as empty; two empty texts are alike (1), an empty one and another are not (0). Ids are of any type
with an order, may be null (last) and repeat (then ordered by a hash of the text); equal rows follow one another.
Other columns are left out of the query; `fingerprints` keeps them and replaces one called ``fingerprint``. A text
is parsed in one piece, so a task's memory follows its longest text: about 300 bytes for each phrase.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kanaat.llm.batches import Texts, chunks, per_row, runs, span_hashes, with_text_columns
from kanaat.llm.registry import query, table
from kanaat.llm.storage import stored

# Hashes a signature keeps.
SIZE = 64
# Bytes of text in a range of neighbouring rows, by which the number of ranges is chosen.
RANGE_BYTES = 8 << 20


def parse(text: bytes, at: int, root: dict, node: dict, ends: list[int], added: list | None = None) -> dict:
    """Parses on from byte ``at``: adds phrases to the tree of known ones below ``root`` and their ends to ``ends``.
    ``node``: the known phrase that the text runs along so far; returns the one it ends in, the root after a phrase's
    end. ``added`` gets what was added where."""
    push = ends.append
    for at, byte in enumerate(text, at + 1):
        if byte in node:
            node = node[byte]
        else:
            node[byte] = {}
            if added is not None:
                added.append((node, byte))
            node = root
            push(at)
    return node


def phrase_ends(text: bytes) -> list[int]:
    """Where the phrases of a text end; what is left at the end is a phrase that was seen."""
    ends: list[int] = []
    root: dict = {}
    if parse(text, 0, root, root, ends) is not root:
        ends.append(len(text))
    return ends


def forked_ends(head: bytes, tails: list[bytes]) -> list[list[int]]:
    """The phrase ends of the head with each of the tails; the head is parsed once."""
    root: dict = {}
    first: list[int] = []
    node = parse(head, 0, root, root, first)
    out = []
    for tail in tails:
        ends, added = list(first), []
        if parse(tail, len(head), root, node, ends, added) is not root:
            ends.append(len(head) + len(tail))
        for below, byte in added:
            del below[byte]
        out.append(ends)
    return out


def signatures(texts: Texts, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all rows' signatures, row by row and ascending, and how many each row has."""
    raw = texts.data.tobytes()
    return signed(texts, [phrase_ends(raw[a:b]) for a, b in zip(texts.at[:-1].tolist(), texts.at[1:].tolist(), strict=True)], size)


def signed(texts: Texts, phrases: list[list[int]], size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of rows whose phrases end at the given places."""
    counts = np.array([len(p) for p in phrases], np.int64)
    if not counts.sum():
        return np.zeros(0, np.uint32), counts
    end = np.fromiter(chain.from_iterable(phrases), np.int64, int(counts.sum())) + np.repeat(texts.at[:-1], counts)
    start = np.concatenate([[0], end[:-1]])
    row = np.repeat(np.arange(texts.rows), counts)
    first = np.cumsum(counts) - counts
    start[first[counts > 0]] = texts.at[:-1][counts > 0]
    return smallest(row, (span_hashes(texts.data, start, end) >> np.uint64(32)).astype(np.uint32), texts.rows, size)


def smallest(row: np.ndarray, hashes: np.ndarray, rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``size`` smallest distinct hashes of each row, ascending, and how many there are. Of long rows first only
    the hashes below a bound are sorted that should leave about twice as many; rows it leaves too few are sorted whole."""
    bound = np.minimum((2 * size + 32) * 2.0**32 / np.maximum(per_row(row, rows), 1), 2.0**32)
    low = hashes < bound[row]
    few = (per_row(row[low], rows) < size) & (bound < 2.0**32)
    while True:
        low |= few[row]
        keys = np.sort((row[low].astype(np.uint64) << np.uint64(32)) | hashes[low].astype(np.uint64))
        keys = keys[runs(keys)[0]]
        of = (keys >> np.uint64(32)).astype(np.int64)
        begin, count = runs(of)
        short = np.zeros(rows, bool)
        short[of[begin]] = count < size
        short &= (bound < 2.0**32) & ~few
        if not short.any():
            break
        few |= short  # equal hashes took places among those below the bound
    keep = np.arange(len(keys)) - np.repeat(begin, count) < size
    return (keys[keep] & np.uint64(0xFFFFFFFF)).astype(np.uint32), per_row(of[keep], rows)


def as_text(hashes: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One string for each row: eight hexadecimal digits a hash."""
    letters = hashes.astype(">u4").tobytes().hex()
    at = np.concatenate([[0], np.cumsum(counts)]) * 8
    return pa.StringArray.from_buffers(len(counts), pa.py_buffer(at.astype(np.int32)), pa.py_buffer(letters.encode()))


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], size: int = SIZE) -> np.ndarray:
    """Estimated share of common phrases of each row of ``a`` and the same row of ``b``."""
    rows = len(a[1])
    row = np.concatenate([np.repeat(np.arange(rows), a[1]), np.repeat(np.arange(rows), b[1])])
    keys = np.sort((row.astype(np.uint64) << np.uint64(32)) | np.concatenate([a[0], b[0]]).astype(np.uint64))
    begin, count = runs(keys)
    row = (keys[begin] >> np.uint64(32)).astype(np.int64)
    first, of = runs(row)
    # Of a row with all its phrases the signature is the whole set; only full signatures are cut to their size.
    full = np.maximum(a[1], b[1]) >= size
    keep = (np.arange(len(row)) - np.repeat(first, of) < size) | ~full[row]
    union = per_row(row[keep], rows)
    both = per_row(row[keep & (count == 2)], rows)
    return np.where(union > 0, both / np.maximum(union, 1), 1.0)


def fingerprints(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Every row with its ``fingerprint``."""
    def make(texts: Texts) -> dict[str, np.ndarray]:
        return {"fingerprint": as_text(*signatures(texts))}

    return with_text_columns(docs, text_col, make, "fingerprint string")


PAIR = "n_chars bigint, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
NAMES = [part.split()[0] for part in PAIR.split(", ")]
Signatures = tuple[np.ndarray, np.ndarray]


def as_bytes(hashes: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Each row's hashes, big-endian."""
    at = (np.concatenate([[0], np.cumsum(counts)]) * 4).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(at), pa.py_buffer(hashes.astype(">u4").tobytes())])


def from_bytes(column: pa.Array) -> Signatures:
    held = [b or b"" for b in column.to_pylist()]
    return np.frombuffer(b"".join(held), ">u4").astype(np.uint32), np.array([len(b) // 4 for b in held], np.int64)


def as_piece(texts: list[bytes]) -> Texts:
    return Texts(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)]), 0)


def pair_columns(texts: list[str], following: list[str], after: Signatures | None = None) -> list[pa.Array]:
    """The columns of PAIR for texts and the texts behind them. ``after``: signatures
    of the texts behind; without them each text is followed by the next one, and only the last one's is made anew."""
    whole, changed, own, new = [], [], [], []
    for text, next_text in zip(texts, following, strict=True):
        half = len(text) // 2
        head, tail, other = text[:len(text) - half].encode(), text[len(text) - half:].encode(), next_text[:half].encode()
        ends = forked_ends(head, [tail, other])
        whole.append(head + tail)
        changed.append(head + other)
        own.append(ends[0])
        new.append(ends[1])
    mine, edited = signed(as_piece(whole), own), signed(as_piece(changed), new)
    if after is None:
        last = signatures(as_piece([following[-1].encode()]))
        after = np.concatenate([mine[0][mine[1][0]:], last[0]]), np.concatenate([mine[1][1:], last[1]])
    return [
        pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(c).digest() for c in changed], pa.binary()),
        as_bytes(*mine), as_bytes(*edited), pa.array(likeness(mine, edited)), pa.array(likeness(mine, after)),
    ]


def along_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """Each row's id (``doc_id``), code points, and signature beside those of its edited text and the row behind it by
    descending id; the first row follows the last one. In the edited text the second half of the code points gives
    way to the first as many of the row behind. ``ranges``: how many ranges of ids (by default from the bytes of all texts)."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if ranges is None:
        ranges = max(1, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // RANGE_BYTES))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    names = ["doc_id", *NAMES, "place", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # a tree holds many dictionaries and no cycles
        try:
            yield from walk(batches)
        finally:
            gc.enable()

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        place, held = TaskContext.get().partitionId(), None

        def edge(row: tuple[pa.Array, str], which: int) -> pa.RecordBatch:
            empty = [pa.nulls(1, t) for t in (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]
            return pa.RecordBatch.from_arrays([row[0], *empty, pa.array([2 * place + which], pa.int32()), pa.array([row[1]])], names)

        for batch in batches:
            for piece in chunks(batch.column(1)):
                ids = batch.column(0).slice(piece.first, piece.rows)
                texts = [t.decode() for t in np.split(piece.data, piece.at[1:-1]) for t in [t.tobytes()]]
                if held is None:
                    yield edge((ids.slice(0, 1), texts[0]), 0)
                else:
                    ids, texts = pa.concat_arrays([held[0], ids]), [held[1], *texts]
                n = len(texts) - 1
                held = ids.slice(n, 1), texts[-1]
                if n:
                    columns = pair_columns(texts[:-1], texts[1:])
                    yield pa.RecordBatch.from_arrays([ids.slice(0, n), *columns, pa.nulls(n, pa.int32()), pa.nulls(n, pa.string())], names)
        if held is not None:
            yield edge(held, 1)

    walked = stored(dealt.mapInArrow(run, f"doc_id {kind}, {PAIR}, place int, text string"), "fingerprints")
    # The first (even place) and last (odd) row of every range, as many as there are ranges: a last row is followed
    # by the first row of the next range that has any. Only their places are gathered, to number them.
    edges = walked.where(F.col("place").isNotNull()).select("doc_id", "place", "text")
    firsts = sorted(r.place for r in edges.where(F.col("place") % 2 == 0).select("place").collect())
    links = docs.sparkSession.createDataFrame([(p + 1, firsts[(i + 1) % len(firsts)]) for i, p in enumerate(firsts)], "place int, following int")
    after = edges.select(F.col("place").alias("following"), F.col("text").alias("next_text"))
    met = edges.join(links, "place").join(after, "following").select("doc_id", "text", "next_text")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                texts, following = batch.column(1).to_pylist(), batch.column(2).to_pylist()
                columns = pair_columns(texts, following, signatures(as_piece([t.encode() for t in following])))
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *NAMES])

    last = met.mapInArrow(meet, f"doc_id {kind}, {PAIR}")
    found = walked.where(F.col("place").isNull()).select("doc_id", *NAMES).unionByName(last)
    return found.select("doc_id", "n_chars", *(F.lower(F.hex(c)).alias(c) for c in NAMES[1:4]), "near_edited", "near_next")


@query("op11_phrase_fingerprints")
def op11_phrase_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return along_ids(table(spark, folder, "documents"))
