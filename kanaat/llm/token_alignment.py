"""Which tokens of two tokenizers stand for the same bytes, and how often over the whole corpus.

A text, with a blank before it, is encoded by a byte-level BPE (A) and by a piece model with byte fallback (B). Where
tokens of both end at the same byte, a group ends; every A token of a group is linked with every B token of it. The
count of a pair of ids is the number of documents that hold it linked.

Counting is external. Chunks of texts write their (A id, B id, document, links) records, sorted and dealt by a radix
of the A id, as compressed runs to the shared folder. Runs of one radix part are merged, ``FAN_IN`` at a time, by a
heap over the ends of their blocks, round after round, until each part has one stream of pairs with their counts,
ordered by A id: the highest count of an A id is the maximum of a run of neighbours. The runs then meet the stream of
their part once more, and what each document gets from them (links of highest count, sum of counts) flows back to its
chunk. An id that holds a third of all links makes long runs, and these are dealt to as many groups as any others;
what one task holds is ``FAN_IN`` runs and the pairs of one part, bounded by the two vocabularies.

Null and empty texts have no tokens, nor have texts whose tokens do not spell them again (the piece model reads its
own sign for a blank as a blank): all counts 0, the digest ''. Special tokens in a text are plain text. Ids may be of
any type, null or repeated, each row is a document of its own; other columns are left out. A text is encoded whole.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kanaat.llm.batches import Texts, chunks, gather_lists, per_row, per_worker, runs, span_hashes, spread
from kanaat.llm.byte_pair import token_bytes
from kanaat.llm.pretokens import pieces, tokenizer_path
from kanaat.llm.registry import query, table
from kanaat.llm.storage import stored
from kanaat.llm.token_ids import MOST_KEPT, Encode, Kept, library_encode

PIECE_FILE = "piece_bpe_32k.model"
# Radix parts of the A ids, runs merged at once, entries of a run's block, bytes of text of a chunk.
PARTS, FAN_IN, BLOCK, CHUNK = 16, 64, 8192, 1 << 21
# Links that are spread out at once.
LINKS = 2_000_000

Batches = Iterator[pa.RecordBatch]


def piece_model(path: str):
    def load():
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path)

    return per_worker(f"pieces {path}", load)


def piece_encode(path: str) -> Encode:
    """Ids of stretches that begin with a blank, which the model puts before what it encodes, if that is anything."""
    def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        model = piece_model(path)
        alone = [model.piece_to_id("▁")]
        ids = [got if word != b" " else alone for word, got in zip(words, model.encode([w[1:].decode() for w in words], num_threads=1), strict=True)]
        return np.fromiter((i for word in ids for i in word), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))

    return encode


def piece_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all pieces one after another, where each one's begin and how many they are."""
    def make():
        model = piece_model(path)
        of = [bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
              for i in range(model.get_piece_size())]
        count = np.array([len(b) for b in of], np.int64)
        return np.frombuffer(b"".join(of), np.uint8), np.cumsum(count) - count, count

    return per_worker(f"piece bytes {path}", make)


def with_blank(texts: Texts) -> Texts:
    """A blank before every text that is not empty."""
    size = np.diff(texts.at)
    at = np.concatenate([[0], np.cumsum(size + (size > 0))])
    data = np.full(at[-1], 32, np.uint8)
    data[spread(at[1:] - size, size)] = texts.data
    return Texts(data, at, texts.first)


def stretches(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of the stretches that the piece model encodes on their own: no piece has a blank behind
    another character, so each begins with one or more blanks."""
    blank = texts.data == 32
    opens = blank.copy()
    opens[1:] &= ~blank[:-1]
    opens[texts.at[:-1][np.diff(texts.at) > 0]] = True
    start = np.flatnonzero(opens)
    return start, np.append(start[1:], len(texts.data)), np.searchsorted(texts.at, start, side="right") - 1


def ids_of(texts: Texts, cut: tuple[np.ndarray, np.ndarray, np.ndarray], encode: Encode, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all rows and how many each has; distinct stretches are encoded once in a worker."""
    start, end, row = cut
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(texts.rows, np.int64)
    held = per_worker(f"aligned {name}", dict)
    if "all" not in held or held["all"].size > MOST_KEPT:
        held["all"] = Kept()
    kept = held["all"]
    number = kept.of_pieces(span_hashes(texts.data, start, end), start, end, texts.data.tobytes(), encode)
    count = kept.count[number]
    return gather_lists(kept.ids, kept.start[number], count).astype(np.int64), per_row(row, texts.rows, count)


def spelled_rows(texts: Texts, ids: np.ndarray, counts: np.ndarray, spelling: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Which rows are spelled by their tokens, byte for byte."""
    flat, start, length = spelling
    row = np.repeat(np.arange(texts.rows), counts)
    size = np.diff(texts.at)
    good = per_row(row, texts.rows, length[ids]) == size
    here = ids[good[row]]
    made = gather_lists(flat, start[here], length[here])
    wrong = made != gather_lists(texts.data, texts.at[:-1][good], size[good])
    good[np.repeat(np.flatnonzero(good), size[good])[wrong]] = False
    return good & (size > 0)


class Aligned:
    """Tokens of both sides of a chunk's texts and their groups; rows without tokens have none."""

    def __init__(self, texts: Texts, path_a: str, path_b: str) -> None:
        texts = with_blank(texts)
        self.rows = texts.rows
        sides = (ids_of(texts, pieces(texts, path_a), library_encode(path_a), path_a), ids_of(texts, stretches(texts), piece_encode(path_b), path_b))
        spellings = (token_bytes(path_a), piece_bytes(path_b))
        good = np.logical_and.reduce([spelled_rows(texts, *side, s) for side, s in zip(sides, spellings, strict=True)])
        self.ids, self.counts, ends = [], [], []
        for (ids, counts), (_, _, length) in zip(sides, spellings, strict=True):
            ids = ids[np.repeat(good, counts)]
            self.ids.append(ids)
            self.counts.append(np.where(good, counts, 0))
            ends.append(np.cumsum(length[ids]))
        common = np.intersect1d(*ends, assume_unique=True)
        self.group = [np.searchsorted(common, e) for e in ends]
        row_ends = np.cumsum(np.where(good, np.diff(texts.at), 0))
        self.row_of_group = np.searchsorted(row_ends, common)
        self.n_groups = per_row(self.row_of_group, self.rows)
        self.sizes = [np.bincount(g, minlength=len(common)) for g in self.group]
        self.n_links = np.zeros(self.rows, np.int64)
        np.add.at(self.n_links, self.row_of_group, self.sizes[0] * self.sizes[1])

    def digests(self) -> list[str]:
        """The digest of each row's groups, written as ``a1,a2|b1;a3|b2,b3``."""
        ids, group = np.concatenate(self.ids), np.concatenate(self.group)
        side = np.repeat([0, 1], [len(x) for x in self.ids])
        order = np.argsort(2 * group + side, kind="stable")
        ids, group, side = ids[order], group[order], side[order]
        last = np.ones(len(ids), bool)
        last[:-1] = (group[1:] != group[:-1]) | (side[1:] != side[:-1])
        row = self.row_of_group[group]
        final = np.ones(len(ids), bool)
        final[:-1] = row[1:] != row[:-1]
        sign = np.where(final, 3, np.where(last, 1 + side, 0))
        flat, start, count = decimals()
        entry = 4 * ids + sign
        raw = gather_lists(flat, start[entry], count[entry]).tobytes()
        at = np.concatenate([[0], np.cumsum(per_row(row, self.rows, count[entry]))]).tolist()
        return [hashlib.sha256(raw[a:b]).hexdigest() if b > a else "" for a, b in zip(at[:-1], at[1:], strict=True)]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(A id << 16 | B id), row and links of every linked pair of every row, in this order."""
        distinct = []
        for ids, group in zip(self.ids, self.group, strict=True):
            key, count = np.unique((group << 17) | ids, return_counts=True)
            distinct.append((key >> 17, key & 0x1FFFF, count))
        (ga, a, na), (gb, b, nb) = distinct
        begin, size = np.searchsorted(gb, ga, "left"), np.searchsorted(gb, ga, "right") - np.searchsorted(gb, ga, "left")
        upto, out, at = np.cumsum(size), [], 0
        while at < len(ga):
            to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + LINKS, "right")))
            left = np.repeat(np.arange(at, to), size[at:to])
            right = spread(begin[at:to], size[at:to])
            out.append(summed((a[left] << 40) | (b[right] << 24) | self.row_of_group[ga[left]], na[left] * nb[right]))
            at = to
        key, links = summed(np.concatenate([k for k, _ in out]), np.concatenate([n for _, n in out])) if out else (np.zeros(0, np.int64),) * 2
        return key >> 24, key & 0xFFFFFF, links


def summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sums of their numbers."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    begin, _ = runs(key)
    return key[begin], (np.add.reduceat(n[order], begin) if len(begin) else n[:0])


def decimals() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every id in decimal digits with each of the signs that may follow it."""
    def make():
        of = [f"{i}{sign}".encode() for i in range(1 << 16) for sign in (",", "|", ";", "")]
        count = np.array([len(b) for b in of], np.int64)
        return np.frombuffer(b"".join(of), np.uint8), np.cumsum(count) - count, count

    return per_worker("decimals", make)


def squeezed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers, byte by byte of their places side by side, compressed."""
    parts = [np.array([len(columns), *map(len, columns)], "<i8").tobytes()]
    parts += [np.ascontiguousarray(c.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def spread_out(blob: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes = np.frombuffer(raw, "<i8", 1 + int(np.frombuffer(raw, "<i8", 1)[0]))[1:].tolist()
    out, at = [], 8 * (len(sizes) + 1)
    for n in sizes:
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, 8 * n, at).reshape(8, n).T).view("<i8").reshape(-1))
        at += 8 * n
    return out


def steps(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=0)


def heap_merge(streams: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted (key, count) streams as one, equal keys added up, in pieces. A heap holds the key at which each
    stream's block ends; up to the smallest of them every stream can be read."""
    at = [0] * len(streams)
    heap = [(int(key[min(BLOCK, len(key)) - 1]), i) for i, (key, _) in enumerate(streams) if len(key)]
    heapq.heapify(heap)
    while heap:
        bound, keys, counts, ended = heap[0][0], [], [], []
        while heap and heap[0][0] == bound:
            ended.append(heapq.heappop(heap)[1])
        for i, (key, count) in enumerate(streams):
            to = at[i] + int(np.searchsorted(key[at[i]:at[i] + BLOCK + 1], bound, "right"))
            if to > at[i]:
                keys.append(key[at[i]:to])
                counts.append(count[at[i]:to])
                at[i] = to
        for i in ended:
            key = streams[i][0]
            if at[i] < len(key):
                heapq.heappush(heap, (int(key[min(at[i] + BLOCK, len(key)) - 1]), i))
        yield summed(np.concatenate(keys), np.concatenate(counts))


def merged(streams: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    out = list(heap_merge(streams))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([k for k, _ in out]), np.concatenate([n for _, n in out])


def written(docs: DataFrame, id_col: str, text_col: str, path_a: str | None, path_b: str | None) -> DataFrame:
    """The stored rows of all documents (place not null) and the runs of all chunks (part not null)."""
    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    fields = (f"chunk long, place int, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "part int, pairs binary, holders binary")
    names = ["chunk", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "part", "pairs", "holders"]

    def run(batches: Batches) -> Batches:
        from pyspark import TaskContext

        a, b = path_a or tokenizer_path(), path_b or tokenizer_path(PIECE_FILE)
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for texts in chunks(batch.column(1), CHUNK):
                found, rows = Aligned(texts, a, b), texts.rows
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(rows, chunk)), pa.array(np.arange(rows, dtype=np.int32)), batch.column(0).slice(texts.first, rows),
                    *(pa.array(x.astype(np.int64)) for x in (*found.counts, found.n_groups, found.n_links)), pa.array(found.digests(), pa.string()),
                    pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary()), pa.nulls(rows, pa.binary())], names)
                pair, row, links = found.pairs()
                part = (pair >> 16) % PARTS
                blobs = []
                for p in np.unique(part).tolist():
                    own, held, n = (x[part == p] for x in (pair, row, links))
                    begin, count = runs(own)
                    step = steps(held)
                    step[begin] = held[begin]
                    blobs.append((p, squeezed(steps(own[begin]), count), squeezed(step, n)))
                n, empty = len(blobs), [pa.nulls(len(blobs), t) for t in (pa.int64(),) * 4]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, chunk)), pa.nulls(n, pa.int32()), pa.nulls(n, batch.column(0).type), *empty, pa.nulls(n, pa.string()),
                    pa.array([p for p, _, _ in blobs], pa.int32()), pa.array([x for _, x, _ in blobs], pa.binary()),
                    pa.array([x for _, _, x in blobs], pa.binary())], names)
                chunk += 1

    return stored(source.mapInArrow(run, fields), "aligned")


def pair_totals(held: DataFrame, chunks_: int) -> DataFrame:
    """(part, pairs): for each radix part one stream of pairs, their counts over all documents, and the highest count
    of their A id. Runs are merged FAN_IN at a time."""
    streams, groups = held.select("part", F.col("chunk").alias("number"), "pairs"), chunks_

    def merge(batches: Batches) -> Batches:
        def out() -> pa.RecordBatch:
            key, count = merged([(np.cumsum(a), b) for a, b in map(spread_out, blobs)])
            return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int64()), pa.array([squeezed(steps(key), count)], pa.binary())],
                                              ["part", "number", "pairs"])

        at, blobs = None, []
        for batch in batches:
            for p, group, blob in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (p, group) != at and blobs:
                    yield out()
                    blobs = []
                at = p, group
                blobs.append(blob)
        if blobs:
            yield out()

    while True:
        groups = max(1, -(-groups // FAN_IN))
        dealt = streams.withColumn("number", F.pmod(F.xxhash64("number"), F.lit(groups)))
        sorted_ = dealt.repartition(min(4096, PARTS * groups), "part", "number").sortWithinPartitions("part", "number")
        streams = stored(sorted_.mapInArrow(merge, "part int, number long, pairs binary"), "pairs")
        if groups == 1:
            return streams.select("part", "pairs")


def with_highest(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A part's pairs, their counts and whether a count is the highest of its A id: pairs come in the order of A ids."""
    step, count = spread_out(blob)
    pair = np.cumsum(step)
    begin, size = runs(pair >> 16)
    return pair, count, count == np.repeat(np.maximum.reduceat(count, begin), size)


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Each document's tokens, groups and links, and what its links count over the whole corpus."""
    kind = docs.schema[id_col].dataType.simpleString()
    held = written(docs, id_col, text_col, path_a, path_b)
    documents = held.where(F.col("place").isNotNull()).select("chunk", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    runs_ = held.where(F.col("part").isNotNull()).select("chunk", "part", "pairs", "holders")
    chunks_ = documents.select("chunk").distinct().count()
    totals = pair_totals(runs_, chunks_)
    groups = max(1, -(-chunks_ // FAN_IN))
    dealt = runs_.withColumn("number", F.pmod(F.xxhash64("chunk"), F.lit(groups)))
    every = totals.withColumn("number", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))

    def back(own: pa.Table, counted: pa.Table) -> pa.Table:
        if not counted.num_rows or not own.num_rows:
            return pa.table({"chunk": pa.array([], pa.int64()), "given": pa.array([], pa.binary())})
        pair, count, highest = with_highest(counted.column("pairs")[0].as_py())
        out = []
        for blob, holders in zip(own.column("pairs").to_pylist(), own.column("holders").to_pylist(), strict=True):
            step, holding = spread_out(blob)
            row, links = spread_out(holders)
            begin = np.cumsum(holding) - holding
            base = np.cumsum(row)
            row = base - np.repeat((base - row)[begin], holding)
            place = np.repeat(np.searchsorted(pair, np.cumsum(step)), holding)
            rows = int(row.max()) + 1
            best, total = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            np.add.at(best, row, links * highest[place])
            np.add.at(total, row, links * count[place])
            out.append(squeezed(best, total))
        return pa.table({"chunk": own.column("chunk"), "given": pa.array(out, pa.binary())})

    given = dealt.groupBy("part", "number").cogroup(every.groupBy("part", "number")).applyInArrow(back, "chunk long, given binary")

    def together(rows: pa.Table, parts: pa.Table) -> pa.Table:
        place = rows.column("place").to_numpy()
        sums = np.zeros((2, int(place.max()) + 1 if len(place) else 0), np.int64)
        for blob in parts.column("given").to_pylist():
            for into, got in zip(sums, spread_out(blob), strict=True):
                into[:len(got)] += got
        return rows.drop_columns(["chunk", "place"]).append_column("n_best", pa.array(sums[0][place])).append_column("count_sum", pa.array(sums[1][place]))

    fields = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return documents.groupBy("chunk").cogroup(given.groupBy("chunk")).applyInArrow(together, fields)


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    found = aligned(table(spark, folder, "documents"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
