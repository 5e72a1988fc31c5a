"""Collocations by streams of counts in prefix and suffix order.

One record stands for each word: the word and the up to four behind it in its piece. Records are sorted and equal
ones added up where they are read, dealt to ranges of the sorted order, and merged there, so every phrase's count is
the sum of a run of neighbours: one pass over a range gives the counts of phrases of two to five words in prefix
order. A phrase whose run touches an end of its range is counted in part there and added up behind. From these counts
come two streams, one ordered by what a phrase begins with, one by what it ends with; merge joins of sorted streams
give each cut its left count, its right count, and each phrase the counts of the phrases that extend it by a word.

A phrase is rare if one of its words or one pair of its neighbours is, so records end before the first word, and
inside the first pair, that is certainly rare. Pairs are counted by buckets of their hashes beforehand, which go from
task to task as sorted numbers without their words. Both are asked of filters of fixed size (``FILTER_BITS``), which
may take rare for frequent and never the other way round; counts are exact whatever they say. Ends of ranges are drawn from a sample of at most ``SAMPLE`` records,
on which only the evenness of the ranges depends. A word that starts a third of all records spans many ranges.

Null texts count as empty, a null language as ``und``; ids and other columns are not looked at, repeated rows count
each time. Empty tables give no phrases. Arithmetic beyond 64 bits is decimal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kanaat.llm.batches import STEP, Texts, chunks, lowered, mix, runs, small_batches, span_hashes, tidy, words
from kanaat.llm.registry import query, table
from kanaat.llm.storage import stored
from kanaat.session import small_side

LONGEST = 5
# Fixed sets of the bytes that end a piece: . , ; : ! ? and line feed to carriage return.
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
NO_LANG = "und"
# Bits of the filter of frequent words (and of that of pairs), and of one of its numbers.
FILTER_BITS, WORD_BITS = 1 << 25, 32
# Buckets that pairs are counted in, pairs a part of the buckets gets about, and buckets a task holds before it passes them on.
BUCKET_BITS, PART_PAIRS, HELD_PAIRS = 30, 4_000_000, 1_500_000
# Records of a range of the sorted order, ranges at most, and sampled records at most.
RANGE_RECORDS, MOST_RANGES, SAMPLE = 2_000_000, 65_536, 100_000
# Bytes of text that are cut into words together, distinct words and sorted records a task holds before it passes them on.
CHUNK, HELD, RECORDS = 1 << 20, 400_000, 500_000
# floor(1000 a n / (l r)) in whole decimals of 38 digits.
SCORE = "(cast(1000 as decimal(38,0)) * cast(f as decimal(38,0)) * cast(n as decimal(38,0))) div (cast(l as decimal(38,0)) * cast(r as decimal(38,0)))"
# Parts a language's phrases are dealt to before the best of all are taken.
SHARES = 64

Batches = Iterator[pa.RecordBatch]


def places(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes, each word's start, end and row, and whether the next word stands in its piece."""
    data = lowered(texts.data)
    start, end, row = words(Texts(data, texts.at, texts.first), ENDS)
    # A piece ends where a row does or where an ending byte stands between two words.
    flag = np.zeros(256, bool)
    flag[list(ENDS)] = True
    upto = np.concatenate([[0], np.cumsum(flag[data], dtype=np.int64)])
    joined = np.zeros(len(start), bool)
    if len(start) > 1:
        joined[:-1] = (row[1:] == row[:-1]) & (upto[start[1:]] == upto[end[:-1]])
    return data, start, end, row, joined


class Words:
    """The words of a piece of texts: which distinct (language, word) each is, and how many words follow it in its piece."""

    def __init__(self, texts: Texts, langs: pa.Array) -> None:
        data, start, end, row, self.joined = places(texts)
        self.n = len(start)
        codes = langs.dictionary_encode()
        lang = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row]
        keys = mix(span_hashes(data, start, end) ^ mix((lang.astype(np.uint64) + np.uint64(1)) * STEP))
        _, first, which = np.unique(keys, return_index=True, return_inverse=True)
        raw = data.tobytes()
        spelled = pa.array([raw[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)], pa.binary())
        found = pa.table({"lang": codes.dictionary.take(pa.array(lang[first])).cast(pa.binary()), "word": spelled})
        order = pc.sort_indices(found, [("lang", "ascending"), ("word", "ascending")]).to_numpy()
        self.names = found.take(pa.array(order))
        self.hashes = name_hashes(self.names)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.ids = place[which]

    def counts(self) -> np.ndarray:
        return np.bincount(self.ids, minlength=len(self.names))

    def records(self, frequent: np.ndarray, pairs: np.ndarray | None = None) -> np.ndarray:
        """One row for each word that starts a phrase of two frequent words or more: 1 + its place in ``names`` and
        those of the words behind it, 0 behind the last one. ``pairs``, a filter, ends phrases inside rare pairs."""
        good = frequent[self.ids]
        joined = self.joined
        if pairs is not None:
            here = np.flatnonzero(joined[:-1] & good[:-1] & good[1:])
            hashes = self.hashes[self.ids]
            joined = np.zeros(self.n, bool)
            joined[here] = passed(pairs, buckets(hashes[here], hashes[here + 1]))
        out = np.zeros((self.n, LONGEST), np.int32)
        alive = good.copy()
        out[alive, 0] = self.ids[alive] + 1
        for k in range(1, LONGEST):
            nxt = np.zeros(self.n, bool)
            m = self.n - k
            if m <= 0:
                break
            nxt[:m] = alive[:m] & joined[k - 1:self.n - 1] & good[k:]
            here = np.flatnonzero(nxt)
            out[here, k] = self.ids[here + k] + 1
            alive = nxt
        return out[out[:, 1] > 0]


def value_hashes(values: pa.Array) -> np.ndarray:
    piece = next(chunks(values, 1 << 62), None)
    return span_hashes(piece.data, piece.at[:-1], piece.at[1:]) if piece else np.zeros(0, np.uint64)


def name_hashes(names: pa.Table) -> np.ndarray:
    """A 64-bit hash of every (language, word), the same in every task."""
    spelled = names.column("word").combine_chunks()
    langs = names.column("lang").combine_chunks().dictionary_encode()
    of_lang = value_hashes(langs.dictionary)
    return mix(value_hashes(spelled) ^ mix(of_lang[langs.indices.to_numpy(zero_copy_only=False)] + STEP)) if len(spelled) else np.zeros(0, np.uint64)


def place_hashes(texts: Texts, langs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The same hash for each word of a piece of texts where it stands, and whether the next word stands in its piece."""
    data, start, end, row, joined = places(texts)
    codes = langs.dictionary_encode()
    of_row = mix(value_hashes(codes.dictionary) + STEP)[codes.indices.to_numpy(zero_copy_only=False)]
    return mix(span_hashes(data, start, end) ^ of_row[row]), joined


def buckets(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The bucket of each pair of words, from their hashes."""
    return mix(first * STEP + second) >> np.uint64(64 - BUCKET_BITS)


def texts_and_langs(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return small_batches(docs).select(F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"))


def text_pieces(batches: Batches) -> Iterator[tuple[Texts, pa.Array]]:
    for batch in batches:
        for texts in chunks(batch.column(0), CHUNK):
            langs = batch.column(1).slice(texts.first, texts.rows)
            if len(texts.data) <= 2 * CHUNK:
                yield texts, langs
                continue
            # A text longer than CHUNK is a chunk of its own: it is cut where pieces end.
            ends = np.flatnonzero(np.isin(texts.data, np.frombuffer(ENDS, np.uint8))) + 1
            at = 0
            while at < len(texts.data):
                later = np.searchsorted(ends, at + CHUNK)
                to = int(ends[later]) if later < len(ends) else len(texts.data)
                yield Texts(texts.data[at:to], np.array([0, to - at]), 0), langs
                at = to


def word_pieces(batches: Batches) -> Iterator[Words]:
    for texts, langs in text_pieces(batches):
        yield Words(texts, langs)


def added_up(names: pa.Table, counts: np.ndarray) -> tuple[pa.Table, np.ndarray]:
    """Equal (language, word) rows as one."""
    held = names.append_column("n", pa.array(counts)).group_by(["lang", "word"]).aggregate([("n", "sum")])
    return held.select(["lang", "word"]), held.column("n_sum").to_numpy()


def word_counts(rows: DataFrame) -> DataFrame:
    """(lang, word, n) of all words of (text, lang); equal words of a task are added up first."""
    def run(batches: Batches) -> Batches:
        def out() -> Batches:
            names, counts = added_up(pa.concat_tables(held), np.concatenate(sums))
            for a in range(0, len(names), 50_000):
                part = names.slice(a, 50_000)
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang").cast(pa.string()).combine_chunks(), part.column("word").cast(pa.string()).combine_chunks(),
                     pa.array(counts[a:a + 50_000])], ["lang", "word", "n"])

        held, sums, size = [], [], 0
        for piece in word_pieces(batches):
            if piece.n:
                held.append(piece.names)
                sums.append(piece.counts())
                size += len(piece.names)
                if size > HELD:
                    names, counts = added_up(pa.concat_tables(held), np.concatenate(sums))
                    held, sums, size = [names], [counts], len(names)
                    if size > HELD // 2:
                        yield from out()
                        held, sums, size = [], [], 0
        if held:
            yield from out()

    return rows.mapInArrow(tidy(run), "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def word_hashes(names: DataFrame) -> DataFrame:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            spelled = pa.table({c: batch.column(i).cast(pa.binary()) for i, c in enumerate(["lang", "word"])})
            yield pa.RecordBatch.from_arrays([pa.array(name_hashes(spelled).view(np.int64))], ["hash"])

    return names.select("lang", "word").mapInArrow(tidy(run), "hash bigint")


def filter_of(frequent: DataFrame) -> np.ndarray:
    """The filter as numbers of WORD_BITS bits: at most FILTER_BITS / WORD_BITS rows come to the driver."""
    bits = frequent.select(F.expr(f"cast(pmod(hash, {FILTER_BITS}) div {WORD_BITS} as int)").alias("at"),
                           F.expr(f"shiftleft(1L, cast(pmod(hash, {WORD_BITS}) as int))").alias("bit"))
    found = bits.groupBy("at").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(FILTER_BITS // WORD_BITS, np.uint32)
    out[found["at"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).astype(np.uint32)
    return out


def passed(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = np.mod(hashes.view(np.int64), FILTER_BITS)
    return (filter_[at // WORD_BITS] >> (at % WORD_BITS).astype(np.uint32)) & 1 > 0


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begin, _ = runs(keys)
    return keys[begin], np.add.reduceat(counts[order], begin) if len(begin) else counts


def bucket_bytes(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Buckets in order as steps, with their counts, compressed."""
    columns = [planes(c) for c in (np.diff(keys.astype(np.int64), prepend=0), counts & 0xFFFFFFFF, counts >> 32)]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(columns))


def buckets_of(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(3, 4, -1)
    steps, low, high = (np.ascontiguousarray(c.T).view("<u4").reshape(-1).astype(np.int64) for c in raw)
    return np.cumsum(steps).astype(np.uint32), low | high << 32


def frequent_pairs(rows: DataFrame, keep, total: int, least: int) -> DataFrame:
    """(hash, n) of the buckets of pairs that occur ``least`` times or more, pairs of words that pass ``keep``."""
    bits = min(16, max(0, (-(-total // PART_PAIRS) - 1).bit_length()))

    def deal(batches: Batches) -> Batches:
        def out() -> pa.RecordBatch:
            part = (keys >> np.uint32(BUCKET_BITS - bits)).astype(np.int32)
            begin, size = runs(part)
            blobs = [bucket_bytes(keys[a:a + n], counts[a:a + n]) for a, n in zip(begin.tolist(), size.tolist(), strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(part[begin]), pa.array(blobs, pa.binary())], ["part", "run"])

        held, size = [], 0
        for texts, langs in text_pieces(batches):
            hashes, joined = place_hashes(texts, langs)
            good = passed(keep.value, hashes)
            here = np.flatnonzero(joined[:-1] & good[:-1] & good[1:])
            found = np.sort(buckets(hashes[here], hashes[here + 1]).astype(np.uint32))
            begin, count = runs(found)
            if len(begin):
                held.append((found[begin], count))
                size += len(begin)
            if size > HELD_PAIRS:
                keys, counts = summed(*(np.concatenate(c) for c in zip(*held, strict=True)))
                held, size = [(keys, counts)], len(keys)
                if size > HELD_PAIRS // 2:
                    yield out()
                    held, size = [], 0
        if held:
            keys, counts = summed(*(np.concatenate(c) for c in zip(*held, strict=True)))
            yield out()

    def count(batches: Batches) -> Batches:
        def out() -> pa.RecordBatch:
            keys, counts = summed(*(np.concatenate(c) for c in zip(*held, strict=True)))
            often = counts >= least
            return pa.RecordBatch.from_arrays([pa.array(keys[often].astype(np.int64)), pa.array(counts[often])], ["hash", "n"])

        part, held = None, []
        for batch in batches:
            for p, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if p != part and held:
                    yield out()
                    held = []
                part = p
                held.append(buckets_of(blob))
        if held:
            yield out()

    dealt = rows.mapInArrow(tidy(deal), "part int, run binary").repartition(1 << bits, "part").sortWithinPartitions("part")
    return dealt.mapInArrow(tidy(count), "hash bigint, n bigint")


def packed(records: np.ndarray, top: int) -> list[np.ndarray]:
    """A few numbers that order records as their words do; places are at most ``top``."""
    bits, columns = (21, 3) if top < 1 << 21 else (31, 2)
    keys = []
    for first in range(0, LONGEST, columns):
        key = records[:, first].astype(np.int64)
        for k in range(first + 1, min(LONGEST, first + columns)):
            key <<= bits
            key |= records[:, k]
        keys.append(key)
    return keys


def combined(records: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Records in order, equal ones as one."""
    if not len(records):
        return records, counts
    keys = packed(records, int(records.max()))
    order = np.argsort(keys[-1], kind="stable")
    for key in keys[-2::-1]:
        order = order[np.argsort(key[order], kind="stable")]
    new = np.zeros(len(records), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    begin = np.flatnonzero(new)
    return records[order[begin]], np.add.reduceat(counts[order], begin)


Run = tuple[pa.Table, np.ndarray, np.ndarray]


def planes(values: np.ndarray) -> bytes:
    """The lowest bytes of all numbers, then the next ones, and so on: they compress better side by side."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def run_bytes(records: np.ndarray, counts: np.ndarray, names: pa.Table) -> bytes:
    """A sorted run on its own, compressed: the words it uses, the first two columns as steps, the others as ranks by
    how often a word stands there."""
    flags = np.zeros(len(names) + 1, np.int64)
    for k in range(LONGEST):
        flags[records[:, k]] = 1
    flags[0] = 0
    local = np.cumsum(flags)[records]
    own = names.take(pa.array(np.flatnonzero(flags) - 1)).combine_chunks()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, own.schema) as writer:
        writer.write_table(own)
    spelled = sink.getvalue().to_pybytes()
    order = np.argsort(-np.bincount(local[:, 2:].ravel(), minlength=len(own) + 1), kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    first = np.diff(local[:, 0], prepend=0)
    second = np.where(first > 0, local[:, 1], np.diff(local[:, 1], prepend=0))
    head = np.array([len(records), len(order), len(spelled)], "<i8").tobytes()
    columns = [planes(c) for c in (first, second, *(rank[local[:, k]] for k in range(2, LONGEST)), counts & 0xFFFFFFFF, counts >> 32, order)]
    return zstandard.ZstdCompressor(level=1).compress(head + spelled + b"".join(columns))


def run_of(blob: bytes) -> Run:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, m, spelled = np.frombuffer(raw, "<i8", 3).tolist()
    names = pa.ipc.open_stream(pa.BufferReader(raw[24:24 + spelled])).read_all()
    at = 24 + spelled

    def column(size: int) -> np.ndarray:
        nonlocal at
        at += 4 * size
        return np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * size, at - 4 * size).reshape(4, size).T).view("<u4").reshape(-1).astype(np.int64)

    first, second, *ranks, low, high = [column(n) for _ in range(LONGEST + 2)]
    order = column(m)
    upto, begin = np.cumsum(second), np.flatnonzero(first > 0)
    base = np.repeat((upto - second)[begin], np.diff(np.append(begin, n)))
    records = np.stack([np.cumsum(first), upto - base, *(order[r] for r in ranks)], axis=1).astype(np.int32)
    return names, records, low | high << 32


def bounds_in(names: pa.Table, bounds: list[tuple]) -> np.ndarray:
    """Where each bound (lang, w1, .., wn) stands among the words of ``names``: twice its place, plus one, if the word
    is there, else the even number between its neighbours; 0 behind its last word. Doubled places of records are odd."""
    from bisect import bisect_left

    listed = list(zip(names.column("lang").to_pylist(), names.column("word").to_pylist(), strict=True))
    out = np.zeros((len(bounds), LONGEST), np.int64)
    for i, (lang, *spelled) in enumerate(bounds):
        for k, word in enumerate(spelled):
            at = bisect_left(listed, (lang, word))
            there = at < len(listed) and listed[at] == (lang, word)
            out[i, k] = 2 * (at + 1) + 1 if there else 2 * (at + 1)
    return out


def cut_places(records: np.ndarray, names: pa.Table, bounds: list[tuple]) -> np.ndarray:
    """How many of the sorted records stand before each bound."""
    top = 2 * len(names) + 3
    keys = packed(np.where(records > 0, 2 * records + 1, 0), top)
    out = np.zeros(len(bounds), np.int64)
    for i, bound in enumerate(zip(*(k.tolist() for k in packed(bounds_in(names, bounds), top)), strict=True)):
        low, high = 0, len(records)
        for key, value in zip(keys, bound, strict=True):
            low, high = low + np.searchsorted(key[low:high], value, "left"), low + np.searchsorted(key[low:high], value, "right")
        out[i] = low
    return out


def sampled_bounds(rows: DataFrame, keep, pairs, total: int, range_records: int) -> list[tuple]:
    """Ends of the ranges, as (lang, word, ..) in order: evenly spread over sampled ones of about ``total`` records."""
    ranges = min(MOST_RANGES, max(1, -(-total // range_records)))
    if ranges == 1:
        return []
    share = min(1.0, SAMPLE / total)
    of_texts = min(1.0, 16 * share)

    def run(batches: Batches) -> Batches:
        for i, piece in enumerate(word_pieces(batches)):
            records = piece.records(passed(keep.value, piece.hashes), pairs.value) if piece.n else np.zeros((0, LONGEST), np.int64)
            picked = records[np.random.default_rng(i).random(len(records)) < share / of_texts]
            listed = [(lang, word) for lang, word in zip(piece.names.column("lang").to_pylist(), piece.names.column("word").to_pylist(), strict=True)]
            spelled = [[listed[r[0] - 1][0], *(listed[x - 1][1] for x in r if x)] for r in picked.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(spelled, pa.list_(pa.binary()))], ["record"])

    sampled = rows if of_texts == 1.0 else rows.sample(of_texts, 11)
    found = sorted(tuple(map(bytes, r.record)) for r in sampled.mapInArrow(tidy(run), "record array<binary>").collect())
    return sorted({found[len(found) * i // ranges] for i in range(1, ranges)}) if found else []


def prefix_counts(records: np.ndarray, counts: np.ndarray, names: pa.Table, least: int) -> pa.RecordBatch:
    """Counts of the phrases of two to LONGEST words at the starts of sorted records: of those with ``least`` or more
    occurrences, and, whatever their count, of the first and the last of each length."""
    langs, spelled, sizes, sums = [], [], [], []
    word, lang = names.column("word").to_pylist(), names.column("lang").to_pylist()
    change = np.ones((len(records), LONGEST), bool)
    change[1:] = np.logical_or.accumulate(records[1:] != records[:-1], axis=1)
    for n in range(2, LONGEST + 1):
        begin = np.flatnonzero(change[:, n - 1])
        total = np.add.reduceat(counts, begin)
        there = np.flatnonzero(records[begin, n - 1] > 0)
        if not len(there):
            continue
        kept = (total[there] >= least)
        kept[[0, -1]] = True
        here = there[kept]
        for r in records[begin[here], :n].tolist():
            langs.append(lang[r[0] - 1].decode())
            spelled.append(b" ".join(word[x - 1] for x in r).decode())
        sizes += [n] * len(here)
        sums += total[here].tolist()
    return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(spelled, pa.string()), pa.array(sizes, pa.int32()), pa.array(sums, pa.int64())],
                                      ["lang", "phrase", "size", "f"])


def merged(parts: list[Run]) -> Run:
    """Sorted runs as one, over the words of all of them."""
    every = pa.concat_tables([p[0] for p in parts])
    distinct = every.group_by(["lang", "word"]).aggregate([])
    names = distinct.take(pc.sort_indices(distinct, [("lang", "ascending"), ("word", "ascending")])).select(["lang", "word"]).combine_chunks()

    def keys(t: pa.Table) -> pa.Array:  # a language's length, the language and the word as one value
        lengths = pc.binary_length(t.column("lang")).cast(pa.string()).cast(pa.binary())
        return pc.binary_join_element_wise(lengths, t.column("lang"), t.column("word"), b"\t").combine_chunks()

    place = pc.index_in(keys(every), keys(names)).to_numpy(zero_copy_only=False).astype(np.int32) + 1
    out, at = [], 0
    for own, records, _ in parts:
        to = np.concatenate([np.zeros(1, np.int32), place[at:at + len(own)]])
        out.append(to[records])
        at += len(own)
    return names, *combined(np.concatenate(out), np.concatenate([p[2] for p in parts]))


def phrase_counts(rows: DataFrame, frequent: DataFrame, total: int, least: int, range_records: int = RANGE_RECORDS) -> DataFrame:
    """(lang, phrase, size, f) of every phrase of 2 to LONGEST words with f >= ``least``, in (text, lang)."""
    spark = rows.sparkSession
    keep = spark.sparkContext.broadcast(filter_of(word_hashes(frequent)))
    often = stored(frequent_pairs(rows, keep, total, least), "pairs")
    pairs = spark.sparkContext.broadcast(filter_of(often))
    bounds = sampled_bounds(rows, keep, pairs, often.agg(F.sum("n")).first()[0] or 0, range_records)
    ends = spark.sparkContext.broadcast(bounds)

    def deal(batches: Batches) -> Batches:
        def out() -> pa.RecordBatch:
            names, records, counts = merged(held)
            cuts = np.concatenate([[0], cut_places(records, names, ends.value), [len(records)]])
            full = np.flatnonzero(np.diff(cuts))
            blobs = [run_bytes(records[a:b], counts[a:b], names) for a, b in zip(cuts[full].tolist(), cuts[full + 1].tolist(), strict=True)]
            return pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(blobs, pa.binary())], ["part", "run"])

        held, size = [], 0
        for piece in word_pieces(batches):
            records = piece.records(passed(keep.value, piece.hashes), pairs.value) if piece.n else np.zeros((0, LONGEST), np.int32)
            if len(records):
                held.append((piece.names, *combined(records, np.ones(len(records), np.int64))))
                size += len(held[-1][1])
                if size >= RECORDS:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    def count(batches: Batches) -> Batches:
        def out() -> pa.RecordBatch:
            names, records, counts = merged([run_of(b) for b in held])
            return prefix_counts(records, counts, names, least)

        part, held = None, []
        for batch in batches:
            for p, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if p != part and held:
                    yield out()
                    held = []
                part = p
                held.append(blob)
        if held:
            yield out()

    dealt = rows.mapInArrow(tidy(deal), "part int, run binary").repartition(len(bounds) + 1, "part").sortWithinPartitions("part")
    found = dealt.mapInArrow(tidy(count), "lang string, phrase string, size int, f bigint")
    return found.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100, top: int = 2000,
                 range_records: int = RANGE_RECORDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language whose parts stand together more
    often than chance, none of which always stands in a longer one."""
    rows = texts_and_langs(docs, text_col, lang_col)
    counted = stored(word_counts(rows), "words")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = counted.where(F.col("n") >= least)
    total = counted.agg(F.sum("n")).first()[0] or 0
    phrases = stored(phrase_counts(rows, frequent, total, least, range_records), "phrases")
    streams = phrases.select("lang", "phrase", "size", "f").unionByName(
        frequent.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), F.col("n").alias("f")))
    parts = F.split("phrase", " ")
    cuts = phrases.withColumn("w", parts).select("lang", "phrase", "size", "f", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "size", "f", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"))
    in_prefix_order = streams.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    in_suffix_order = streams.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    both = cuts.join(in_prefix_order.hint("merge"), ["lang", "left"]).join(in_suffix_order.hint("merge"), ["lang", "right"])
    # A phrase in a longer one of equal count is also in one that is longer by a single word: the longer one's
    # neighbours in both streams. Phrases below LONGEST words meet the counts of those that extend them.
    longer = phrases.withColumn("w", parts)
    first = F.array_join(F.slice("w", F.lit(1), F.col("size") - 1), " ")
    rest = F.array_join(F.slice("w", F.lit(2), F.col("size") - 1), " ")
    extended = longer.select("lang", F.explode(F.array(first, rest)).alias("phrase"), F.col("f").alias("longer")).groupBy("lang", "phrase").agg(
        F.max("longer").alias("longer"))
    scored = both.join(small_side(totals), "lang").withColumn("score", F.expr(SCORE))
    best = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("f").alias("a"), F.first("n").alias("n"))
    kept = best.join(extended.hint("merge"), ["lang", "phrase"], "left").where(F.coalesce("longer", F.lit(0)) < F.col("a"))
    rows = kept.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))
    for keys in (["lang", "_share"], ["lang"]):
        rows = rows.withColumn("_share", share).withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, d, unnest(p) AS piece, generate_subscripts(p, 1) AS pn
    FROM (SELECT lang, row_number() OVER () AS d,
                 regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS p
          FROM documents)),
listed AS (
    SELECT lang, w FROM (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces)
    WHERE len(w) > 0),
grams AS (
    SELECT lang, s AS size, w[i:i + s - 1] AS words
    FROM (SELECT lang, w, s, unnest(range(1, len(w) - s + 2)) AS i FROM listed, (SELECT unnest(range(1, 6)) AS s) WHERE len(w) >= s)),
counts AS (SELECT lang, size, words, count(*)::HUGEINT AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM listed GROUP BY lang),
cuts AS (SELECT lang, size, words, f, unnest(range(1, size)) AS k FROM counts WHERE size > 1),
scored AS (
    SELECT c.lang, c.words, c.f AS a, c.k, x.f AS l, y.f AS r, t.n, (1000 * c.f * t.n) // (x.f * y.f) AS score
    FROM cuts c JOIN counts x ON x.lang = c.lang AND x.words = c.words[1:c.k]
    JOIN counts y ON y.lang = c.lang AND y.words = c.words[c.k + 1:] JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
inside AS (
    SELECT DISTINCT o.lang, part FROM (
        SELECT c.lang, c.words[i:i + s - 1] AS part, c.f
        FROM counts c, (SELECT unnest(range(2, 5)) AS s), (SELECT unnest(range(1, 5)) AS i) WHERE s < c.size AND i + s - 1 <= c.size) p
    JOIN counts o ON o.lang = p.lang AND o.words = p.part WHERE 100 * p.f >= 100 * o.f),
named AS (
    SELECT b.lang, array_to_string(b.words, ' ') AS phrase, b.a, b.l, b.r, b.n, b.score
    FROM best b ANTI JOIN inside i ON i.lang = b.lang AND i.part = b.words)
SELECT lang, rank::INTEGER AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM named) WHERE rank <= 2000
"""


@query("op12_stream_collocations", SQL)
def op12_stream_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))
