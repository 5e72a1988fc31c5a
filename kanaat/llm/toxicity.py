"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text.

Both dictionaries share the content that zstandard's trainer picks from ordinary windows, as toxic texts are mostly
ordinary prose too; after it the toxic one has the words, stems and phrases that mark toxic texts, the ordinary one as
many bytes of the commonest ordinary words and the single words of those phrases. What marks is chosen by evidence
alone, whatever share of the toxic texts has it: a bound on the chance that labels dealt at random would give a word so
many toxic texts, at a rate of false choices of `FALSE_MARKS`. This differs from two dictionaries trained each on the
windows of one class, which was measured and found worse (README).

Windows are the words between their separators and, where a marked phrase may begin, the next two and three words. A
window is compressed with either dictionary, and the
bytes that the toxic one saves are its distance; a fixed tail that both dictionaries end with lets the compressor look
for matches up to the window's end and makes sizes comparable to the byte. Equal windows are compressed once by a
worker. The distances of a text (the largest, and the rate of windows at each of `MARKED`) are calibrated by a logistic
regression on labelled rows that the dictionaries have not seen.

Fitting uses a bounded sample (`SAMPLE_ROWS` labelled rows, the smallest hashes of their ids); near copies in it count
once. Only texts are inputs of a score. Null and empty texts have no windows and get the calibrated base rate. Repeated
rows get equal scores, null ids are kept. Without labels of both classes every text gets the share of toxic labels.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kanaat.llm import logistic
from kanaat.llm.batches import Texts, chunks, lowered, mix, per_row, per_worker, span_hashes, spread, with_text_columns, words
from kanaat.llm.labelled import sampled_labels
from kanaat.llm.registry import query, table
from kanaat.llm.statistics import windows
from kanaat.llm.storage import stored

SAMPLE_ROWS = 8_000
# Ordinary windows of so many words that the dictionary trainer sees, and bytes of what it may pick.
TRAINER_WINDOWS, TRAINER_WORDS, SHARED_BYTES = 5_000, 8, 8192
# A word, stem or phrase may mark toxic texts from so many of them and from this many times the share of ordinary ones,
# and among all that are tried at most this share of the chosen is expected to be chance.
LEAST_TEXTS, LEAST_RATIO, FALSE_MARKS = 3, 2.0, 0.001
# Beginnings of words that may mark as well as whole words.
STEMS = (4, 5, 6, 7, 8)
# Numbers of words of a phrase.
PHRASES = (2, 3)
# Bytes saved from which windows are counted; at this probability a text is predicted toxic.
MARKED, PREDICT_FROM = (2, 3, 4, 5), 0.3
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Stands before every word, so that a match from a word's beginning weighs more than one inside it.
BEFORE = b"\x01\x02"
TAIL = BEFORE + bytes(range(128, 144))
MOST_KEPT = 2_000_000


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    calibration: logistic.Logistic
    # Hashes of the words that marked phrases begin with, sorted.
    openers: np.ndarray


def joined(words_) -> bytes:
    return b"".join(BEFORE + w.encode() for w in words_)


def spans(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case bytes and the start, end and row of each window's word."""
    data = lowered(texts.data)
    return data, *words(Texts(data, texts.at, texts.first), PUNCTUATION)


def compressor(content: bytes):
    import zstandard

    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    settings = zstandard.ZstdCompressionParameters.from_level(
        3, dict_size=len(content), source_size=64, min_match=4, strategy=zstandard.STRATEGY_GREEDY, search_log=6,
        write_content_size=False, write_checksum=False, write_dict_id=False)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings)


def sizes(data: bytes, begin: np.ndarray, length: np.ndarray, content: bytes) -> np.ndarray:
    """Compressed length of each stretch of ``data``."""
    import zstandard

    made = per_worker(f"zstd {zlib.crc32(content)} {len(content)}", lambda: compressor(content))
    places = np.stack([begin, length], axis=1).astype("<u8").tobytes()
    out = made.multi_compress_to_buffer(zstandard.BufferWithSegments(data, places), threads=0)
    return np.fromiter((len(out[i]) for i in range(len(out))), np.int64, len(out))


def window_distances(data: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, count: np.ndarray, model: Model) -> np.ndarray:
    """Bytes that the toxic dictionary saves on each window of ``count`` words from word ``first``."""
    word, of = spread(first, count), np.repeat(np.arange(len(first)), count)
    start, end = start[word], end[word]
    piece = len(BEFORE) + end - start
    length = per_row(of, len(first), piece) + len(TAIL)
    begin = np.cumsum(length) - length
    at = np.cumsum(piece) - piece + of * len(TAIL)
    buffer = np.empty(int(length.sum()), np.uint8)
    for i, byte in enumerate(BEFORE):
        buffer[at + i] = byte
    buffer[spread(at + len(BEFORE), end - start)] = data[spread(start, end - start)]
    buffer[spread(begin + length - len(TAIL), np.full(len(first), len(TAIL)))] = np.tile(np.frombuffer(TAIL, np.uint8), len(first))
    raw = buffer.tobytes()
    return sizes(raw, begin, length, model.ordinary) - sizes(raw, begin, length, model.toxic)


def distances(data: np.ndarray, start: np.ndarray, end: np.ndarray, row: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The distance and row of every window; distances of windows seen before are kept in the worker."""
    held = per_worker(f"distances {zlib.crc32(model.toxic)} {zlib.crc32(model.ordinary)}", dict)
    key, value = held.get("key", np.zeros(0, np.uint64)), held.get("value", np.zeros(0, np.int16))
    words_ = span_hashes(data, start, end)
    all_hashes, starts, counts = [words_], [np.arange(len(words_))], [np.ones(len(words_), np.int64)]
    opens = np.isin(words_, model.openers)
    for n in PHRASES if opens.any() else ():
        keys, begin = windows(words_, row, n)
        here = opens[begin]
        all_hashes.append(keys[here])
        starts.append(begin[here])
        counts.append(np.full(int(here.sum()), n))
    begin, count = np.concatenate(starts), np.concatenate(counts)
    hashes, first, which = np.unique(np.concatenate(all_hashes), return_index=True, return_inverse=True)
    at = np.minimum(np.searchsorted(key, hashes), max(0, len(key) - 1))
    new = np.flatnonzero(key[at] != hashes) if len(key) else np.arange(len(hashes))
    if len(new):
        if len(key) + len(new) > MOST_KEPT:
            key, value, new = key[:0], value[:0], np.arange(len(hashes))
        found = window_distances(data, start, end, begin[first[new]], count[first[new]], model)
        key, value = np.concatenate([key, hashes[new]]), np.concatenate([value, found.astype(np.int16)])
        order = np.argsort(key, kind="stable")
        key, value = key[order], value[order]
        held["key"], held["value"] = key, value
    return value[np.searchsorted(key, hashes)][which].astype(np.int64), row[begin]


def evidence(texts: Texts, model: Model) -> np.ndarray:
    """Rows of the largest distance, the logs of the windows in a thousand at each of the MARKED distances, and of all words."""
    data, start, end, row = spans(texts)
    most, marked = np.zeros(texts.rows), np.zeros((len(MARKED), texts.rows))
    many = per_row(row, texts.rows)
    if len(start):
        d, of = distances(data, start, end, row, model)
        np.maximum.at(most, of, d)
        for i, least in enumerate(MARKED):
            marked[i] = np.bincount(of, d >= least, texts.rows) * 1000 / np.maximum(many, 1)
    return np.column_stack([most, *np.log1p(marked), np.log1p(many)])


def sketches(texts: Texts) -> dict[str, list]:
    """Four smallest-hash values of each text's 5-word windows, its distinct words and phrases, and stretches of its words."""
    data, start, end, row = spans(texts)
    hashes = span_hashes(data, start, end)
    keys, begin = windows(hashes, row)
    out = np.tile(np.arange(texts.rows, dtype=np.uint64), (4, 1))
    for j in range(4):
        if len(keys):
            least = np.full(texts.rows, np.iinfo(np.uint64).max)
            np.minimum.at(least, row[begin], mix(keys ^ np.uint64(977 * j + 1)))
            long = per_row(row[begin], texts.rows) > 0
            out[j, long] = least[long]
    raw, first = data.tobytes(), np.searchsorted(row, np.arange(texts.rows + 1))
    in_order = [[raw[a:b].decode("utf-8", "replace") for a, b in zip(start[i:j].tolist(), end[i:j].tolist(), strict=True)]
                for i, j in zip(first[:-1], first[1:], strict=True)]
    stretches = [[" ".join(ws[i:i + TRAINER_WORDS]) for i in range(0, len(ws), TRAINER_WORDS)] for ws in in_order]
    phrases = [sorted({" ".join(ws[i:i + n]) for n in PHRASES for i in range(len(ws) - n + 1)}) for ws in in_order]
    return {"sketch": list(out.T.view(np.int64)), "words": [sorted(set(ws)) for ws in in_order], "phrases": phrases, "stretches": stretches}


def first_of_copies(rows: list) -> list[int]:
    """Row numbers of texts that share no sketch value with one before."""
    seen: set[tuple[int, int]] = set()
    kept = []
    for r in rows:
        values = list(enumerate(r["sketch"]))
        if not any(v in seen for v in values):
            kept.append(r["_row"])
        seen.update(values)
    return kept


def chance(toxic, ordinary, share: float):
    """Log of a bound (Chernoff) on the chance that of a word's texts so many or more are toxic, if labels fell at random."""
    toxic, ordinary = (c.cast("double") for c in (toxic, ordinary))
    part = toxic / (toxic + ordinary)
    rest = F.when(ordinary > 0, ordinary * (F.log(F.lit(1 - share)) - F.log1p(-part))).otherwise(0.0)
    return toxic * (F.log(F.lit(share)) - F.log(part)) + rest


def marking(counts: DataFrame, toxic: int, ordinary: int) -> list[str]:
    """Words, stems and phrases that mark toxic texts by ``counts`` (word, toxic, ordinary) over so many texts of each class."""
    if not toxic or not ordinary:
        return []
    tried = counts.where((F.col("toxic") >= LEAST_TEXTS) & (F.col("toxic") * ordinary > F.col("ordinary") * toxic)).withColumn(
        "chance", F.round(chance(F.col("toxic"), F.col("ordinary"), toxic / (toxic + ordinary)), 6))
    levels = sorted((r["chance"], r["count"]) for r in tried.groupBy("chance").count().collect())
    total, so_far, limit = sum(n for _, n in levels), 0, None
    for value, n in levels:
        so_far += n
        if value <= np.log(FALSE_MARKS * so_far / total):
            limit = value
    if limit is None:
        return []
    ratio = (F.col("toxic") / toxic) / ((F.col("ordinary") + 1) / ordinary)
    chosen = {r["word"] for r in tried.where((F.col("chance") <= limit) & (ratio >= LEAST_RATIO)).select("word").collect()}
    single = sorted(w for w in chosen if " " not in w)
    known = set(single)
    # A longer mark holds its beginnings; a phrase marks only if none of its words does.
    longest = [w for w, after in zip(single, [*single[1:], ""], strict=False) if not after.startswith(w)]
    phrases = [p for p in chosen if " " in p and not any(w in known or any(w[:n] in known for n in STEMS) for w in p.split(" "))]
    return longest + sorted(phrases)


def fitted(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Dictionaries and calibration from ``labels.toxic`` of the rows that are not held out."""
    import zstandard

    spark = docs.sparkSession
    chosen = sampled_labels(labels, "toxic", sample_rows, where=~held_out(F.col("doc_id"))).withColumnRenamed("doc_id", "_id")
    known = stored(docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).orderBy(
        F.xxhash64("doc_id", "text")).limit(sample_rows).select("text", "label", F.monotonically_increasing_id().alias("_row")), "toxic-sample")
    learn, check = (known.where(F.col("_row") % 2 == half) for half in (0, 1))
    seen = stored(with_text_columns(learn, "text", sketches, "sketch array<long>, words array<string>, phrases array<string>, stretches array<string>", ["_row", "label"]), "toxic-words")
    kept = first_of_copies(seen.select("_row", "sketch").orderBy("_row").collect())
    ids = spark.createDataFrame([(i,) for i in kept], "_kept long")
    once = seen.join(F.broadcast(ids), F.col("_row") == F.col("_kept"))
    texts = dict(once.groupBy("label").count().collect())
    toxic, ordinary = texts.get(1, 0), texts.get(0, 0)
    stems = F.array_distinct(F.flatten(F.transform("words", lambda w: F.concat(F.array(w), *[
        F.when(F.length(w) > n, F.array(F.substring(w, 1, n))).otherwise(F.array().cast("array<string>")) for n in STEMS]))))
    counts = stored(once.select("label", F.concat(stems, "phrases").alias("stems")).select("label", F.explode("stems").alias("word")).groupBy("word").agg(
        F.sum(F.col("label")).alias("toxic"), F.sum(1 - F.col("label")).alias("ordinary")).where(
        (F.col("toxic") >= LEAST_TEXTS) | ~F.contains("word", F.lit(" "))), "toxic-counts")
    top = marking(counts, toxic, ordinary)
    parts = sorted({w for p in top if " " in p for w in p.split(" ")})
    marks, single = joined(w for p in top for w in p.split(" ")), joined(parts)
    room = max(0, len(marks) - len(single))
    common = counts.where((F.col("ordinary") > 0) & ~F.contains("word", F.lit(" "))).orderBy(F.desc("ordinary"), "word").limit(room // len(BEFORE) + 1).collect()
    plain = (joined(r["word"] for r in common) + bytes(room))[:room] + single
    first = pa.array(sorted({p.split(" ")[0] for p in top if " " in p}), pa.string())
    openers = [span_hashes(data, start, end) for data, start, end, _ in map(spans, chunks(first))] if len(first) else []
    stretches = seen.where("label = 0").select(F.explode("stretches").alias("w"))
    samples = [joined(r["w"].split(" ")) for r in stretches.orderBy(F.xxhash64("w"), "w").limit(TRAINER_WINDOWS).collect()]
    try:
        shared = zstandard.train_dictionary(SHARED_BYTES, samples, k=32, d=6, level=3).as_bytes()
    except zstandard.ZstdError:  # too little text for the trainer: the text itself
        shared = b" ".join(samples)[:SHARED_BYTES]
    model = Model(shared + marks + TAIL, shared + plain + TAIL, logistic.fit(np.zeros((0, len(MARKED) + 2)), np.zeros(0, np.int64)),
                  np.unique(np.concatenate([np.zeros(0, np.uint64), *openers])))
    rows = with_text_columns(check, "text", lambda t: {"x": list(evidence(t, model))}, "x array<double>", ["_row", "label"]).orderBy("_row").collect()
    x = np.array([r["x"] for r in rows], np.float64).reshape(len(rows), len(MARKED) + 2)
    model.calibration = logistic.fit(x, np.array([r["label"] for r in rows], np.int64))
    return model


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def scored(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) with ``score``, the probability that a text is toxic."""
    return with_text_columns(docs, text_col, lambda t: {"score": model.calibration.probability(evidence(t, model))}, "score double", keep)


@query("op4_compression_toxicity")
def op4_compression_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = fitted(docs, table(spark, folder, "labels"))
    return scored(docs, model, keep=["doc_id"]).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"))
