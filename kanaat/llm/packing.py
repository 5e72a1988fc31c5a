"""Best-fit packing of tokenised documents into sequences by a grouping genetic algorithm on islands.

Documents longer than a sequence are cut into pieces; full pieces are sequences of their own. All others are dealt to
blocks of about `BLOCK_ITEMS` pieces. Every block is solved by several islands, each a task's work: epochs of crossover
and mutation, after which an island's best solution moves to the next island of its block. A block that has reached
the fewest sequences its total allows stops at once, so evolution is spent only where best fit alone falls short.
Sequences that stay less than full are dissolved and their pieces packed again in new blocks, until one block holds
them all or nothing is gained; blocks thus cost at most a partly filled sequence over the whole corpus, not each.

A block's size is bounded whatever the input; rows are dealt by number, so equal rows or sizes don't meet in one task.
Null and empty texts are one end token. Null or repeated ids are kept: a piece is a row. Other columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kanaat.llm import grouping
from kanaat.llm.batches import chunks, small_batches, tidy
from kanaat.llm.pretokens import tokenizer_path
from kanaat.llm.registry import query, table
from kanaat.llm.storage import stored
from kanaat.llm.token_ids import encoded, with_end

SEQUENCE, END_ID = 2048, 0
BLOCK_ITEMS, ISLANDS, EPOCHS, GENERATIONS, MEMBERS = 4096, 3, 2, 12, 4
ROUNDS = 4
# Text encoded at once; pieces of a megabyte cost a worker 34 MB more.
TEXT_BYTES = 1 << 18
# A sequence with more free room than this is packed again.
FULL_ENOUGH = 8


def token_pieces(docs: DataFrame, tokenizer: str | None = None, most: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length`` and ``ids_crc32`` of each document's pieces, with their ``ids`` if
    wanted. A document longer than ``most`` is cut so that all its pieces but the first are full."""
    of = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer or tokenizer_path()
        for batch in batches:
            for texts in chunks(batch.column(1), TEXT_BYTES):
                ids, counts = with_end(*encoded(texts, path), END_ID)
                n = -(-counts // most)
                row = np.repeat(np.arange(texts.rows), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                first = counts - (n - 1) * most
                start = np.where(piece == 0, 0, first[row] + (piece - 1) * most)
                length = np.where(piece == 0, first[row], most)
                begin = (np.cumsum(counts) - counts)[row] + start
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a:4 * (a + b)]) for a, b in zip(begin.tolist(), length.tolist(), strict=True)]
                out = [batch.column(0).take(pa.array(row + texts.first)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    at = np.append(np.cumsum(length) - length, len(ids)).astype(np.int32)
                    out, names = [*out, pa.ListArray.from_arrays(pa.array(at), pa.array(ids.view(np.int32)))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(out, names)

    schema = f"doc_id {of}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return small_batches(docs).select("doc_id", "text").mapInArrow(tidy(run), schema)


def epoch(state: DataFrame, number: int, capacity: int) -> DataFrame:
    """One epoch of every island: rows of (block, island, sizes, population), the population sent on best first."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            populations = []
            for block, island, sizes, population in zip(frame["block"], frame["island"], frame["sizes"], frame["population"], strict=True):
                seed = hash((int(block), int(island), number))
                populations.append(grouping.evolved([int(s) for s in sizes], capacity, [[int(x) for x in p] for p in population], seed,
                                                    GENERATIONS, MEMBERS))
            yield frame[["block", "island", "numbers", "sizes"]].assign(population=populations)

    return state.mapInPandas(tidy(run), "block long, island int, numbers array<long>, sizes array<int>, population array<array<int>>")


def migrated(state: DataFrame, islands: int) -> DataFrame:
    """Every island's best solution also goes to the next island of its block, in place of the worst one there."""
    elite = state.select("block", ((F.col("island") + 1) % islands).alias("island"), F.col("population")[0].alias("elite"))
    own = F.when(F.size("population") > 1, F.slice("population", 1, F.size("population") - 1)).otherwise(F.col("population"))
    return state.join(elite, ["block", "island"]).select("block", "island", "numbers", "sizes", F.concat(own, F.array("elite")).alias("population"))


def packed_blocks(items: DataFrame, capacity: int, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """``number``, ``length``, ``block``, ``bin``, ``offset`` and ``room`` (left in the bin) of every item of
    ``items`` (block, number, length)."""
    blocks = items.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("number", "length"))).alias("items")).select(
        "block", F.col("items.number").alias("numbers"), F.col("items.length").cast("array<int>").alias("sizes"))
    state = (blocks.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(islands)])))
             .withColumn("population", F.array().cast("array<array<int>>"))
             .select("block", "island", "numbers", "sizes", "population")
             .repartition(F.col("block"), F.col("island")))
    for number in range(epochs):
        state = stored(epoch(migrated(state, islands) if number else state, number, capacity), "packing-islands")

    def best(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for block, numbers, sizes, of in zip(frame["block"], frame["numbers"], frame["sizes"], frame["best"], strict=True):
                sizes, of = np.asarray(sizes, np.int64), np.asarray(of, np.int64)
                room = capacity - np.bincount(of, sizes).astype(np.int64)
                yield pd.DataFrame({"number": numbers, "length": sizes, "block": block, "bin": of, "offset": grouping.offsets(sizes, of), "room": room[of]})

    bins = F.array_max(F.col("population")[0])
    used = F.struct(bins.alias("bins"), F.col("island"))
    chosen = state.groupBy("block").agg(F.min(used).alias("least"))
    winners = state.join(chosen, "block").where((bins == F.col("least.bins")) & (F.col("island") == F.col("least.island")))
    return winners.select("block", "numbers", "sizes", F.col("population")[0].alias("best")).mapInPandas(
        best, "number long, length long, block long, bin long, offset long, room long")


def packed(pieces: DataFrame, capacity: int = SEQUENCE) -> DataFrame:
    """The rows of a stored table ``pieces`` (with ``length`` up to ``capacity``) with ``sequence_id`` and ``offset``."""
    numbered = pieces.withColumn("_number", F.monotonically_increasing_id())
    whole = numbered.where(F.col("length") == capacity).withColumns({"sequence_id": F.col("_number") * 2 + 1, "offset": F.lit(0).cast("long")})
    rest = numbered.where(F.col("length") < capacity)
    rest = stored(rest, "packing-items")
    items, places = rest.select(F.col("_number").alias("number"), "length"), []
    count, before = items.count(), None
    for step in range(ROUNDS):
        blocks = max(1, round(count / BLOCK_ITEMS))
        dealt = items.withColumn("block", F.pmod(F.xxhash64("number", F.lit(step)), F.lit(blocks)))
        done = stored(packed_blocks(dealt, capacity), "packing-done")
        loose = done.where(F.col("room") > FULL_ENOUGH)
        bins = loose.select("block", "bin").distinct().count()
        last = step == ROUNDS - 1 or blocks == 1 or bins < 2 or (before is not None and bins >= before)
        final = done if last else done.where(F.col("room") <= FULL_ENOUGH)
        id_ = ((F.col("block") * BLOCK_ITEMS * 16 + F.col("bin")) * ROUNDS + step) * 2
        places.append(final.select("number", id_.alias("sequence_id"), "offset"))
        if last:
            break
        items, before = loose.select("number", "length"), bins
        count = items.count()
    placed = places[0]
    for more in places[1:]:
        placed = placed.unionByName(more)
    joined = rest.join(placed, F.col("_number") == F.col("number")).drop("number")
    return joined.unionByName(whole).drop("_number")


def packed_sequences(docs: DataFrame, tokenizer: str | None = None, capacity: int = SEQUENCE) -> DataFrame:
    """The pieces of all documents with the sequence and the place in it that each one has."""
    return packed(stored(token_pieces(docs, tokenizer, capacity), "packing-pieces"), capacity)


@query("op1_grouping_genetic_packing")
def op1_grouping_genetic_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_sequences(table(spark, folder, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
