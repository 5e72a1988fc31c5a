"""Similarity join of texts by their 5-word shingles, Jaccard 0.8 or more, by rare-first prefixes.

All shingles have one order: the `FREQUENT` commonest ones of the corpus last, by rising count, all others before them
by hash. Two sets that are similar enough share a shingle among the first ``n - ceil(0.8 n) + 1`` of each, so only
these prefixes are joined. Then, for each pair of texts:

* length filter: the smaller set has at least 0.8 of the larger one's size;
* positional filter: the shingles that both prefixes share, and all of what one set has behind its prefix, must be
  able to reach the overlap that is needed;
* suffix filter: so must the sums over 256 hash ranges of what both sets could share in each;
* the sets themselves, once for each pair.

Texts with equal words are one node. A group of thousands of near copies shares its prefixes with itself; so first each
text meets one text per shingle (the most central one of about its size), links found are made components, and only
texts of different components meet each other after that. Every link between components is still found, so the
components are those of all links.

Texts of different components meet only at a shingle that may be the first they share: what either set has from there
on must reach the overlap that is needed. Rows are dealt by shingle and by the size classes that this leaves open, and
within these by component: a family is one row beside the others until another component can reach it.

Shingles are 48-bit hashes, nodes 64-bit ones. Texts without words and null texts have empty sets and link with
nothing; null ids are kept and never name a component (it is null where no text has an id); repeated rows are one
node; an empty table gives no rows. Other columns are left out (`one_of_each` keeps them, whatever their names).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kanaat.llm.batches import STEP, Texts, chunks, lowered, mix, per_row, set_aside, small_batches, span_hashes, tidy, with_text_columns, words
from kanaat.llm.registry import query, table
from kanaat.llm.statistics import windows
from kanaat.llm.storage import stored
from kanaat.session import fits

SIMILAR, OF = 80, 100
WINDOW = 5
# How many shingles the order knows by count. Only speed depends on it.
FREQUENT = 1_000_000
# Shingles a task holds while it counts, and node ids that may be sent to every task.
HELD, SENT = 500_000, 1_000_000
# Bytes of text, and sets, that a task works on at once.
PIECE, SETS = 1 << 18, 2000
# Sizes of a class differ by less than this factor.
CLASS = 1.1
# A shingle counted so often is dealt by node, too, while shingles of one node are looked for.
HOT, HOT_PARTS = 1000, 64
BITS = np.uint64((1 << 48) - 1)


def shingles(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles of each text, by row and hash, and a 64-bit digest of each text's words."""
    data = lowered(texts.data)
    start, end, row = words(Texts(data, texts.at, texts.first))
    hashes = span_hashes(data, start, end)
    keys, begin = windows(hashes, row, WINDOW)
    n = per_row(row, texts.rows)
    digest = np.zeros(texts.rows, np.uint64)
    place = np.arange(len(row)) - np.searchsorted(row, row)
    np.add.at(digest, row, mix(hashes + (place.astype(np.uint64) + np.uint64(1)) * STEP))
    short = np.flatnonzero((n > 0) & (n < WINDOW))
    keys = np.concatenate([keys, mix(digest[short])]) & BITS
    rows = np.concatenate([row[begin], short])
    order = np.lexsort((keys, rows))
    keys, rows = keys[order], rows[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    return rows[new], keys[new], mix(digest + n.astype(np.uint64))


def frequent(docs: DataFrame, text_col: str = "text", most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """The commonest shingles (sorted), `most` at the most, and their counts. A task sends on what it has seen in two
    texts or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flushed():
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts > 1
            return pa.RecordBatch.from_arrays([pa.array(keys[often].view(np.int64)), pa.array(counts[often])], ["key", "n"])

        for batch in batches:
            for texts in chunks(batch.column(0), PIECE):
                held.append(shingles(texts)[1])
                size += len(held[-1])
                if size > HELD:
                    yield flushed()
                    held, size = [], 0
        if size:
            yield flushed()

    counts = stored(small_batches(docs).select(text_col).mapInArrow(tidy(run), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "join-counts")
    # How many shingles have a count of each class (a factor of 1.07) tells from which count on they are few enough.
    level = F.floor(F.log2("n") * 10).cast("int")
    room, least = most, None
    for row in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        room -= row["count"]
        if room < 0:
            break
        least = row["level"]
    top = counts.where(level >= least if least is not None else F.lit(False)).toArrow()
    keys, n = top.column("key").to_numpy().astype(np.uint64), top.column("n").to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


def packed(keys: np.ndarray) -> np.ndarray:
    """48-bit numbers as six bytes each."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).reshape(-1)


def unpacked(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return wide.reshape(-1).view("<u8")


def prefix_length(n):
    return n - (SIMILAR * n + OF - 1) // OF + 1


def ordered_sets(docs: DataFrame, common: tuple[np.ndarray, np.ndarray], text_col: str = "text") -> DataFrame:
    """``doc_id``, ``node``, ``n`` and the text's ``shingles`` in the common order, six bytes each."""
    keys_, counts_ = common

    def make(texts: Texts) -> dict:
        row, key, node = shingles(texts)
        level = np.zeros(len(key), np.int64)
        if len(keys_):
            at = np.minimum(np.searchsorted(keys_, key), len(keys_) - 1)
            level = np.where(keys_[at] == key, counts_[at], 0)
        key = key[np.lexsort((key, level, row))]
        n = per_row(row, texts.rows)
        raw, end = packed(key).tobytes(), np.cumsum(n) * 6
        return {"node": node.view(np.int64), "n": n, "shingles": [raw[e - 6 * m:e] for e, m in zip(end.tolist(), n.tolist(), strict=True)]}

    return with_text_columns(docs, text_col, make, "node long, n long, shingles binary", ["doc_id"], PIECE)


def prefixes(sets: DataFrame, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``token``, ``node``, ``n``, ``place`` in the set (from 0) and ``part``: the prefixes of all sets; of equal sets in
    a piece one. ``part`` is 0, or a number by node for a token that was counted `HOT` times or more."""
    hot = common[0][common[1] >= HOT]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, SETS) for whole in batches for i in range(0, whole.num_rows, SETS)):
            node, n = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            once = np.unique(node, return_index=True)[1]
            once = once[n[once] > 0]
            if len(once):
                take = prefix_length(n[once])
                raw = batch.column(2)
                keys = np.concatenate([unpacked(raw[int(i)].as_py()[:6 * int(k)]) for i, k in zip(once, take, strict=True)])
                place, nodes = np.arange(len(keys)) - np.repeat(np.cumsum(take) - take, take), np.repeat(node[once], take)
                part = np.zeros(len(keys), np.int32)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, keys), len(hot) - 1)
                    part = np.where(hot[at] == keys, 1 + nodes % HOT_PARTS, 0).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(nodes), pa.array(np.repeat(n[once], take)), pa.array(place), pa.array(part)],
                    ["token", "node", "n", "place", "part"])

    return sets.select("node", "n", "shingles").mapInArrow(tidy(run), "token long, node long, n long, place long, part int")


def reaches(shared: Column, n: Column, m: Column) -> Column:
    """Length and positional filter: whether sets of n and m shingles whose prefixes share so many may be similar."""
    behind = F.greatest(n - prefix_of(n), m - prefix_of(m))
    return (OF * F.least(n, m) >= SIMILAR * F.greatest(n, m)) & ((OF + SIMILAR) * (shared + behind) >= SIMILAR * (n + m))


def prefix_of(n: Column) -> Column:
    return n - F.floor((SIMILAR * n + OF - 1) / OF) + 1


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar. Each pair is met once, beside its texts' sets."""
    nodes = stored(pairs.select(F.explode(F.array("a", "b")).alias("_node")).distinct(), "join-nodes")
    few = F.broadcast(nodes) if fits(nodes, SENT) else nodes
    needed = stored(sets.select("node", "shingles").join(few, F.col("node") == F.col("_node"), "left_semi").groupBy("node").agg(
        F.first("shingles").alias("shingles")), "join-sets")
    both = (pairs.join(needed.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
            .join(needed.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = unpacked(x.as_py()), unpacked(y.as_py())
                enough = -(-SIMILAR * (len(x) + len(y)) // (OF + SIMILAR))
                most = np.minimum(np.bincount((x & np.uint64(255)).astype(np.int64), minlength=256), np.bincount((y & np.uint64(255)).astype(np.int64), minlength=256)).sum()
                keep.append(bool(most >= enough and len(np.intersect1d(x, y, assume_unique=True)) >= enough))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(tidy(run), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node reachable) of all nodes of the links, by passing on smallest labels
    and following them."""
    edges = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "join-edges")
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "join-labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), F.col("label").alias("_l")), "b").groupBy(F.col("a").alias("node")).agg(F.min("_l").alias("_near"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("_old"), F.least("label", "_near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("_next"))
        moved = stored(lower.join(jump, "label", "left").select("node", "_old", F.least("label", F.coalesce("_next", "label")).alias("label")), "join-labels")
        labels = moved.select("node", "label")
        if moved.where(F.col("label") != F.col("_old")).isEmpty():
            return labels


def shared_tokens(met: DataFrame, shared: DataFrame) -> DataFrame:
    """The pairs (x, y) of ``met`` that the length and positional filters leave, as (a, b), a the smaller node."""
    overlap = (met.join(shared.select(F.col("node").alias("x"), "token"), "x").join(shared.select(F.col("node").alias("y"), "token"), ["y", "token"])
               .groupBy("x", "y", "n_x", "n_y").agg(F.count(F.lit(1)).alias("_shared")))
    return overlap.where(reaches(F.col("_shared"), F.col("n_x"), F.col("n_y"))).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def size_class(n: Column, ratio: float) -> Column:
    return F.floor(F.log(n.cast("double")) / float(np.log(ratio))).cast("int")


def meeting(open_: DataFrame) -> DataFrame:
    """Pairs (x, y), with ``n_x <= n_y``, of different labels that share a token which may be the first they share.

    From a place on a set of n has n - place shingles; that they reach the overlap needed with m bounds m by ``most``.
    The smaller set is dealt to the classes of the larger sizes it may meet, the larger one to those of the smaller,
    then labels meet by the least size and highest bound of their rows, then rows of labels that can reach each other."""
    most = F.floor((OF + SIMILAR) * (F.col("n") - F.col("place")) / SIMILAR) - F.col("n")
    rows = open_.withColumn("most", most).withColumn("own", size_class(F.col("n"), CLASS))
    larger = F.least("most", F.floor(OF * F.col("n") / SIMILAR))
    smaller, smallest = F.least("most", "n"), F.ceil(SIMILAR * F.col("n") / OF)
    x = rows.where(larger >= F.col("n")).withColumn("c", F.explode(F.sequence("own", size_class(larger, CLASS)))).select(
        "token", F.col("own").alias("c_x"), F.col("c").alias("c_y"), "label", "alone", "node", "n", "most")
    y = rows.where(smaller >= smallest).withColumn("c", F.explode(F.sequence(size_class(smallest, CLASS), size_class(smaller, CLASS)))).select(
        "token", F.col("c").alias("c_x"), F.col("own").alias("c_y"), "label", "alone", "node", "n", "most")
    key = ["token", "c_x", "c_y"]

    def groups(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy(*key, F.col("label").alias(f"label_{name}"), F.col("alone").alias(f"alone_{name}")).agg(
            F.min("n").alias(f"low_{name}"), F.max("most").alias(f"most_{name}"))

    labels = groups(x, "x").join(groups(y, "y"), key).where(
        (F.col("label_x") != F.col("label_y")) & (F.col("low_x") <= F.col("most_y")) & (F.col("low_y") <= F.col("most_x")))
    labels = stored(labels, "join-label-pairs")
    # A text without links is its label, and its bounds are exact; only members of components are looked up.
    of_x = x.where(~F.col("alone")).select(*key, F.col("label").alias("label_x"), F.col("node").alias("x"), F.col("n").alias("n_x"), F.col("most").alias("m_x"))
    of_y = y.where(~F.col("alone")).select(*key, F.col("label").alias("label_y"), F.col("node").alias("y"), F.col("n").alias("n_y"), F.col("most").alias("m_y"))
    other = [*key, "label_y", "alone_y", "low_y", "most_y"]
    some = labels.where("alone_x").select(*other, F.col("label_x").alias("x"), F.col("low_x").alias("n_x"), F.col("most_x").alias("m_x")).unionByName(
        labels.where("not alone_x").join(of_x, [*key, "label_x"]).select(*other, "x", "n_x", "m_x")).where(
        (F.col("n_x") <= F.col("most_y")) & (F.col("low_y") <= F.col("m_x")))
    rest = ["x", "n_x", "m_x"]
    pairs = some.where("alone_y").select(*rest, F.col("label_y").alias("y"), F.col("low_y").alias("n_y"), F.col("most_y").alias("m_y")).unionByName(
        some.where("not alone_y").join(of_y, [*key, "label_y"]).select(*rest, "y", "n_y", "m_y"))
    return pairs.where(
        (F.col("n_x") <= F.col("n_y")) & (F.col("n_x") <= F.col("m_y")) & (F.col("n_y") <= F.col("m_x"))
        & (OF * F.col("n_x") >= SIMILAR * F.col("n_y"))).select("x", "n_x", "y", "n_y").distinct()


def rows_of(shared: DataFrame, met: DataFrame) -> DataFrame:
    """The rows of ``shared`` of the nodes in ``met``."""
    nodes = stored(met.select(F.explode(F.array("x", "y")).alias("_node")).distinct(), "join-nodes")
    return shared.join(F.broadcast(nodes) if fits(nodes, SENT) else nodes, F.col("node") == F.col("_node"), "left_semi")


def linked(sets: DataFrame, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Components of all links between the nodes of ``sets``."""
    # Shingles of one node only are left out. Hot ones stay without a look, so that none of them meets in one task.
    together = Window.partitionBy("token", "part")
    dealt = prefixes(sets, common).repartition("token", "part").distinct()
    shared = stored(dealt.withColumns({"_low": F.min("node").over(together), "_high": F.max("node").over(together)}).where(
        "part > 0 or _low != _high").select("token", "node", "n", "place"), "join-shared")
    # First each text meets, for each shingle, the most central of the texts of about its size: the one whose prefix is
    # shared to the largest part. Of a family it is the text that the others derive from.
    central = shared.groupBy(F.col("node").alias("_node")).agg(F.count(F.lit(1)).alias("_d"))
    sizes = shared.join(central, F.col("node") == F.col("_node")).select(
        "token", "node", "n", size_class(F.col("n"), OF / SIMILAR).alias("size"), F.floor(F.col("_d") * -1000.0 / prefix_of(F.col("n"))).alias("off"))
    hubs = sizes.groupBy("token", "size").agg(F.min(F.struct("off", "n", "node")).alias("hub"), F.count(F.lit(1)).alias("_many")).where("_many > 1")
    met = sizes.join(hubs, ["token", "size"]).where(F.col("node") != F.col("hub.node")).select(
        F.col("node").alias("x"), F.col("n").alias("n_x"), F.col("hub.node").alias("y"), F.col("hub.n").alias("n_y")).distinct()
    first = stored(shared_tokens(met, shared), "join-pairs")
    links = stored(verified(first, sets), "join-links")
    found = components(links)
    # Then texts of different components meet where a shingle may be the first they share.
    labelled = stored(shared.join(found.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").select(
        "token", "node", "n", "place", F.coalesce("label", "node").alias("label"), F.col("label").isNull().alias("alone")), "join-labelled")
    mixed = labelled.groupBy("token").agg(F.min("label").alias("_low"), F.max("label").alias("_high")).where("_low != _high").select("token")
    apart = stored(meeting(stored(labelled.join(mixed, "token", "left_semi"), "join-open")), "join-meeting")
    more = stored(shared_tokens(apart, rows_of(shared, apart)).join(first, ["a", "b"], "left_anti"), "join-pairs")
    if more.isEmpty():
        return found
    again = stored(verified(more, sets), "join-links")
    return found if again.isEmpty() else components(links.unionByName(again))


def similar_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``node`` (equal words, equal node), ``label`` (the component's smallest node) and
    ``component_id`` of every row of ``docs``."""
    common = frequent(docs, text_col)
    sets = stored(ordered_sets(docs, common, text_col), "join-all-sets")
    found = linked(sets, common)
    rows = sets.select("doc_id", "n", "node")
    nodes = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first"))
    named = nodes.join(found.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left").select(
        "node", "first", F.coalesce("label", "node").alias("label"))
    least = named.groupBy("label").agg(F.min("first").alias("component_id"))
    names = named.join(least, "label").select(F.col("node").alias("_node"), "label", "component_id")
    return rows.join(names, (F.col("node") == F.col("_node")) & (F.col("n") > 0), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "node", "label",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those that are similar to one with a smaller id; texts without words all stay.
    Of rows with one id, or with none, one of each component stays."""
    docs, own = set_aside(docs, ["doc_id", "text"])
    found = stored(similar_documents(docs).select("doc_id", "n_shingles", "node", "label", "component_id"), "join-found")
    gone = found.where("doc_id != component_id").select(F.col("doc_id").alias("_gone"))
    many = found.groupBy("doc_id").count().where("count > 1 or doc_id is null").select(F.col("doc_id").alias("_many"))
    many, gone = stored(many, "join-many"), stored(gone.distinct(), "join-gone")
    unclear = docs.join(F.broadcast(many) if fits(many, SENT) else many, F.col("doc_id").eqNullSafe(F.col("_many")), "left_anti")
    plain = unclear.join(F.broadcast(gone) if fits(gone, SENT) else gone, F.col("doc_id") == F.col("_gone"), "left_anti")
    if many.isEmpty():
        return own(plain)
    repeated = docs.join(many, F.col("doc_id").eqNullSafe(F.col("_many")), "left_semi")

    def node_of(texts: Texts) -> dict[str, np.ndarray]:
        row, _, node = shingles(texts)
        return {"_node": node.view(np.int64), "_n": per_row(row, texts.rows)}

    labels = found.where("n_shingles > 0").select(F.col("node").alias("_k"), F.col("label").alias("_label"), F.col("component_id").alias("_id")).distinct()
    with_nodes = with_text_columns(repeated, "text", node_of, "_node long, _n long")
    chosen = with_nodes.where("_n > 0").join(labels, F.col("_node") == F.col("_k")).where(
        F.col("_id").eqNullSafe(F.col("doc_id"))).dropDuplicates(["_label"])
    return own(plain.unionByName(chosen.select(*docs.columns)).unionByName(with_nodes.where("_n = 0").select(*docs.columns)))


@query("op9_rare_first_join")
def op9_rare_first_join(spark: SparkSession, folder: str) -> DataFrame:
    return similar_documents(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")
