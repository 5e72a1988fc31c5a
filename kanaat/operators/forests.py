"""Forests of classification trees, many at once: random forests, extra trees with drawn cuts, bagged trees on
feature subspaces and single trees, for any number of settings and folds in the same few jobs.

All trees grow level by level; one job grows a level of all of them. A task holds a piece of the training rows (at
most ``PIECE_ROWS`` and ``PIECE_BYTES``) and a share of the trees; for every open node it counts the classes on either side of the cuts
the node may use. Counts of several pieces are added up by node before the best cut is taken. Trees are flat arrays of
nodes, and every node knows its share of class 1, so a tree cut off at a lower depth is one grown to that depth:
settings that differ in depth or in the number of trees are scored from the same trees.

Cuts of ordinary trees are at most ``CUTS`` quantiles of a term's weights; a drawn cut is uniform between the least
and the greatest weight the node's rows have. Whether a row is taken, which terms a node or a tree may use and where
a cut is drawn depend on the seed, the tree and the row or node alone, never on the pieces. Row counts, also those of
``min_leaf`` and ``min_split``, count a row as often as it was taken. Ties go to the smaller term, then to the lower cut.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kanaat.functions.fixed_values import SEED

# A task's rows, and the bytes of their weights as a matrix, at most.
PIECE_ROWS, PIECE_BYTES, CUTS = 1 << 15, 80 << 20, 31
# Chances of 0, 1, 2 .. takes of a row are tabled to this many.
MOST_TAKES = 16
Batches = Iterator[pa.RecordBatch]


@dataclass(frozen=True)
class Forest:
    """How a forest grows. ``rows``: mean number of times a row is taken, None for every row once. ``per_node`` and
    ``per_tree``: shares of the terms a node or a tree may use, "sqrt" for the root of their number. ``unseen``: the
    fold its trees leave out."""

    trees: int = 100
    depth: int = 30
    min_leaf: float = 1.0
    min_split: float = 2.0
    rows: float | None = 1.0
    per_node: float | str = "sqrt"
    per_tree: float = 1.0
    drawn: bool = False
    seed: int = SEED
    unseen: int | None = None

    def terms_per_node(self, terms: int) -> int:
        share = terms ** 0.5 if self.per_node == "sqrt" else self.per_node * terms
        return max(1, min(terms, int(share)))


@dataclass
class Trees:
    """Grown trees as arrays over their nodes; the root of tree i is node i. ``below``: the first of a node's two
    children, 0 for a leaf; a row goes to the first one if its weight of ``term`` is at most ``cut``."""

    term: np.ndarray
    cut: np.ndarray
    below: np.ndarray
    chance: np.ndarray
    trees: int

    def score(self, weights: np.ndarray, depth: int | None = None, trees: int | None = None) -> np.ndarray:
        """Mean share of class 1 over the (first) trees, cut off at ``depth``."""
        total, rows = np.zeros(len(weights)), np.arange(len(weights))
        for tree in range(self.trees if trees is None else trees):
            at, live, level = np.full(len(weights), tree), rows, 0
            while len(live) and (depth is None or level < depth):
                live = live[self.below[at[live]] > 0]
                node = at[live]
                at[live] = self.below[node] + (weights[live, self.term[node]] > self.cut[node])
                level += 1
            total += self.chance[at]
        return total / max(1, self.trees if trees is None else trees)

    def bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, term=self.term, cut=self.cut, below=self.below, chance=self.chance, trees=self.trees)
        return out.getvalue()

    @classmethod
    def of(cls, raw: bytes) -> Trees:
        held = np.load(io.BytesIO(raw))
        return cls(held["term"], held["cut"], held["below"], held["chance"], int(held["trees"]))


def hashed(*parts) -> np.ndarray:
    """A repeatable uniform number in [0, 1) for whole numbers or arrays of them."""
    x = np.uint64(0x243F6A8885A308D3)
    with np.errstate(over="ignore"):
        for part in parts:
            x = x ^ np.asarray(part).astype(np.int64).view(np.uint64)
            x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
            x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
            x = x ^ (x >> np.uint64(33))
    return (x >> np.uint64(11)) / float(1 << 53)


def takes(forest: Forest, tree: int, ids: np.ndarray) -> np.ndarray:
    """How often the tree takes each row."""
    if forest.rows is None:
        return np.ones(len(ids))
    k = np.arange(MOST_TAKES)
    logs = k * np.log(forest.rows) - forest.rows - np.cumsum(np.log(np.maximum(k, 1)))
    return np.searchsorted(np.cumsum(np.exp(logs)), hashed(forest.seed, 1, tree, ids), "right").astype(float)


def allowed_terms(forest: Forest, tree: int, nodes: np.ndarray, terms: int) -> np.ndarray:
    """The terms each node (numbered within its tree's levels) may use, ascending."""
    many = forest.terms_per_node(terms)
    if forest.per_tree < 1.0:
        own = np.sort(np.argsort(hashed(forest.seed, 2, tree, np.arange(terms)), kind="stable")[:max(1, int(forest.per_tree * terms))])
    else:
        own = np.arange(terms)
    if many >= len(own):
        return np.broadcast_to(own, (len(nodes), len(own)))
    drawn = hashed(forest.seed, 3, tree, nodes[:, None] * np.int64(terms) + own[None, :])
    return np.sort(own[np.argpartition(drawn, many - 1, axis=1)[:, :many]], axis=1)


def dense(column: pa.Array, terms: int) -> np.ndarray:
    """The weights of a batch of vectors (unwrapped: type, size, indices, values) as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    kind = column.field("type").to_numpy(zero_copy_only=False)
    values, indices = column.field("values"), column.field("indices")
    out = np.zeros((len(column), terms))
    counts = np.diff(values.offsets.to_numpy())
    row = np.repeat(np.arange(len(column)), counts)
    flat = values.flatten().to_numpy(zero_copy_only=False)
    full = kind[row] == 1
    place = np.empty(len(flat), np.int64)
    place[~full] = indices.flatten().to_numpy(zero_copy_only=False)
    place[full] = (np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts))[full]
    out[row, place] = flat
    return out


def term_cuts(train: DataFrame, terms: int) -> list[np.ndarray]:
    """Cuts of every term: half its least positive weight, then quantiles of its positive weights."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            weights = dense(batch.column(0), terms)
            row, term = np.nonzero(weights)
            yield pa.RecordBatch.from_arrays([pa.array(term.astype(np.int32)), pa.array(weights[row, term])], ["term", "weight"])

    held = train.select(F.unwrap_udt("features").alias("v")).mapInArrow(run, "term int, weight double")
    shares = F.lit([(i + 1) / CUTS for i in range(CUTS - 1)])
    found = held.groupBy("term").agg(F.min(F.when(F.col("weight") > 0, F.col("weight"))).alias("least"),
                                     F.percentile_approx("weight", shares, F.lit(1000)).alias("cuts"))
    out = [np.zeros(0)] * terms
    for r in found.collect():  # one row for each term of the vocabulary
        out[r.term] = np.unique(np.array([*([r.least / 2] if r.least else []), *r.cuts]))
    return out


class Piece:
    """A task's rows: their positive weights row by row, with the bin of each among its term's cuts; class, fold, id."""

    def __init__(self, batches: list[pa.RecordBatch], cuts: list[np.ndarray]) -> None:
        held = pa.Table.from_batches(batches)
        self.ids = held.column("id").to_numpy()
        self.label = held.column("label").to_numpy().astype(np.int64)
        self.fold = held.column("fold").to_numpy()
        self.weights = dense(held.column("v"), len(cuts))
        if (self.weights < 0).any():
            raise ValueError("weights below 0")
        row, self.term = np.nonzero(self.weights)
        self.count = np.bincount(row, minlength=len(self.ids))
        self.begin = np.cumsum(self.count) - self.count
        self.value = self.weights[row, self.term]
        self.bin = np.empty(len(row), np.uint8)  # at most CUTS + 1
        by_term = np.argsort(self.term.astype(np.uint16) if len(cuts) <= 1 << 16 else self.term, kind="stable")
        ends = np.append(0, np.cumsum(np.bincount(self.term, minlength=len(cuts))))
        for term, own in enumerate(cuts):
            here = by_term[ends[term]:ends[term + 1]]
            self.bin[here] = np.searchsorted(own, self.value[here], "left")
        self.bins = np.zeros(self.weights.shape, np.uint8)
        self.bins[row, self.term] = self.bin

    def at(self, state: Trees, tree: int, rows: np.ndarray) -> np.ndarray:
        """The node each of the rows has come to."""
        node, live = np.full(len(rows), tree), np.arange(len(rows))
        while len(live):
            live = live[state.below[node[live]] > 0]
            here = node[live]
            node[live] = state.below[here] + (self.weights[rows[live], state.term[here]] > state.cut[here])
        return node


@dataclass
class Entries:
    """The positive weights of a tree's rows in terms their nodes may use: place of the node, place among the node's
    terms, term, bin, weight, class, times the row is taken; and of every node the terms it may use, what its rows
    count, by class, and how many they are."""

    slot: np.ndarray
    place: np.ndarray
    term: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    label: np.ndarray
    taken: np.ndarray
    allowed: np.ndarray
    totals: np.ndarray
    rows: np.ndarray

    @classmethod
    def of(cls, piece: Piece, rows: np.ndarray, slot: np.ndarray, taken: np.ndarray, allowed: np.ndarray) -> Entries:
        nodes, many, terms = *allowed.shape, piece.weights.shape[1]
        if many * len(rows) <= 2 * piece.count[rows].sum():  # few terms a node: each is looked up
            at = rows[:, None] * np.int64(terms) + allowed[slot]
            value = piece.weights.ravel()[at]
            own, place = np.nonzero(value)
            at, value = at[own, place], value[own, place]
            term, bin_ = at % terms, piece.bins.ravel()[at]
        else:
            count = piece.count[rows]
            at = np.repeat(piece.begin[rows] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
            own, term = np.repeat(np.arange(len(rows)), count), piece.term[at]
            if many == terms:
                place = term
            else:
                alike = allowed.strides[0] == 0  # one list for all nodes
                place_of = np.full((1 if alike else nodes, terms), -1, np.int32)
                np.put_along_axis(place_of, allowed[:1] if alike else allowed, np.arange(many, dtype=np.int32)[None, :], axis=1)
                place = place_of[0][term] if alike else place_of[slot[own], term]
                keep = np.flatnonzero(place >= 0)
                at, own, term, place = at[keep], own[keep], term[keep], place[keep].astype(np.int64)
            value, bin_ = piece.value[at], piece.bin[at]
        label = piece.label[rows]
        totals = np.bincount(2 * slot + label, taken, 2 * nodes).reshape(nodes, 2)
        return cls(slot[own], place, term, bin_, value, label[own], taken[own], allowed, totals, np.bincount(slot, minlength=nodes))

    def counted(self, bins: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys (node * terms + term) * (CUTS + 2) + bin in order and their class counts, ``bins`` being those
        of the entries."""
        nodes, many = self.allowed.shape
        width = CUTS + 2
        cells, key = nodes * many * width, (self.slot * many + self.place) * width + bins
        if cells <= 4 * len(key):
            sums = np.bincount(2 * key + self.label, self.taken, 2 * cells).reshape(cells, 2)
            key = np.flatnonzero(sums.any(axis=1))
            sums = sums[key]
        else:
            order = np.argsort(key, kind="stable")
            key = key[order]
            begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
            of = np.cumsum(np.append(False, key[1:] != key[:-1]))[:len(key)]
            sums = np.bincount(2 * of + self.label[order], self.taken[order], 2 * len(begin)).reshape(-1, 2)
            key = key[begin]
        pair, own_bin = key // width, key % width
        slot = pair // many
        return (slot * terms + self.allowed[slot, pair % many]) * width + own_bin, sums

    def ranges(self, terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each (node, term) that has positive weights, by its number: least and greatest of them, and how many."""
        key = self.slot * terms + self.term
        order = np.argsort(key, kind="stable")
        key = key[order]
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        value = self.value[order]
        if not len(key):
            return key, value, value, begin
        return key[begin], np.minimum.reduceat(value, begin), np.maximum.reduceat(value, begin), np.diff(np.append(begin, len(key)))


def counted(key: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their class counts."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[begin], (np.add.reduceat(classes[order], begin, axis=0) if len(begin) else np.zeros((0, 2)))


def best_cuts(key: np.ndarray, classes: np.ndarray, totals: np.ndarray, terms: int, forest: Forest) -> tuple[np.ndarray, ...]:
    """Of each node: whether it is divided, the term, the bin up to which rows go to the first side, and the counts (side,
    class). ``key``: (node * terms + term) * (CUTS + 2) + bin, ascending, with class counts; other rows have weight 0."""
    nodes, width = len(totals), CUTS + 2
    divided, term, cut, sides = np.zeros(nodes, bool), np.zeros(nodes, np.int64), np.zeros(nodes, np.int64), np.zeros((nodes, 2, 2))
    if not len(key):
        return divided, term, cut, np.stack([totals, np.zeros_like(totals)], axis=1)
    pair, own_bin = key // width, key % width
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    size = np.diff(np.append(first, len(pair)))
    upto = np.cumsum(classes, axis=0)
    before = (upto - classes)[first]
    within = upto - np.repeat(before, size, axis=0)
    positive = within[first + size - 1]
    zero = totals[pair[first] // terms] - positive
    # Cuts behind weight 0 (and bin 0), then behind each bin that occurs.
    low = np.where((own_bin[first] == 0)[:, None], within[first], 0.0)
    left = np.concatenate([zero + low, np.repeat(zero, size, axis=0) + within])
    of, bins = np.concatenate([pair[first], pair]), np.concatenate([np.zeros(len(first), np.int64), own_bin])
    if forest.drawn:
        left, of, bins = left[:len(first)], of[:len(first)], bins[:len(first)]
    order = np.argsort(of * width + bins, kind="stable")
    left, of, bins = left[order], of[order], bins[order]
    node = of // terms
    right = totals[node] - left

    def squares(x: np.ndarray) -> np.ndarray:
        n = x.sum(-1)
        return np.where(n > 1e-9, (x * x).sum(-1) / np.maximum(n, 1e-9), 0.0)

    gain = np.round(squares(left) + squares(right) - squares(totals)[node], 9)
    gain[(left.sum(-1) < max(forest.min_leaf, 1e-9)) | (right.sum(-1) < max(forest.min_leaf, 1e-9))] = -1.0
    start = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
    most = np.maximum.reduceat(gain, start)
    hit = np.flatnonzero(gain == np.repeat(most, np.diff(np.append(start, len(node)))))
    best = hit[np.searchsorted(hit, start)]
    at = node[start]
    divided[at] = (most > 1e-9) & (totals[at].sum(-1) >= forest.min_split)
    term[at], cut[at] = of[best] % terms, bins[best]
    sides[:, 0] = totals
    sides[at] = np.stack([left[best], right[best]], axis=1)
    return divided, term, cut, sides


def grow(train: DataFrame, forests: list[Forest], terms: int, cores: int | None = None) -> list[Trees]:
    """The forests of (id long, label 0/1, features, fold int if any leaves one out), one after another as given."""
    spark, rows = train.sparkSession, train.count()
    cores = cores or spark.sparkContext.defaultParallelism
    pieces = max(1, -(-rows // max(1, min(PIECE_ROWS, PIECE_BYTES // (8 * max(1, terms))))))
    shares = max(1, min(-(-cores // pieces), sum(f.trees for f in forests)))
    fold = F.col("fold") if "fold" in train.columns else F.lit(-1)
    flat = train.select(F.col("id").cast("long").alias("id"), F.col("label").cast("int").alias("label"), fold.cast("int").alias("fold"),
                        F.unwrap_udt("features").alias("v"))
    # A small table goes to several tasks, each of which grows a share of the trees on it; a large one is in many pieces already.
    held = flat.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))).withColumn(
        "piece", F.pmod(F.xxhash64("id"), F.lit(pieces)))
    # Each share of a piece is a task of its own; by hashes several would meet in one and leave others empty.
    held = held.repartitionById(pieces * shares, (F.col("piece") * shares + F.col("share")).cast("int")).persist()
    owner = [(i, t) for i, f in enumerate(forests) for t in range(f.trees)]
    try:
        cuts = term_cuts(train, terms)
        state = Trees(np.zeros(len(owner), np.int32), np.zeros(len(owner)), np.zeros(len(owner), np.int64), np.zeros(len(owner)), len(owner))
        forest_of = np.array([i for i, _ in owner])
        inside = np.ones(len(owner), np.int64)  # a node's number within its tree: 1, then 2n and 2n + 1 below n
        tree_of, open_ = np.arange(len(owner)), np.arange(len(owner))
        for level in range(max(f.depth for f in forests)):
            depth = np.array([f.depth for f in forests])
            open_ = open_[level < depth[forest_of[tree_of[open_]]]]
            if not len(open_):
                break
            sent = spark.sparkContext.broadcast((state, open_, tree_of[open_], inside[open_], cuts, owner, forests, shares))
            found = _level(held, sent, pieces).toPandas()
            sent.destroy()
            if level == 0:
                state.chance[:] = 0.5
                first = found.drop_duplicates("node")
                n = first[["l0", "l1", "r0", "r1"]].to_numpy()
                state.chance[first["node"].to_numpy()] = (n[:, 1] + n[:, 3]) / np.maximum(n.sum(1), 1e-300)
            found = found[found["divided"]].sort_values("node")
            node, sides = found["node"].to_numpy(), found[["l0", "l1", "r0", "r1"]].to_numpy().reshape(-1, 2, 2)
            new = len(state.term) + 2 * np.arange(len(node))
            state.term[node], state.cut[node], state.below[node] = found["term"], found["cut"], new
            children = np.stack([new, new + 1], axis=1).ravel()
            state = Trees(np.append(state.term, np.zeros(len(children), np.int32)), np.append(state.cut, np.zeros(len(children))),
                          np.append(state.below, np.zeros(len(children), np.int64)),
                          np.append(state.chance, (sides[:, :, 1] / np.maximum(sides.sum(-1), 1e-300)).ravel()), state.trees)
            tree_of = np.append(tree_of, np.repeat(tree_of[node], 2))
            number = inside[node] if level < 40 else (hashed(9, inside[node]) * (1 << 40)).astype(np.int64)
            inside = np.append(inside, np.stack([2 * number, 2 * number + 1], axis=1).ravel())
            open_ = children[(sides.min(-1) > 0).ravel()]
    finally:
        held.unpersist()
    return [_alone(state, tree_of, np.flatnonzero(forest_of == i)) for i in range(len(forests))]


def _alone(state: Trees, tree_of: np.ndarray, trees: np.ndarray) -> Trees:
    """Some trees with nodes of their own numbering, roots first."""
    mine = np.flatnonzero(np.isin(tree_of, trees))
    to = np.zeros(len(tree_of), np.int64)
    to[mine] = np.arange(len(mine))
    return Trees(state.term[mine], state.cut[mine], np.where(state.below[mine] > 0, to[state.below[mine]], 0), state.chance[mine], len(trees))


FOUND = "node long, divided boolean, term int, cut double, l0 double, l1 double, r0 double, r1 double"


def _rows(nodes: np.ndarray, divided, term, cut, sides) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes), pa.array(divided), pa.array(term.astype(np.int32)), pa.array(cut.astype(np.float64)),
         *(pa.array(sides[:, a, b]) for a in (0, 1) for b in (0, 1))], [f.split()[0] for f in FOUND.split(", ")])


def _chosen(key: np.ndarray, classes: np.ndarray, totals: np.ndarray, forest: Forest, nodes: np.ndarray, cuts: list[np.ndarray], edge_of) -> pa.RecordBatch:
    divided, term, cut, sides = best_cuts(key, classes, totals, len(cuts), forest)
    if forest.drawn:
        value = edge_of(np.arange(len(nodes)), term)
    else:
        value = np.array([cuts[t][c] if c < len(cuts[t]) else np.inf for t, c in zip(term.tolist(), cut.tolist(), strict=True)])
        divided &= np.isfinite(value)
    return _rows(nodes, divided, term, value, sides)


def _open_trees(piece: Piece, sent, share: int) -> Iterator[tuple]:
    """For each open tree of the share: its forest, its open nodes and their numbers, the rows in them, each row's place among these nodes and how often it is taken."""
    state, open_, trees, inside, _, owner, forests, shares = sent.value
    order = np.argsort(trees, kind="stable")
    begin = np.flatnonzero(np.append(True, np.diff(trees[order]) != 0))
    for a, b in zip(begin, np.append(begin[1:], len(order)), strict=True):
        tree = int(trees[order[a]])
        if tree % shares != share:
            continue
        which, number = owner[tree]
        forest, nodes = forests[which], open_[order[a:b]]
        taken = takes(forest, number, piece.ids)
        if forest.unseen is not None:
            taken[piece.fold == forest.unseen] = 0.0
        rows = np.flatnonzero(taken > 0)
        at = piece.at(state, tree, rows)
        slot = np.minimum(np.searchsorted(nodes, at), len(nodes) - 1)
        here = nodes[slot] == at
        yield forest, number, nodes, inside[order[a:b]], rows[here], slot[here], taken[rows[here]]


def _drawn(forest: Forest, number: int, inside: np.ndarray, term: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low + (high - low) * hashed(forest.seed, 4, number, inside * np.int64(1 << 20) + term)


def _edges(forest: Forest, number: int, inside: np.ndarray, terms: int, key: np.ndarray, low: np.ndarray, high: np.ndarray,
           many: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The drawn cut of each (node, term) by its number; a node with rows of weight 0 begins there."""
    slot, term = key // terms, key % terms
    return _drawn(forest, number, inside[slot], term, np.where(many < rows[slot], 0.0, low), high)


def _level(held: DataFrame, sent, pieces: int) -> DataFrame:
    """The best cut of every open node."""
    width = CUTS + 2

    def tasks(batches: Batches) -> Iterator[tuple]:
        by_share: dict[tuple, list] = {}
        for batch in batches:
            table = pa.Table.from_batches([batch])
            place = table.column("share").to_numpy().astype(np.int64) * pieces + table.column("piece").to_numpy()
            for p in np.unique(place).tolist():
                by_share.setdefault(p, []).extend(table.take(pa.array(np.flatnonzero(place == p))).to_batches())
        terms = len(sent.value[4])
        for place, own in by_share.items():
            piece = Piece(own, sent.value[4])
            for forest, number, nodes, inside, rows, slot, taken in _open_trees(piece, sent, place // pieces):
                entries = Entries.of(piece, rows, slot, taken, allowed_terms(forest, number, inside, terms))
                yield entries, forest, number, nodes, inside

    def counts_of(entries: Entries, edges: tuple | None, terms: int) -> tuple[np.ndarray, np.ndarray]:
        if edges is None:
            return entries.counted(entries.bin, terms)
        return entries.counted(entries.value > edges[1][np.searchsorted(edges[0], entries.slot * terms + entries.term)], terms)

    def lookup(edges: tuple, terms: int):
        return lambda slot, term: edges[1][np.minimum(np.searchsorted(edges[0], slot * terms + term), len(edges[0]) - 1)] if len(edges[0]) else np.zeros(len(slot))

    if pieces == 1:  # a tree's rows are together
        def whole(batches: Batches) -> Batches:
            cuts = sent.value[4]
            for entries, forest, number, nodes, inside in tasks(batches):
                edges = None
                if forest.drawn:
                    key, low, high, many = entries.ranges(len(cuts))
                    edges = key, _edges(forest, number, inside, len(cuts), key, low, high, many, entries.rows)
                key, classes = counts_of(entries, edges, len(cuts))
                yield _chosen(key, classes, entries.totals, forest, nodes, cuts, lookup(edges, len(cuts)) if edges else None)

        return held.mapInArrow(whole, FOUND)

    spark = held.sparkSession
    ranges = None
    if any(f.drawn for f in sent.value[6]):
        def reach(batches: Batches) -> Batches:  # term -1: how many rows the node has
            terms = len(sent.value[4])
            for entries, forest, _, nodes, _ in tasks(batches):
                if forest.drawn:
                    key, low, high, many = entries.ranges(terms)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([nodes[key // terms], nodes])), pa.array(np.concatenate([key % terms, np.full(len(nodes), -1)]).astype(np.int32)),
                         pa.array(np.concatenate([low, np.zeros(len(nodes))])), pa.array(np.concatenate([high, np.zeros(len(nodes))])),
                         pa.array(np.concatenate([many, entries.rows]))], ["node", "term", "low", "high", "many"])

        met = held.mapInArrow(reach, "node long, term int, low double, high double, many long").groupBy("node", "term").agg(
            F.min("low").alias("low"), F.max("high").alias("high"), F.sum("many").alias("many"))
        found = met.orderBy("node", "term").toPandas()  # as many rows as open nodes have terms
        rows = found[found["term"] < 0].set_index("node")["many"]
        found = found[found["term"] >= 0]
        low = np.where(found["many"].to_numpy() < rows.loc[found["node"]].to_numpy(), 0.0, found["low"].to_numpy())
        ranges = spark.sparkContext.broadcast((found["node"].to_numpy(), found["term"].to_numpy(), low, found["high"].to_numpy()))

    def edges_of(forest: Forest, number: int, nodes: np.ndarray, inside: np.ndarray, terms: int) -> tuple | None:
        if not forest.drawn:
            return None
        node, term, low, high = ranges.value
        a, b = np.searchsorted(node, nodes, "left"), np.searchsorted(node, nodes, "right")
        at = np.concatenate([np.arange(x, y) for x, y in zip(a, b, strict=True)]) if len(nodes) else np.zeros(0, np.int64)
        slot = np.repeat(np.arange(len(nodes)), b - a)
        return slot * terms + term[at], _drawn(forest, number, inside[slot], term[at], low[at], high[at])

    def part(batches: Batches) -> Batches:
        terms = len(sent.value[4])
        for entries, forest, number, nodes, inside in tasks(batches):
            key, classes = counts_of(entries, edges_of(forest, number, nodes, inside, terms), terms)
            ends = np.searchsorted(key, np.arange(len(nodes) + 1) * terms * width)
            raw = [b"".join([np.array([b - a], "<i8").tobytes(), (key[a:b] % (terms * width)).astype("<i8").tobytes(), np.ascontiguousarray(classes[a:b]).tobytes(),
                             entries.totals[i].tobytes()]) for i, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True))]
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(raw, pa.binary())], ["node", "counts"])

    def together(batches: Batches) -> Batches:
        _, open_, trees, inside, cuts, owner, forests, _ = sent.value

        def out(node: int, parts: list[bytes]) -> pa.RecordBatch:
            at = int(np.searchsorted(open_, node))
            which, number = owner[trees[at]]
            sizes = [int(np.frombuffer(raw, "<i8", 1)[0]) for raw in parts]
            key = np.concatenate([np.frombuffer(raw, "<i8", n, 8) for raw, n in zip(parts, sizes, strict=True)])
            classes = np.concatenate([np.frombuffer(raw, "<f8", 2 * n, 8 + 8 * n).reshape(n, 2) for raw, n in zip(parts, sizes, strict=True)])
            totals = sum(np.frombuffer(raw, "<f8", 2, 8 + 24 * n) for raw, n in zip(parts, sizes, strict=True)).reshape(1, 2)
            nodes = np.array([node])
            edges = edges_of(forests[which], number, nodes, inside[at:at + 1], len(cuts))
            return _chosen(*counted(key, classes), totals, forests[which], nodes, cuts, lookup(edges, len(cuts)) if edges else None)

        last, parts = None, []
        for batch in batches:
            for node, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if node != last and parts:
                    yield out(last, parts)
                    parts = []
                last = node
                parts.append(raw)
        if parts:
            yield out(last, parts)

    counts = held.mapInArrow(part, "node long, counts binary")
    return counts.repartition(max(1, held.rdd.getNumPartitions()), "node").sortWithinPartitions("node").mapInArrow(together, FOUND)


def scorer(spark: SparkSession, trees: Trees, terms: int) -> Callable[[Column], Column]:
    """A column function from a vector column to the mean share of class 1. The trees travel once to every worker,
    the plan does not grow with them."""
    sent = spark.sparkContext.broadcast(trees)

    @F.pandas_udf("double")
    def score(vectors: pd.DataFrame) -> pd.Series:
        table = pa.StructArray.from_arrays(
            [pa.array(vectors["type"], pa.int8()), pa.array(vectors["indices"], pa.list_(pa.int32())), pa.array(vectors["values"], pa.list_(pa.float64()))],
            ["type", "indices", "values"])
        out = [sent.value.score(dense(table.slice(a, 2048), terms)) for a in range(0, len(table), 2048)]
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return lambda features: score(F.unwrap_udt(features))


def unseen_scores(folded: DataFrame, grown: list[tuple[str, int, Trees, int | None, int | None]], terms: int) -> DataFrame:
    """(id, one column for each name) of rows with a ``fold``: each row is scored by the trees that left its fold out.
    ``grown``: name, fold, trees, and how deep and how many of them count."""
    names = sorted({g[0] for g in grown})
    sent = folded.sparkSession.sparkContext.broadcast(grown)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            fold, weights = batch.column(1).to_numpy(), dense(batch.column(2), terms)
            out = {name: np.full(len(fold), np.nan) for name in names}
            for name, left_out, trees, depth, many in sent.value:
                here = np.flatnonzero(fold == left_out)
                if len(here):
                    out[name][here] = trees.score(weights[here], depth, many)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(out[name]) for name in names)], ["id", *names])

    rows = folded.select(F.col("id").cast("long").alias("id"), F.col("fold").cast("int").alias("fold"), F.unwrap_udt("features").alias("v"))
    return rows.mapInArrow(run, ", ".join(["id long", *(f"`{name}` double" for name in names)]))
