"""Forests grown together against a plain grower with the same draws."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from kanaat.operators import forests as R


def table(n=260, terms=12, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.integers(1, 9, (n, terms)) / 8.0 * (rng.random((n, terms)) < 0.4)
    y = ((x[:, 2] > 0.3) ^ (x[:, 5] > 0.6) ^ (rng.random(n) < 0.1)).astype(int)
    return x, y


def as_rows(spark, x, y, folds=4):
    rows = [(i, float(y[i]), Vectors.sparse(x.shape[1], {int(j): float(x[i, j]) for j in np.flatnonzero(x[i])}) if i % 3 else Vectors.dense(x[i]), i % folds)
            for i in range(len(y))]
    return spark.createDataFrame(rows, ["id", "label", "features", "fold"])


def plain_tree(x, y, ids, forest, tree, cuts):
    """(depth first) the same tree, one node and one cut at a time."""
    taken = R.takes(forest, tree, ids)
    if forest.unseen is not None:
        taken[ids % 4 == forest.unseen] = 0

    def share(rows):
        return taken[rows][y[rows] == 1].sum() / taken[rows].sum()

    def gini(rows):
        n = taken[rows].sum()
        return sum(taken[rows][y[rows] == c].sum() ** 2 for c in (0, 1)) / n if n else 0.0

    def grow(rows, number, depth):
        leaf = ("leaf", share(rows))
        if depth == forest.depth or len(set(y[rows])) < 2 or taken[rows].sum() < forest.min_split:
            return leaf
        best = None
        for term in R.allowed_terms(forest, tree, np.array([number]), x.shape[1])[0].tolist():
            values = x[rows, term]
            if forest.drawn:
                tried = [R._drawn(forest, tree, np.int64(number), np.int64(term), values.min(), values.max())]
            else:
                tried = cuts[term]
            for cut in tried:
                left, right = rows[values <= cut], rows[values > cut]
                if min(taken[left].sum(), taken[right].sum()) < max(forest.min_leaf, 1e-9):
                    continue
                gain = round(gini(left) + gini(right) - gini(rows), 9)
                if gain > 1e-9 and (best is None or gain > best[0]):
                    best = gain, term, cut, left, right
        if best is None:
            return leaf
        return ("node", best[1], best[2], share(rows), grow(best[3], 2 * number, depth + 1), grow(best[4], 2 * number + 1, depth + 1))

    return grow(np.flatnonzero(taken > 0), 1, 0)


def plain_score(tree, row, depth):
    while tree[0] == "node" and depth:
        tree, depth = (tree[4] if row[tree[1]] <= tree[2] else tree[5]), depth - 1
    return tree[1] if tree[0] == "leaf" else tree[3]


SHAPES = {
    "forest": R.Forest(trees=6, depth=5, min_leaf=3, min_split=8),
    "extra": R.Forest(trees=6, depth=6, rows=None, drawn=True),
    "bagged": R.Forest(trees=5, rows=0.7, per_node=1.0, per_tree=0.7),
    "single": R.Forest(trees=1, rows=None, per_node=1.0),
    "unseen": R.Forest(trees=4, depth=4, unseen=2),
}


@pytest.mark.parametrize("rows_of_a_piece", [8192, 50])
def test_trees_equal_a_plain_grower(spark, monkeypatch, rows_of_a_piece):
    monkeypatch.setattr(R, "PIECE_ROWS", rows_of_a_piece)
    x, y = table()
    df = as_rows(spark, x, y)
    grown = R.grow(df, list(SHAPES.values()), x.shape[1])
    cuts, ids = R.term_cuts(df, x.shape[1]), np.arange(len(y))
    for forest, trees in zip(SHAPES.values(), grown):
        plain = [plain_tree(x, y, ids, forest, t, cuts) for t in range(forest.trees)]
        for depth in (None, 2):
            expected = [np.mean([plain_score(t, row, 99 if depth is None else depth) for t in plain]) for row in x]
            assert np.allclose(trees.score(x, depth), expected)
        assert np.allclose(trees.score(x, trees=1), [plain_score(plain[0], row, 99) for row in x])


def test_bagged_trees_use_their_own_terms_and_cuts_lie_inside():
    forest = SHAPES["bagged"]
    own = [set(R.allowed_terms(forest, t, np.arange(1, 40), 100).ravel().tolist()) for t in range(5)]
    assert all(len(o) == 70 for o in own) and len(set(map(frozenset, own))) == 5
    drawn = R._drawn(SHAPES["extra"], 0, np.arange(1, 4000), np.int64(3), 0.2, 0.6)
    assert 0.2 <= drawn.min() < 0.22 and 0.58 < drawn.max() <= 0.6 and abs(drawn.mean() - 0.4) < 0.01
    taken = R.takes(R.Forest(rows=0.7), 0, np.arange(20_000))
    assert abs(taken.mean() - 0.7) < 0.02 and abs(taken.var() - 0.7) < 0.03


def test_scores_in_a_plan_that_does_not_grow(spark):
    x, y = table()
    df = as_rows(spark, x, y)
    few, many = R.grow(df, [R.Forest(trees=2), R.Forest(trees=60)], x.shape[1])
    plans = []
    for trees in (few, many):
        scored = df.select("id", R.scorer(spark, trees, x.shape[1])(F.col("features")).alias("p"))
        plans.append(len(scored._jdf.queryExecution().toString()))
        assert np.allclose([r.p for r in scored.orderBy("id").collect()], trees.score(x))
    assert abs(plans[0] - plans[1]) < 50
    back = R.Trees.of(many.bytes())
    assert np.array_equal(back.score(x), many.score(x)) and ((many.score(x) > 0.5) == y).mean() > 0.9
    assert df.limit(0).select(R.scorer(spark, few, x.shape[1])(F.col("features"))).count() == 0


def test_one_class_and_no_positive_weight(spark):
    x = np.zeros((20, 3))
    for y in (np.ones(20, int), np.arange(20) % 2):
        trees, = R.grow(as_rows(spark, x, y), [R.Forest(trees=2, rows=None)], 3)
        assert np.allclose(trees.score(x), y.mean()) and len(trees.term) == 2


def test_each_share_of_a_piece_is_a_task(spark, monkeypatch):
    x, y = table()
    seen, level = [], R._level

    def watched(held, sent, pieces):
        if not seen:
            found = held.groupBy(F.spark_partition_id().alias("task")).agg(F.countDistinct("share", "piece").alias("n"), F.count(F.lit(1)).alias("rows"))
            seen.extend((r.n, r.rows) for r in found.collect())
        return level(held, sent, pieces)

    monkeypatch.setattr(R, "_level", watched)
    R.grow(as_rows(spark, x, y), [R.Forest(trees=16, depth=1)], x.shape[1], cores=16)
    assert seen == [(1, len(y))] * 16


@pytest.mark.parametrize("terms_of_a_node", [2, 300])
def test_terms_looked_up_are_those_walked_through(terms_of_a_node):
    """Few terms a node are looked up, many are found by walking through the rows' weights; both count the same."""
    import pyarrow as pa

    x, y = table(terms=300)
    rng, cuts, width = np.random.default_rng(2), [np.array([0.1, 0.5])] * 300, R.CUTS + 2
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * 300), pa.array(x.ravel()))
    v = pa.StructArray.from_arrays([pa.array(np.ones(len(x), np.int8)), pa.array([None] * len(x), pa.list_(pa.int32())), lists], ["type", "indices", "values"])
    ints = [pa.array(a.astype(np.int32)) for a in (y, y)]
    piece = R.Piece([pa.RecordBatch.from_arrays([pa.array(np.arange(len(x))), *ints, v], ["id", "label", "fold", "v"])], cuts)
    rows, slot = np.arange(0, len(x), 2), rng.integers(0, 3, len(x))[::2]
    taken, allowed = rng.integers(1, 4, len(rows)).astype(float), R.allowed_terms(R.Forest(per_node=terms_of_a_node / 300), 0, np.arange(3), 300)
    entries = R.Entries.of(piece, rows, slot, taken, allowed)
    expected = {}
    for row, node, times in zip(rows, slot, taken, strict=True):
        for term in allowed[node]:
            if x[row, term] > 0:
                counts = expected.setdefault((node * 300 + term) * width + int(np.searchsorted(cuts[term], x[row, term])), np.zeros(2))
                counts[y[row]] += times
    key, classes = entries.counted(entries.bin, 300)
    assert key.tolist() == sorted(expected) and all((expected[k] == c).all() for k, c in zip(key.tolist(), classes, strict=True))
