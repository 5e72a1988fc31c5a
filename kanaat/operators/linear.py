"""Linear classifiers with a ridge penalty, many at once: logistic regressions and support vector machines (hinge
loss), for any number of settings and folds in the same jobs.

All models descend side by side (L-BFGS); one job gives loss and slope of every model that still descends, at its own
point. Rows lie in blocks of sparse weights, a task adds up what its blocks give and only sums for each model leave it.
What is minimised is the mean loss over the rows a model sees plus half the penalty times the squared weights; the
intercept is free. Terms are measured in their standard deviations on the way, so that rare ones don't slow the
descent; a term with the same weight in all rows gets none.
"""

from __future__ import annotations

from collections.abc import Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kanaat.operators.forests import dense

BLOCK_ROWS = 4096
# Steps remembered by the descent, and over how many of them the loss must have all but stopped falling.
MEMORY, WATCHED = 10, 5
Batches = Iterator[pa.RecordBatch]


@dataclass(frozen=True)
class Fit:
    """What is fitted. ``unseen``: the fold the model leaves out, None for none."""

    loss: str
    penalty: float
    steps: int = 100
    unseen: int | None = None
    tolerance: float = 1e-6


@dataclass
class Line:
    """A fitted model; its score is the margin."""

    weights: np.ndarray
    intercept: float

    def score(self, x: np.ndarray, *_) -> np.ndarray:
        return x @ self.weights + self.intercept


def _packed(label: np.ndarray, fold: np.ndarray, x: np.ndarray) -> bytes:
    row, term = np.nonzero(x)
    return b"".join([np.array([len(label), len(row)], "<i8").tobytes(), label.astype("<f8").tobytes(), x[row, term].astype("<f8").tobytes(),
                     fold.astype("<i4").tobytes(), row.astype("<i4").tobytes(), term.astype("<i4").tobytes()])


def _opened(raw: bytes, terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, many = np.frombuffer(raw, "<i8", 2).tolist()
    label, weights = np.frombuffer(raw, "<f8", n, 16), np.frombuffer(raw, "<f8", many, 16 + 8 * n)
    whole = np.frombuffer(raw, "<i4", n + 2 * many, 16 + 8 * (n + many))
    x = np.zeros((n, terms))
    x[whole[n:n + many], whole[n + many:]] = weights
    return label, whole[:n], x


def losses(label: np.ndarray, fold: np.ndarray, x: np.ndarray, points: np.ndarray, hinge: np.ndarray, unseen: np.ndarray) -> np.ndarray:
    """(terms + 2, models): summed slope by term, by intercept, and summed loss at each model's point (terms + 1, models)."""
    sign = 2.0 * label[:, None] - 1.0
    away = sign * (x @ points[:-1] + points[-1])
    loss = np.where(hinge, np.maximum(0.0, 1.0 - away), np.logaddexp(0.0, -away))
    slope = -sign * np.where(hinge, (away < 1.0).astype(float), np.exp(-np.logaddexp(0.0, away)))
    seen = fold[:, None] != unseen
    slope *= seen
    return np.concatenate([x.T @ slope, slope.sum(axis=0)[None], (loss * seen).sum(axis=0)[None]])


def descent(start: np.ndarray, steps: int, tolerance: float) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """L-BFGS: yields points, is sent loss and slope there, returns the least point. Step lengths are bisected between
    one that does not descend enough and one that is still too steep, which also holds where a loss has corners."""
    x = start
    loss, slope = yield x
    moves, turns, seen = [], [], [loss]
    for _ in range(steps):
        if np.linalg.norm(slope) <= tolerance * max(1.0, abs(loss)):
            break
        way, kept = -slope, []
        for s, y in zip(reversed(moves), reversed(turns), strict=True):
            a = s @ way / (s @ y)
            kept.append(a)
            way = way - a * y
        way = way * (moves[-1] @ turns[-1] / (turns[-1] @ turns[-1]) if moves else 1.0 / max(1.0, np.linalg.norm(slope)))
        for s, y, a in zip(moves, turns, reversed(kept), strict=True):
            way = way + s * (a - y @ way / (s @ y))
        steep = slope @ way
        if steep >= 0:
            break
        low, high, length = 0.0, np.inf, 1.0
        for _ in range(25):
            there = x + length * way
            loss_there, slope_there = yield there
            if not loss_there <= loss + 1e-4 * length * steep:
                high = length
            elif slope_there @ way < 0.9 * steep:
                low = length
            else:
                break
            length = (low + high) / 2 if np.isfinite(high) else 2 * length
        if not loss_there < loss:
            break
        move, turn = there - x, slope_there - slope
        if move @ turn > 1e-12 * (turn @ turn):
            moves, turns = [*moves, move][-MEMORY:], [*turns, turn][-MEMORY:]
        x, loss, slope = there, loss_there, slope_there
        seen.append(loss)
        if len(seen) > WATCHED and seen[-1 - WATCHED] - loss <= tolerance * abs(loss):
            break
    return x


def fit(train: DataFrame, fits: list[Fit], terms: int, rows: int) -> list[Line]:
    """The models of (id, label 0/1, features, fold int if any leaves one out), in the order given."""
    context = train.sparkSession.sparkContext
    pieces = max(1, min(rows // BLOCK_ROWS, 2 * context.defaultParallelism))
    fold = F.col("fold") if "fold" in train.columns else F.lit(-1)

    def pack(batches: Batches) -> Batches:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                own = batch.slice(at, BLOCK_ROWS)
                raw = _packed(own.column(0).to_numpy(), own.column(1).to_numpy(), dense(own.column(2), terms))
                yield pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], ["block"])

    # Rows go to pieces by their id and in its order, so sums come out the same in every run.
    held = train.repartition(pieces, "id").sortWithinPartitions("id").select(
        F.col("label").cast("double").alias("label"), fold.cast("int").alias("fold"), F.unwrap_udt("features").alias("v")).mapInArrow(pack, "block binary").rdd.map(lambda r: bytes(r.block)).persist(StorageLevel.MEMORY_AND_DISK)

    def summed(of) -> np.ndarray:
        def run(blocks: Iterator[bytes]) -> Iterator[bytes]:
            total = None
            for raw in blocks:
                one = of(*_opened(raw, terms))
                total = one if total is None else total + one
            if total is not None:
                yield total.tobytes()

        return sum(np.frombuffer(raw, float) for raw in held.mapPartitions(run).collect())  # one for each piece

    unseen = np.array([-2 if f.unseen is None else f.unseen for f in fits])
    hinge = np.array([f.loss == "hinge" for f in fits])
    try:
        sums = summed(lambda label, fold, x: np.concatenate([[len(label)], x.sum(axis=0), (x * x).sum(axis=0), (fold[:, None] != unseen).sum(axis=0)]).astype(float))
        mean, square, many = sums[1:terms + 1] / sums[0], sums[terms + 1:2 * terms + 1] / sums[0], np.maximum(sums[2 * terms + 1:], 1.0)
        spread = square - mean * mean
        scale = np.where(spread > 1e-12 * square, 1.0 / np.sqrt(np.maximum(spread, 1e-300)), 0.0)
        runs = [descent(np.zeros(terms + 1), f.steps, f.tolerance) for f in fits]
        at = {m: next(run) for m, run in enumerate(runs)}
        found: dict[int, np.ndarray] = {}
        while at:
            open_ = sorted(at)
            points = np.stack([np.append(at[m][:-1] * scale, at[m][-1]) for m in open_], axis=1)
            sent = context.broadcast((points, hinge[open_], unseen[open_]))
            sums = summed(lambda label, fold, x: losses(label, fold, x, *sent.value)).reshape(terms + 2, -1)
            sent.destroy()
            for k, m in enumerate(open_):
                weights, penalty = points[:-1, k], fits[m].penalty
                slope = np.append((sums[:-2, k] / many[m] + penalty * weights) * scale, sums[-2, k] / many[m])
                try:
                    at[m] = runs[m].send((sums[-1, k] / many[m] + 0.5 * penalty * (weights @ weights), slope))
                except StopIteration as done:
                    found[m] = done.value
                    del at[m]
    finally:
        held.unpersist()
    return [Line(found[m][:-1] * scale, float(found[m][-1])) for m in range(len(fits))]
