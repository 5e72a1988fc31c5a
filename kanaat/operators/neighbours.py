"""Exact k-nearest-neighbour join, Euclidean, ties by id.

A small base (its row count is checked) travels to the tasks. With a larger one, queries are dealt to parts of
bounded size and the base is streamed past each part of its group, in blocks of near rows: the k nearest so far of
each query stay, and their distance rules out rows of a block, or a whole block by its centre and radius. A task holds
one part and one block. Every row of the base is moved once for each part, and the parts are as many as the cores need
until they reach their largest size; only the measuring itself grows with the product of both sides."""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kanaat.functions.fixed_values import NEIGHBOURS, SEED
from kanaat.functions.keys import shuffle_key
from kanaat.session import durable, fits, small_side

BROADCAST_ROWS = 4096
CHUNK_ROWS = 4096
LEAST_PIVOTS = 128
# A part's queries: parts for each core, and the most bytes of their vectors.
PARTS_PER_CORE, LEAST_PART_ROWS, PART_BYTES = 3, 512, 32 << 20
# Rows of a part measured at once, and bytes of the vectors of pairs that are measured exactly at once.
TILE_ROWS, EXACT_BYTES = 512, 4 << 20


def matrix_of(vectors) -> np.ndarray:
    return np.vstack([np.asarray(v, dtype=np.float64) for v in vectors])


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.maximum(d, 0.0)


class Nearest:
    """The k nearest base rows of each query, of the rows added so far. The matrix product finds candidates up to
    rounding, which are then measured exactly."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int, skip_self: bool):
        self.ids, self.queries, self.k, self.skip_self = ids, queries, k, skip_self
        self.norms = (queries * queries).sum(1)
        # With a column more the matrix product gives the distance less the query's own norm at once.
        self.wide = np.column_stack([-2.0 * queries, np.ones(len(queries))])
        self.room = np.zeros(0)
        self.distance = np.full((len(ids), k), np.inf)
        self.found = None

    def add(self, ids: np.ndarray, base: np.ndarray) -> None:
        if not len(ids):
            return
        if self.found is None:
            self.found = np.full((len(self.ids), self.k), ids[0], dtype=ids.dtype)
        norms = (base * base).sum(1)
        centre = base.mean(0)
        radius = math.sqrt(((base - centre) ** 2).sum(1).max())
        highest, wide = np.fmax.reduce(norms), np.column_stack([base, norms]).T
        # Never more than the true distance: what rounding can add to its square is taken off.
        squares = self.norms + centre @ centre
        away = np.sqrt(np.maximum(squares + self.wide[:, :-1] @ centre - 1e-9 * (1.0 + squares), 0.0))
        for start in range(0, len(self.ids), TILE_ROWS):
            rows = np.arange(start, min(start + TILE_ROWS, len(self.ids)))
            worst = self.distance[rows[0] : rows[-1] + 1, -1]
            open_rows = ~(away[rows[0] : rows[-1] + 1] - radius > np.sqrt(worst) * (1 + 1e-9) + 1e-9)
            if open_rows.all():
                self._tile(rows, self.wide[rows[0] : rows[-1] + 1], ids, base, wide, highest)
            elif open_rows.any():
                rows = rows[open_rows]
                self._tile(rows, self.wide[rows], ids, base, wide, highest)

    def _tile(self, rows, queries, ids, base, wide, highest) -> None:
        if len(self.room) < len(rows) * len(ids):
            self.room = np.empty(len(rows) * len(ids))
        rough = np.matmul(queries, wide, out=self.room[: len(rows) * len(ids)].reshape(len(rows), len(ids)))
        scale = 1e-9 * (1.0 + self.norms[rows] + highest)
        limit = self.distance[rows, -1] - self.norms[rows] + scale
        new, wanted = np.isinf(limit), self.k + self.skip_self
        if new.any() and len(ids) > wanted:
            limit[new] = np.partition(rough[new], wanted - 1, axis=1)[:, wanted - 1] + scale[new]
        row, column = np.divmod(np.flatnonzero(rough <= limit[:, None]), len(ids))
        if self.skip_self:
            others = ids[column] != self.ids[rows[row]]
            row, column = row[others], column[others]
        if not len(row):
            return
        step = max(1, EXACT_BYTES // (8 * base.shape[1]))
        exact = np.concatenate([
            ((self.queries[rows[row[s : s + step]]] - base[column[s : s + step]]) ** 2).sum(1) for s in range(0, len(row), step)
        ])
        self._keep(rows[row], exact, ids[column])

    def _keep(self, rows, distance, ids) -> None:
        better = distance <= self.distance[rows, -1]
        rows, distance, ids = rows[better], distance[better], ids[better]
        touched = np.unique(rows)
        row = np.concatenate([rows, np.repeat(touched, self.k)])
        distance = np.concatenate([distance, self.distance[touched].ravel()])
        ids = np.concatenate([ids, self.found[touched].ravel()])
        place = np.unique(ids, return_inverse=True)[1]
        order = np.lexsort((place, distance, row))
        first = np.searchsorted(row[order], touched)
        best = order[first[:, None] + np.arange(self.k)[None, :]]
        self.distance[touched], self.found[touched] = distance[best], ids[best]

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Number of the query, id of the neighbour, squared distance and rank from 1."""
        row, rank = np.nonzero(np.isfinite(self.distance))
        found = self.found[row, rank] if self.found is not None else np.zeros(0, np.int64)
        return row, found, self.distance[row, rank], rank + 1


def nearest(query_ids, queries, base_ids, base, k, skip_self, chunk_rows: int = CHUNK_ROWS) -> pd.DataFrame:
    """The k nearest base rows of each query."""
    query_ids = np.asarray(query_ids)
    best = Nearest(query_ids, queries, k, skip_self)
    for start in range(0, len(base_ids), chunk_rows):
        best.add(base_ids[start : start + chunk_rows], base[start : start + chunk_rows])
    row, found, distance, _ = best.result()
    return pd.DataFrame({"query_id": query_ids[row], "neighbour_id": found, "distance2": distance})


def _against(held: dict, k: int, skip_self: bool, frames):
    for pdf in frames:
        for group, part in pdf.groupby("grp"):
            if group in held:
                ids, matrix = held[group]
                yield nearest(part["id"].to_numpy(), matrix_of(part["vector"]), ids, matrix, k, skip_self)


def knn_join(
    queries: DataFrame,
    base: DataFrame,
    k: int = NEIGHBOURS,
    skip_self: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
    chunk_rows: int = CHUNK_ROWS,
    pivots: int | None = None,
) -> DataFrame:
    """Both sides: (id, grp, vector array<double>), ids of any type; neighbours share the ``grp`` value. Gives
    (query_id, neighbour_id, distance2, rank). Query ids are unique."""
    queries, base = queries.select("id", "grp", "vector"), base.select("id", "grp", "vector")
    if fits(base, broadcast_rows):
        held = {g: (p["id"].to_numpy(), matrix_of(p["vector"])) for g, p in base.toPandas().groupby("grp")}
        found = queries.mapInPandas(partial(_against, held, k, skip_self), _found(queries, base))
        return found.withColumn(
            "rank", F.row_number().over(Window.partitionBy("query_id").orderBy("distance2", "neighbour_id"))
        )
    return _by_blocks(queries, base, k, skip_self, chunk_rows, pivots)


def _assign(centres: np.ndarray, frames):
    for pdf in frames:
        for start in range(0, len(pdf), 1024):
            part = pdf.iloc[start : start + 1024]
            away = np.sqrt(_squared(matrix_of(part["vector"]), centres))
            cell = away.argmin(1)
            yield part.assign(cell=cell.astype("int32"), away=away[np.arange(len(cell)), cell])


def _matrix(column: pa.Array) -> np.ndarray:
    sizes = np.unique(np.diff(column.offsets.to_numpy()))
    values = column.flatten()
    if column.null_count or values.null_count or len(sizes) != 1:
        raise ValueError("vectors of different lengths or with missing parts")
    return values.to_numpy().reshape(len(column), -1)


def _numpy(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def _runs(batch: pa.RecordBatch) -> list[tuple[int, int]]:
    """Rows of one part, kind and cell that follow each other."""
    changes = np.zeros(max(0, batch.num_rows - 1), bool)
    for name in ("grp", "part", "kind", "cell"):
        values = _numpy(batch.column(name))
        changes |= values[1:] != values[:-1]
    cuts = [0, *(np.flatnonzero(changes) + 1).tolist(), batch.num_rows]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]


def _streamed(k: int, skip_self: bool, chunk_rows: int, batches):
    """Of each part first the queries, then the base rows of its group, cell by cell."""
    key, ids, vectors, best, kinds = None, [], [], None, None

    def made():
        if best is not None:
            row, found, distance, rank = best.result()
            for s in range(0, len(row), 10_000):
                e = s + 10_000
                yield pa.RecordBatch.from_arrays(
                    [pa.array(best.ids[row[s:e]], kinds[0]), pa.array(found[s:e], kinds[1]), pa.array(distance[s:e]),
                     pa.array(rank[s:e].astype("int32"))], ["query_id", "neighbour_id", "distance2", "rank"])

    for batch in batches:
        kinds = [batch.schema.field(name).type for name in ("query_id", "neighbour_id")]
        for start, end in _runs(batch):
            run = batch.slice(start, end - start)
            here = run.column("grp")[0].as_py(), run.column("part")[0].as_py()
            if here != key:
                yield from made()
                key, ids, vectors, best = here, [], [], None
            if run.column("kind")[0].as_py() == 0:
                ids.append(_numpy(run.column("query_id")))
                vectors.append(_matrix(run.column("vector")))
                continue
            if best is None:
                best, ids, vectors = Nearest(np.concatenate(ids), np.concatenate(vectors), k, skip_self), [], []
            for s in range(0, run.num_rows, chunk_rows):
                block = run.slice(s, chunk_rows)
                best.add(_numpy(block.column("neighbour_id")), _matrix(block.column("vector")))
    yield from made()


def _found(queries: DataFrame, base: DataFrame) -> str:
    kinds = [df.schema["id"].dataType.simpleString() for df in (queries, base)]
    return f"query_id {kinds[0]}, neighbour_id {kinds[1]}, distance2 double"


def _by_blocks(queries, base, k, skip_self, chunk_rows, pivots) -> DataFrame:
    spark = queries.sparkSession
    # Copies of a vector are equally far from any query, so those of the smallest ids are all that can be found.
    copies = Window.partitionBy("grp", F.xxhash64("vector"), "vector").orderBy("id")
    base = durable(base.withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") <= k + skip_self).drop("_copy"))
    if pivots is None:  # so many that a cell's rows grow as the root of the base
        pivots = max(LEAST_PIVOTS, math.isqrt(base.count()))
    keyed = base.withColumn("_key", shuffle_key(F.col("id"), SEED))
    centres = matrix_of([r.vector for r in keyed.orderBy("_key", "id").limit(pivots).select("vector").collect()])
    typed = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in base.schema.fields)
    placed = durable(base.mapInPandas(partial(_assign, centres), f"{typed}, cell int, away double"))
    cores = spark.sparkContext.defaultParallelism
    rows = max(LEAST_PART_ROWS, -(-queries.count() // (PARTS_PER_CORE * cores)))
    rows = max(1, min(rows, PART_BYTES // (8 * centres.shape[1])))
    plan = small_side(queries.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("parts")))
    query_id, base_id = (df.schema["id"].dataType for df in (queries, base))
    query_side = queries.join(plan, "grp").select(
        "grp", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), F.lit(0).alias("kind"), F.lit(0).alias("cell"),
        F.lit(0.0).alias("away"), F.col("id").alias("query_id"), F.lit(None).cast(base_id).alias("neighbour_id"), "vector",
    )
    base_side = placed.join(plan, "grp").select(
        "grp", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(1).alias("kind"), "cell",
        "away", F.lit(None).cast(query_id).alias("query_id"), F.col("id").alias("neighbour_id"), "vector",
    )
    dealt = query_side.unionByName(base_side).repartitionByRange(PARTS_PER_CORE * cores, "grp", "part")
    return dealt.sortWithinPartitions("grp", "part", "kind", "cell", "away").mapInArrow(
        partial(_streamed, k, skip_self, chunk_rows), f"{_found(queries, base)}, rank int"
    )


def knn_classify(queries: DataFrame, base: DataFrame, k: int = NEIGHBOURS, skip_self: bool = False) -> DataFrame:
    """Share of label 1 among the k nearest base rows (base carries ``label``)."""
    found = knn_join(queries, base, k, skip_self)
    labels = base.select(F.col("id").alias("neighbour_id"), "label")
    # A point may be neighbour to very many others, so the labels are sent around if they are few.
    return found.join(small_side(labels), "neighbour_id").groupBy("query_id").agg(
        F.avg(F.col("label").cast("double")).alias("p1")
    )
