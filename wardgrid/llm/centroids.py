"""Centroid clustering in whole numbers; the nearest centroid is found by Orchard search.

Each centroid has a list of the others, nearest first. A vector starts at a centroid and walks its list; when it
meets a closer centroid (or one as close with a smaller number), it goes on with that one's list, from its front. Centroids met are
marked and not compared again. It stops where the list's centroid lies strictly beyond twice the vector's present distance: all
further ones are then farther from the vector than the present one. All vectors of a slice walk at once.

A vector is kept if it has exactly ``dimensions`` components, none null or not finite; component x becomes floor(``SCALE`` * x).
Per round each task adds up its vectors per centroid, so ``k`` x ``dimensions`` sums travel, never vectors. What the driver holds are the ``k`` centroids.

Defined cases: vectors not kept are in no result; a null id counts as an empty one in the draw of first centroids and stays null;
repeated rows are vectors of their own; of equally near centroids the smaller number wins; a centroid without vectors stays;
fewer vectors than ``k`` give as many centroids; an empty table gives no rows; other columns are ignored. Whole components beyond
``LIMIT`` either way count as ``LIMIT``, so that all distances fit a long; an inertia that doesn't is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .repeats import staged

CENTROIDS, ROUNDS, DIMENSIONS, SCALE, SEED = 16, 3, 64, 64, 1
#: Squared distances of 64 such components, times four, fit a long.
LIMIT = 1 << 26
#: Vectors that walk at once.
SLICE = 4096
#: First draws are cut per group of tasks before the last cut.
_GROUPS = 64


class Centroids:
    """Their components and, per centroid, the others by distance (ties by number)."""

    def __init__(self, values: np.ndarray):
        self.values, k = values, len(values)
        apart = np.stack([((values - v) ** 2).sum(axis=1) for v in values]) if k else np.empty((0, 0), np.int64)
        self.order = np.stack([[j for j in np.argsort(apart[i], kind="stable") if j != i] for i in range(k)]).astype(int) if k > 1 else np.empty((k, 0), int)
        self.apart = np.take_along_axis(apart, self.order, axis=1)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of, and squared distance to, the nearest centroid of each point."""
        n, listed = len(points), self.order.shape[1]
        current, at = np.zeros(n, int), np.zeros(n, int)
        best = ((points - self.values[0]) ** 2).sum(axis=1)
        met = np.zeros((n, len(self.values)), bool)
        met[:, 0] = True
        walking = np.arange(n)
        while len(walking):
            walking = walking[at[walking] < listed]
            here, step = current[walking], at[walking]
            inside = self.apart[here, step] <= 4 * best[walking]
            walking, here, step = walking[inside], here[inside], step[inside]
            other = self.order[here, step]
            at[walking] += 1
            new = ~met[walking, other]
            moved, other = walking[new], other[new]
            met[moved, other] = True
            distance = ((points[moved] - self.values[other]) ** 2).sum(axis=1)
            closer = (distance < best[moved]) | ((distance == best[moved]) & (other < current[moved]))
            moved = moved[closer]
            current[moved], best[moved], at[moved] = other[closer], distance[closer], 0
        return current, best


def whole(vectors: pa.Array, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors are kept, and their components as whole numbers."""
    right = pc.fill_null(pc.equal(pc.list_value_length(vectors), dimensions), False)
    kept = right.to_numpy(zero_copy_only=False).copy()
    values = vectors.filter(right).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dimensions)
    finite = np.isfinite(values).all(axis=1)
    kept[np.flatnonzero(kept)[~finite]] = False
    return kept, np.clip(np.floor(values[finite] * SCALE), -LIMIT, LIMIT).astype(np.int64)


def _slices(batch: pa.RecordBatch, dimensions: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for low in range(0, batch.num_rows, SLICE):
        part = batch.slice(low, SLICE)
        kept, points = whole(part["vector"], dimensions)
        if len(points):
            yield part["id"].filter(pa.array(kept)), points


def _first(vectors: DataFrame, k: int, dimensions: int, seed: int) -> np.ndarray:
    """Vectors whose hash of seed and id is least; of equal hashes the lesser vector. At most ``k`` rows leave a task or a group."""
    fit = vectors.where(F.size("vector") == dimensions).where("forall(vector, x -> abs(x) < double('infinity'))")
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    drawn = fit.select(F.sha2(text, 256).alias("draw"), "vector", (F.spark_partition_id() % _GROUPS).alias("part"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy("draw", "vector"))
    rows = drawn.withColumn("rank", rank).where(F.col("rank") <= k).orderBy("draw", "vector").limit(k).collect()
    values = np.array([r["vector"] for r in rows], np.float64).reshape(-1, dimensions)
    return np.clip(np.floor(values * SCALE), -LIMIT, LIMIT).astype(np.int64)


def _sums(centroids: Centroids, dimensions: int) -> Callable:
    """Per task: number and componentwise sum of the vectors nearest to each centroid (dimension -1: the number)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids.values)
        total = np.zeros((k, dimensions + 1), np.int64)
        for batch in batches:
            for _, points in _slices(batch, dimensions):
                nearest, _ = centroids.nearest(points)
                np.add.at(total[:, 1:], nearest, points)
                total[:, 0] += np.bincount(nearest, minlength=k)
        met = np.flatnonzero(total[:, 0])
        number = np.repeat(met, dimensions + 1).astype("i4")
        which = np.tile(np.arange(-1, dimensions), len(met)).astype("i4")
        yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(which), pa.array(total[met].ravel())], names=["cluster", "dimension", "total"])

    return add


def _assign(centroids: Centroids, dimensions: int) -> Callable:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, points in _slices(batch, dimensions):
                nearest, distance = centroids.nearest(points)
                yield pa.RecordBatch.from_arrays([ids, pa.array(nearest.astype("i4")), pa.array(distance)], names=["id", "cluster", "distance"])

    return assign


def _moved(vectors: DataFrame, values: np.ndarray) -> np.ndarray:
    """Centroids after one round: exact floor of sum over number, the old one where there is no vector."""
    dimensions = values.shape[1]
    partial = vectors.mapInArrow(_sums(Centroids(values), dimensions), "cluster int, dimension int, total long")
    exact = F.sum(F.col("total").cast("decimal(20,0)")).alias("total")
    found = {(r["cluster"], r["dimension"]): int(r["total"]) for r in partial.groupBy("cluster", "dimension").agg(exact).collect()}
    moved = values.copy()
    for i in range(len(values)):
        if n := found.get((i, -1)):
            moved[i] = [found[i, d] // n for d in range(dimensions)]
    return moved


def cluster(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(assigned, centroids): id, cluster, distance (squared) per kept vector; cluster, components, n, cluster_inertia, inertia per
    centroid, at most ``k`` rows."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector"))
    values = _first(rows, k, dimensions, seed)
    for _ in range(rounds if len(values) else 0):
        values = _moved(rows, values)
    schema = "id long, cluster int, distance long"
    if not len(values):
        return spark.createDataFrame([], schema), spark.createDataFrame([], _CENTROID)
    assigned = staged(rows.mapInArrow(_assign(Centroids(values), dimensions), schema), "clusters")
    sums = assigned.groupBy("cluster").agg(F.count("*").alias("n"), F.try_sum("distance").alias("inertia")).collect()  # k rows at most
    found = {r["cluster"]: (r["n"], r["inertia"]) for r in sums}
    parts = [r["inertia"] for r in sums]
    total = None if None in parts or sum(parts) >= 1 << 63 else sum(parts)
    table = [(i, [int(x) for x in v], *found.get(i, (0, 0)), total) for i, v in enumerate(values)]
    return assigned, spark.createDataFrame(table, _CENTROID)


_CENTROID = "cluster int, components array<long>, n long, cluster_inertia long, inertia long"


def digest(components: str) -> Column:
    """Hash of a centroid's components as decimal numbers joined by commas."""
    return F.sha2(F.array_join(F.transform(components, lambda x: x.cast("string")), ","), 256)
