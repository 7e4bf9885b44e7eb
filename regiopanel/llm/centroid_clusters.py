"""Centroid clustering with a vantage-point tree over the centroids.

Vectors become whole numbers, so every distance and mean is exact.  In each round the driver builds a
vantage-point tree over the centroids (a number fixed by a parameter) and broadcasts it.  Each
vector walks the tree best first: of the nodes waiting, it takes the one that may hold the nearest
centroid, and stops when no waiting node can hold one as near as the best so far.  A node is visited
also where its bound equals the best distance, as a centroid of a smaller number may lie there.
Bounds are floating point with a margin; distances that decide are whole numbers.

Tasks add up their vectors by centroid, so a round sends one row per centroid, component and task.

Defined results: a vector that is null, has another number of components, or a null or non-finite one
is left out; equal vectors are rows of their own; with fewer vectors than centroids each is a centroid;
a null id can start no centroid unless ids run out; rows with equal ids start centroids in the order of
their vectors; an empty table gives an empty result.  A component beyond ``LARGEST`` raises an error, as
distances would not fit 64 bits.  Only id and vector are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiopanel.session import stored

CENTROIDS, COMPONENTS, ROUNDS, SCALE = 8, 64, 10, 1024
# Squares of differences of such components, summed over 64 of them, fit 64 bits.
LARGEST = 1 << 27
LEAF = 2
# Bounds waiting at once, of all vectors that are walked together.
WAITING = 1 << 21
# Relative margin by which bounds are widened; far above the error of a square root in doubles.
MARGIN = 1e-9


@dataclass(frozen=True)
class Node:
    """Centroids to compare (one vantage point, or a leaf's), and children as (node, nearest, farthest)."""

    centroids: tuple[int, ...]
    children: tuple[tuple[int, float, float], ...] = ()


def squared(vectors: np.ndarray, point: np.ndarray) -> np.ndarray:
    gap = vectors - point
    return np.einsum("ij,ij->i", gap, gap)


class VantagePointTree:
    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.points = np.asarray(points, np.int64)
        self.nodes: list[Node] = []
        self._grow(list(range(len(points))), leaf)

    def _grow(self, numbers: list[int], leaf: int) -> int:
        at = len(self.nodes)
        self.nodes.append(Node(tuple(numbers)))
        if len(numbers) > leaf:
            vantage, rest = numbers[0], np.array(numbers[1:])
            far = np.sqrt(squared(self.points[rest], self.points[vantage]).astype(float))
            order = np.argsort(far, kind="stable")
            children = []
            for part in np.array_split(order, 2):
                if len(part):
                    child = self._grow(sorted(rest[part].tolist()), leaf)
                    children.append((child, float(far[part[0]]), float(far[part[-1]])))
            self.nodes[at] = Node((vantage,), tuple(children))
        return at

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid (of equal ones the smallest) and squared distance, per vector."""
        step = max(1, WAITING // len(self.nodes))
        parts = [self._walk(vectors[i : i + step]) for i in range(0, len(vectors), step)]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(map(np.concatenate, zip(*parts)))

    def _walk(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best = np.full(len(vectors), np.iinfo(np.int64).max)
        who = np.full(len(vectors), len(self.points))
        waiting = np.full((len(vectors), len(self.nodes)), np.inf)
        waiting[:, 0] = 0
        rows = np.arange(len(vectors))
        while True:
            ahead = waiting[rows]
            first = ahead.argmin(axis=1)
            bound = ahead[np.arange(len(rows)), first]
            # Inclusive: a node whose bound equals the best distance may hold a tie.
            open_ = bound <= np.sqrt(best[rows].astype(float)) * (1 + MARGIN)
            rows, first, bound = rows[open_], first[open_], bound[open_]
            if not len(rows):
                return who, best
            waiting[rows, first] = np.inf
            for number in np.unique(first):
                here = first == number
                self._visit(self.nodes[number], vectors, rows[here], bound[here], best, who, waiting)

    def _visit(self, node: Node, vectors, rows, bound, best, who, waiting) -> None:
        mine = vectors[rows]
        for centroid in node.centroids:
            distance = squared(mine, self.points[centroid])
            better = (distance < best[rows]) | ((distance == best[rows]) & (centroid < who[rows]))
            best[rows[better]] = distance[better]
            who[rows[better]] = centroid
        if node.children:
            away = np.sqrt(distance.astype(float))
            for child, near, far in node.children:
                low = np.maximum(near - away, away - far) - MARGIN * (away + far)
                waiting[rows, child] = np.maximum(bound, low)


def whole_vectors(table: DataFrame, id_col: str, vector_col: str, components: int, scale: int) -> DataFrame:
    """(vec_id, vector) of the vectors that are complete, as whole numbers."""
    plain = table.select(table[f"`{id_col}`"].alias("vec_id"), table[f"`{vector_col}`"].alias("raw"))

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != math.inf)

    # A null size or element must leave the row out, not leave the condition open.
    complete = F.coalesce((F.size("raw") == components) & F.forall("raw", finite), F.lit(False))
    return plain.filter(complete).select(
        "vec_id", F.transform("raw", lambda x: F.floor(x.cast("double") * float(scale)).cast("bigint")).alias("vector")
    )


def _matrix(column: pa.ListArray, components: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) and max(-int(flat.min()), int(flat.max())) > LARGEST:
        raise OverflowError(f"a component is beyond {LARGEST}; distances would not fit 64 bits")
    return flat.reshape(-1, components)


def first_centroids(vectors: DataFrame, centroids: int, prefix: str) -> np.ndarray:
    """The vectors whose ids have the smallest digests; at most ``centroids`` rows reach the driver."""
    digest = F.sha2(F.concat(F.lit(prefix), F.col("vec_id").cast("string")), 256)
    chosen = vectors.orderBy(digest.asc_nulls_last(), "vector").limit(centroids).collect()
    return np.array([r.vector for r in chosen], np.int64)


def _moved(vectors: DataFrame, points: np.ndarray) -> np.ndarray:
    """One round: exact means of the vectors nearest to each centroid; empty ones stay."""
    components = points.shape[1]
    tree = vectors.sparkSession.sparkContext.broadcast(VantagePointTree(points))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A row for each centroid: its vectors' sums, then their number.
        total = np.zeros((len(tree.value.points), components + 1), np.int64)
        for batch in batches:
            mine = _matrix(batch.column("vector"), components)
            who, _ = tree.value.nearest(mine)
            for centroid in np.unique(who):
                members = mine[who == centroid]
                total[centroid] += np.append(members.sum(axis=0), len(members))
        centroid, place = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(centroid), pa.array(place), pa.array(total[centroid, place])], ["cluster", "place", "total"]
        )

    partial = vectors.select("vector").mapInArrow(sums, "cluster long, place long, total long")
    rows = partial.groupBy("cluster", "place").agg(F.sum("total").alias("total")).collect()
    tree.unpersist()
    total = [[0] * (components + 1) for _ in points]
    for r in rows:
        total[r.cluster][r.place] = r.total
    means = [[s // t[-1] for s in t[:-1]] if t[-1] else old.tolist() for t, old in zip(total, points)]
    return np.array(means, np.int64)


def _assigned(vectors: DataFrame, points: np.ndarray) -> DataFrame:
    tree = vectors.sparkSession.sparkContext.broadcast(VantagePointTree(points))
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            who, distance = tree.value.nearest(_matrix(batch.column("vector"), points.shape[1]))
            found = [batch.column("vec_id"), pa.array(who, pa.int32()), pa.array(distance, pa.int64())]
            yield pa.RecordBatch.from_arrays(found, ["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long")


def digest_of(point: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, point.tolist())).encode()).hexdigest()


def _by_cluster(spark: SparkSession, points: np.ndarray, sums: dict[int, int]) -> DataFrame:
    """A row for each centroid: as many as the parameter says."""
    inertia = sum(sums.values())
    rows = [(i, sums.get(i, 0), inertia, digest_of(p)) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")


def cluster(
    table: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    centroids: int = CENTROIDS,
    components: int = COMPONENTS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    prefix: str = "3:",
) -> DataFrame:
    """One row per vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark = table.sparkSession
    vectors = stored(whole_vectors(table, id_col, vector_col, components, scale), "vectors")
    points = first_centroids(vectors, centroids, prefix).reshape(-1, components)
    if len(points):
        for _ in range(rounds):
            points = _moved(vectors, points)
        found = stored(_assigned(vectors, points), "assigned")
    else:
        found = vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
    sums = {r.cluster: r.total for r in found.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    return found.join(F.broadcast(_by_cluster(spark, points, sums)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
