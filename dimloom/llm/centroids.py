"""Centroid clustering with a vantage-point tree over the centroids.

Vectors are whole numbers, floor(scale * x) of their components.  The first centroids are the ``k``
vectors with the smallest SHA-256 of ``seed:<vec_id>``.  In every round the driver builds a
vantage-point tree over the centroids and broadcasts it; tasks look up the nearest centroid of each
vector and send, per centroid, the number of its vectors and their sum for each component, which
Spark adds up; the driver gets k sums and takes their exact floors.  A centroid without vectors
stays.  After the last round the vectors are assigned once more.

A tree node has a vantage centroid and, of the others, the nearer and the farther half, each with
the smallest and largest distance from the vantage; ``LEAF`` centroids or fewer are a leaf.  The
search is best first and bounded: each vector opens, of the nodes not yet opened, the one with its
least possible distance, until that exceeds its best distance so far.  All vectors of a batch take
their steps together.  Distances are compared as whole numbers; bounds, which need roots, are
rounded outwards and prune only what lies strictly beyond the best distance, so that an equally
near centroid with a smaller number is always found.

Bounds: the driver and each task hold k * dims numbers and the tree; sums of a task are k * dims rows.

Nulls and edge cases: vectors that are null, do not have ``dims`` components, or have a null or
non-finite one are not kept and have no row; neither have vectors with a component beyond 2^58 after
scaling, which the arithmetic of sums does not hold.  A squared distance beyond 64 bits is null, and
so is an inertia that includes it or exceeds 64 bits.  A null vec_id comes last in the choice of
the first centroids, equal ids in the order of their vectors; repeated rows are vectors like any
others; fewer than k vectors give as many centroids; an empty table an empty result.  Other columns
are ignored.  Cluster ties go to the smaller number.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

LEAF = 6
#: Vectors times tree nodes of one run of vector operations.
CELLS = 1 << 20
#: Components up to which 64 squared differences stay below 2^63; beyond, Python's numbers take over.
PLAIN = 1 << 27
LARGEST = 1 << 58
#: Relative rounding of roots and differences of roots, with a margin.
SLACK = 1e-12


class Node(NamedTuple):
    """A leaf has ``members``; another node a ``vantage`` and (child, nearest, farthest) for each child."""

    members: tuple[int, ...] = ()
    vantage: int = -1
    children: tuple[tuple[int, float, float], ...] = ()


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances between the rows of ``a`` and of ``b``: whole numbers, a row for each of ``a``."""
    out = np.empty((len(a), len(b)), a.dtype)
    for i, row in enumerate(b):
        step = a - row
        out[:, i] = (step * step).sum(axis=1)
    return out


def _comparable(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as 64-bit numbers where that is exact, else as Python's."""
    plain = all(a.size == 0 or max(int(a.max()), -int(a.min())) <= PLAIN for a in arrays)
    return [a.astype(np.int64 if plain else object) for a in arrays]


def build_tree(centroids: np.ndarray, leaf: int = LEAF) -> list[Node]:
    """Nodes of a vantage-point tree over the rows of ``centroids``; node 0 is the root."""
    (points,) = _comparable(centroids)
    nodes: list[Node] = []

    def grow(members: np.ndarray) -> int:
        at = len(nodes)
        nodes.append(Node(members=tuple(int(m) for m in members)))
        if len(members) <= leaf:
            return at
        # the vantage: the member farthest from the first one, a corner of the set
        vantage = members[int(np.argmax(squared(points[members], points[members[:1]])[:, 0]))]
        rest = members[members != vantage]
        away = squared(points[rest], points[[vantage]])[:, 0]
        order = np.argsort(away, kind="stable")
        halves = [order[: len(order) // 2], order[len(order) // 2:]]
        children = tuple((grow(rest[half]), float(away[half].min()) ** 0.5, float(away[half].max()) ** 0.5) for half in halves)
        nodes[at] = Node(vantage=int(vantage), children=children)
        return at

    grow(np.arange(len(points)))
    return nodes


def nearest(vectors: np.ndarray, centroids: np.ndarray, tree: list[Node]) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) for each row of ``vectors``; ties: the smaller number."""
    vectors, points = _comparable(vectors, centroids)
    n = len(vectors)
    best = np.full(n, np.iinfo(np.int64).max if points.dtype != object else 1 << 200, points.dtype)
    number = np.full(n, len(points))
    reach = np.full(n, np.inf)
    bound = np.full((n, len(tree)), np.inf)
    bound[:, 0] = 0

    def meet(rows: np.ndarray, which: int, distance: np.ndarray) -> None:
        closer = (distance < best[rows]) | ((distance == best[rows]) & (which < number[rows]))
        rows, distance = rows[closer], distance[closer]
        best[rows], number[rows], reach[rows] = distance, which, np.sqrt(distance.astype(float)) * (1 + SLACK)

    open_rows = np.arange(n)
    while len(open_rows):
        node = bound[open_rows].argmin(axis=1)
        least = bound[open_rows, node]
        going = np.isfinite(least) & (least <= reach[open_rows])
        open_rows, node = open_rows[going], node[going]
        for at in np.unique(node):
            rows = open_rows[node == at]
            least = bound[rows, at]
            bound[rows, at] = np.inf
            here = tree[at]
            members = here.members or (here.vantage,)
            away = squared(vectors[rows], points[list(members)])
            for i, which in enumerate(members):
                meet(rows, which, away[:, i])
            if here.children:
                root = np.sqrt(away[:, 0].astype(float))
                for child, near, far in here.children:
                    beyond = np.maximum(root - far, near - root) - SLACK * (root + far)
                    bound[rows, child] = np.maximum(least, beyond)
    return number, best


def _lists(column: pa.ListArray, dims: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dims)


def _pieces(batches: Iterator[pa.RecordBatch], name: str, dims: int, nodes: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    size = max(1, CELLS // nodes)
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            piece = batch.slice(at, size)
            yield piece, _lists(piece.column(name), dims)


def _sums(vectors: DataFrame, model, dims: int) -> dict[int, tuple[int, list[int]]]:
    """{cluster: (vectors, sum of each component)} after assigning all vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, tree = model.value
        counts = np.zeros(len(centroids), np.int64)
        totals = np.zeros((len(centroids), dims), object)
        for _, found in _pieces(batches, "v", dims, len(tree)):
            number, _ = nearest(found, centroids, tree)
            (plain,) = _comparable(found)
            for c in np.unique(number):
                mine = plain[number == c]
                counts[c] += len(mine)
                totals[c] += mine.sum(axis=0)
        used = np.flatnonzero(counts)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(used, dims).astype(np.int32)), pa.array(np.tile(np.arange(dims, dtype=np.int32), len(used))),
                 pa.array(np.repeat(counts[used], dims)),
                 pa.array([Decimal(int(x)) for x in totals[used].ravel()], pa.decimal128(38, 0))], ["cluster", "i", "n", "total"])

    added = (vectors.select("v").mapInArrow(run, "cluster int, i int, n long, total decimal(38,0)")
             .groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect())
    out: dict[int, tuple[int, list[int]]] = {}
    for r in added:
        out.setdefault(r["cluster"], (r["n"], [0] * dims))[1][r["i"]] = int(r["total"])
    return out


def _assigned(vectors: DataFrame, model, dims: int) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids, tree = model.value
        for piece, found in _pieces(batches, "v", dims, len(tree)):
            number, best = nearest(found, centroids, tree)
            distance = pa.array(best) if best.dtype != object else pa.array([int(d) if d < 1 << 63 else None for d in best], pa.int64())
            yield pa.RecordBatch.from_arrays([piece.column("vec_id"), pa.array(number.astype(np.int32)), distance],
                                             ["vec_id", "cluster", "distance"])

    return vectors.select("vec_id", "v").mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def kept_vectors(table: DataFrame, dims: int = 64, scale: int = 256) -> DataFrame:
    """(vec_id, v) of ``table(vec_id, embedding)``: whole numbers, of vectors of ``dims`` finite components."""
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long"))
    fits = F.forall("embedding", lambda c: F.coalesce(F.abs(c.cast("double")) * F.lit(float(scale)) <= F.lit(float(LARGEST)), F.lit(False))
                    & ~F.isnan(c))
    return table.where((F.size("embedding") == dims) & fits).select("vec_id", x.alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: str) -> np.ndarray:
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(name.asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def cluster(table: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: str = "2") -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid (its components)."""
    spark = table.sparkSession
    vectors = stored(kept_vectors(table.select("vec_id", "embedding"), dims, scale), "centroids-vectors")
    centroids = first_centroids(vectors, k, seed)
    out = "cluster int, cluster_inertia long, inertia long, centroid array<long>"
    if not len(centroids):
        empty = spark.createDataFrame([], out)
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).join(empty, "cluster").select(
            "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
    for _ in range(rounds):
        model = spark.sparkContext.broadcast((centroids, build_tree(centroids)))
        for c, (n, total) in _sums(vectors, model, dims).items():
            centroids[c] = [x // n for x in total]
        model.destroy()
    model = spark.sparkContext.broadcast((centroids, build_tree(centroids)))
    found = stored(_assigned(vectors, model, dims), "centroids-assigned")
    model.destroy()
    per = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"),
                                       F.count(F.lit(1)).alias("n"), F.count("distance").alias("known")).collect()
    sums = {r["cluster"]: int(r["s"]) if r["known"] == r["n"] else None for r in per}
    total = None if None in sums.values() else sum(sums.values())
    most = (1 << 63) - 1
    rows = [(c, None if s is None or s > most else s, None if total is None or total > most else total, centroids[c].tolist())
            for c, s in sums.items()]
    # a row per cluster: k rows
    return found.join(F.broadcast(spark.createDataFrame(rows, out)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def digest_of(centroid: str) -> Column:
    """Lowercase hex SHA-256 of the components as decimal numbers joined by commas."""
    return F.sha2(F.array_join(F.col(centroid).cast("array<string>"), ","), 256)
