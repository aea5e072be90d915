"""Centroid clustering in whole numbers: nearest centroids by the threshold algorithm, exact sums in Spark."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herdframe.session import cut_lineage

DIM = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
_CELLS = 1 << 19
#: Below this, differences, their squares and sums over a vector and over a batch fit into 64 bits.
_NARROW = 1 << 26
#: Sums travel as a high and a low part.
_PART = 10**27
_WIDEST = 1e50


def whole(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x): 64-bit integers, or Python's integers where a vector is too wide for them."""
    scaled = np.floor(scale * vectors.astype(np.float64))
    if not scaled.size or np.abs(scaled).max() < _NARROW:
        return scaled.astype(np.int64)
    return np.array([[int(x) for x in row] for row in scaled], object)


class Frontier:
    """Sorted lists of the centroids' values in each dimension."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        k, dim = centroids.shape
        order = np.argsort(centroids, axis=0, kind="stable")
        wide = centroids.dtype == object
        edge = (10**400) if wide else np.int64(1) << np.int64(30)
        rows = np.full((1, dim), edge, centroids.dtype)
        self.sorted = np.take_along_axis(centroids, order, 0)
        self.padded = np.concatenate([-rows, self.sorted, rows])
        self.ids = np.concatenate([np.zeros((1, dim), np.int64), order, np.zeros((1, dim), np.int64)])

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of each vector's nearest centroid (the smaller number of equal ones), and how many distances were computed.

        In every dimension the list is walked outward from the vector's value, one centroid a step. A centroid not met yet is at least as far in each
        dimension as the last one met there; once the sum of the squares of these exceeds the best exact distance, none can be nearer or as near.
        """
        if vectors.dtype == object and self.centroids.dtype != object:
            return Frontier(self.centroids.astype(object)).nearest(vectors)
        n, (k, dim) = len(vectors), self.centroids.shape
        columns = np.arange(dim)
        high = np.stack([np.searchsorted(self.sorted[:, j], vectors[:, j]) for j in range(dim)], 1).astype(np.int64) + 1
        low = high - 1
        best = np.full(n, -1, np.int64)
        least = np.zeros(n, self.centroids.dtype)
        seen = np.zeros((n, k), bool)
        active, computed = np.arange(n), 0
        for _ in range(k):
            x = vectors[active]
            down, up = x - self.padded[low[active], columns], self.padded[high[active], columns] - x
            under = (down <= up).astype(bool)
            front = np.where(under, down, up)
            met = self.ids[np.where(under, low[active], high[active]), columns]
            low[active] -= under
            high[active] += ~under
            new = np.zeros((len(active), k), bool)
            np.put_along_axis(new, met, True, 1)
            new &= ~seen[active]
            seen[active] |= new
            row, centroid = np.nonzero(new)
            if len(row):
                gap = x[row] - self.centroids[centroid]
                exact = (gap * gap).sum(1)
                computed += len(row)
                begins = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
                lowest = np.minimum.reduceat(exact, begins)
                at = np.flatnonzero(exact == np.repeat(lowest, np.diff(np.append(begins, len(row)))))
                whose, first = np.unique(row[at], return_index=True)
                number, mine = centroid[at[first]], active[whose]
                better = (best[mine] < 0) | (lowest < least[mine]) | ((lowest == least[mine]) & (number < best[mine]))
                best[mine[better]], least[mine[better]] = number[better], lowest[better]
            reach = (front * front).sum(1)
            active = active[~((reach > least[active]).astype(bool) | seen[active].all(1))]
            if not len(active):
                break
        return best, least, computed


def _batches(batches: Iterator[pa.RecordBatch], dim: int, clusters: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    rows = max(1, _CELLS // max(dim, clusters))
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            piece = batch.slice(start, rows)
            yield piece, whole(piece["vec"].flatten().to_numpy().reshape(piece.num_rows, dim), scale)


def _array(rows: list[list[int]]) -> np.ndarray:
    narrow = all(abs(x) < _NARROW for row in rows for x in row)
    return np.array(rows, np.int64 if narrow else object).reshape(len(rows), -1)


def _sums(kept: DataFrame, centroids: np.ndarray, scale: int) -> list:
    """(cluster, n, sums of the components): each task sends one row per cluster and component, the driver receives clusters * components sums."""
    frontier, (k, dim) = Frontier(centroids), centroids.shape

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = [[0] * dim for _ in range(k)], np.zeros(k, np.int64)
        for _, vectors in _batches(batches, dim, k, scale):
            number, _, _ = frontier.nearest(vectors)
            n += np.bincount(number, minlength=k)
            for c in np.unique(number):
                sums[c] = [a + int(b) for a, b in zip(sums[c], vectors[number == c].sum(0), strict=True)]
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, dim).astype(np.int32)), pa.array(np.tile(np.arange(dim, dtype=np.int32), len(used))), pa.array(np.repeat(n[used], dim)),
             *[pa.array([Decimal(part(x)) for c in used for x in sums[c]], pa.decimal128(38, 0)) for part in (lambda x: x // _PART, lambda x: x % _PART)]],
            names=["cluster", "at", "n", "high", "low"],
        )

    sent = kept.select("vec").mapInArrow(assign, "cluster int, at int, n long, high decimal(38,0), low decimal(38,0)")
    return sent.groupBy("cluster", "at").agg(*[F.sum(c).alias(c) for c in ("n", "high", "low")]).collect()


def cluster(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = 3) -> DataFrame:
    """Exact k-means in whole numbers: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, one row per kept vector.

    Kept are vectors of ``dim`` components, none null or non-finite; a component x becomes floor(scale * x). Centroids start as the vectors whose
    sha256 of ``seed:vec_id`` is smallest. Each round assigns every vector to the nearest centroid (squared distance, ties to the smaller number)
    and replaces non-empty centroids by the floored means. Every round is one pass that sends sums only; ``clusters`` * ``dim`` numbers reach the driver.

    Fewer vectors than clusters give as many centroids as there are vectors. Repeated rows are vectors of their own; those of one id
    start centroids in the order of their components; a null id comes last among the starts. Components are exact
    up to 1e50, beyond which a vector is not kept; a distance or a sum that does not fit into 64 bits is null. An empty table, or one without kept vectors, gives an empty result; other columns are ignored.
    """
    vec = F.col("embedding").cast("array<double>")
    sound = F.size(vec).eqNullSafe(dim) & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * float(scale)) < F.lit(_WIDEST)))
    kept = cut_lineage(vectors.select("vec_id", F.col("embedding").alias("vec")).filter(sound))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.select("vec").orderBy(F.asc_nulls_last(digest), kept["vec"].cast("array<double>")).limit(clusters).collect()
    schema = f"vec_id {kept.schema['vec_id'].dataType.simpleString()}, cluster int, distance long"
    names = {"cluster_inertia": "long", "inertia": "long", "centroid_sha256": "string"}
    if not first:
        return vectors.sparkSession.createDataFrame([], ", ".join([schema, *[f"{c} {t}" for c, t in names.items()]]))
    centroids = _array([[math.floor(scale * float(x)) for x in r.vec] for r in first])
    for _ in range(rounds):
        rows = [[int(x) for x in c] for c in centroids]
        for r in _sums(kept, centroids, scale):
            rows[r.cluster][r["at"]] = (int(r.high) * _PART + int(r.low)) // r.n
        moved = _array(rows)
        if (moved == centroids).all():
            break  # further rounds would give the same centroids
        centroids = moved
    frontier, k = Frontier(centroids), len(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, found in _batches(batches, dim, k, scale):
            number, distance, _ = frontier.nearest(found)
            fits = distance if distance.dtype != object else [int(x) if x < 1 << 63 else None for x in distance]
            yield pa.RecordBatch.from_arrays([piece["vec_id"], pa.array(number.astype(np.int32)), pa.array(fits, pa.int64())], names=["vec_id", "cluster", "distance"])

    assigned = cut_lineage(kept.mapInArrow(assign, schema))
    by = {r.cluster: (None if r.some else int(r.total)) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total"), F.max(F.col("distance").isNull()).alias("some")).collect()}
    all_of = None if None in by.values() else sum(by.values())
    fits = lambda x: F.lit(x if x is not None and x < 1 << 63 else None).cast("long")
    sha = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in centroids]
    own = lambda values: F.element_at(F.array(*values), F.col("cluster") + 1)
    return assigned.select(
        "vec_id", "cluster", "distance", own([fits(by.get(c, 0)) for c in range(k)]).alias("cluster_inertia"), fits(all_of).alias("inertia"), own([F.lit(x) for x in sha]).alias("centroid_sha256")
    )
