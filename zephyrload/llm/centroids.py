"""Centroid clustering of integer vectors, with centroids filtered by n-simplex projection.

Distances to a few pivots, taken once and kept with each vector, place it as the apex of a
simplex over them: its coordinates in the space the pivots span, and its height above that
space. For two apexes the Euclidean distance is a lower bound of the true one, and with one
height turned to the other side an upper bound. A centroid is projected the same way
from its distances to the pivots, each round; centroids whose lower bound is above
the smallest upper bound are out, and only vectors with several left compare exact
integer distances. Bounds are widened by more than doubles can be off, so no result
depends on them.

Vectors never leave their partitions: a round sends k centroids out and gets k sums back, of which
each task makes one before they are added up by entry. Pivots are vectors of the data, k and their number are
parameters, so nothing that is sent or collected grows with the data, and a cluster that
holds most vectors is one sum per task like any other.

Defined cases: vectors of another length, NULL, or with a NULL or non-finite entry are left
out; entries beyond +-131,072 count as that bound, so that all sums stay exact
integers; of vectors at equal distance to several centroids the smallest number wins; repeated
rows count each; a NULL id hashes like an empty one; fewer vectors than ``k`` give as many
clusters; no vector gives no row. Columns named otherwise than the id and the vector
are not read, so their names do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zephyrload.llm.common import stage

CLUSTERS = 8
ROUNDS = 10
PIVOTS = 9
SCALE = 1024
SEED = "3:"
PIVOT_SEED = "pivot:"
#: Largest size of an entry as integer: squared distances of 64 entries stay below 2 ** 63.
MOST = 1 << 27
#: A pivot closer than this to the space of those before it, as a share of the farthest, adds nothing.
LEAST_HEIGHT = 1e-3


def usable(vectors: DataFrame, vec_id: str, vector: str, width: int, scale: int = SCALE) -> DataFrame:
    """vec_id and v: the entries as integers, floor(scale * x), of the vectors that count."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    whole = F.transform(
        x, lambda e: F.least(F.greatest(F.floor(e * scale), F.lit(-MOST)), F.lit(MOST)).cast("int")
    )
    kept = vectors.where(F.coalesce((F.size(x) == width) & finite, F.lit(False)))
    return kept.select(F.col(vec_id).alias("vec_id"), whole.alias("v"))


def first_by_hash(rows: DataFrame, seed: str, n: int) -> np.ndarray:
    """The ``n`` vectors of smallest hash of seed and id; equal ids in the order of their entries."""
    text = F.concat(F.lit(seed), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = rows.select(F.sha2(text.cast("binary"), 256).alias("h"), "v").orderBy("h", "v").limit(n).collect()
    return np.array([r.v for r in first], np.int64)


@dataclass
class Simplex:
    """A base simplex over pivots, and apexes over it."""

    pivots: np.ndarray
    inverse: np.ndarray  # of the lower triangle of the pivots' own coordinates
    edges: np.ndarray  # squared distances of the pivots to the first one

    @staticmethod
    def over(pivots: np.ndarray, least: float = LEAST_HEIGHT) -> Simplex:
        """Keeps only pivots that add a dimension; equal or dependent ones do not."""
        kept, rows = [pivots[0]], []
        edges = ((pivots - pivots[0]) ** 2).sum(axis=1).astype(np.float64)
        farthest = np.sqrt(edges.max())
        for pivot in pivots[1:]:
            base = np.array(kept)
            dots = ((base[1:] - base[0]) * (pivot - base[0])).sum(axis=1).astype(np.float64)
            row = np.zeros(len(kept) - 1)
            for j in range(len(row)):
                row[j] = (dots[j] - rows[j][:j] @ row[:j]) / rows[j][j]
            height = float(((pivot - base[0]) ** 2).sum()) - float(row @ row)
            if height > (least * farthest) ** 2:
                rows.append(np.append(row, np.sqrt(height)))
                kept.append(pivot)
        n = len(rows)
        lower = np.zeros((n, n))
        for i, row in enumerate(rows):
            lower[i, : i + 1] = row
        chosen = np.array(kept)
        return Simplex(chosen, np.linalg.inv(lower) if n else lower, ((chosen[1:] - chosen[0]) ** 2).sum(axis=1).astype(np.float64))

    def distances(self, v: np.ndarray) -> np.ndarray:
        """Exact squared distances to the pivots."""
        return squared_distances(v, self.pivots)

    def apexes(self, squared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Coordinates in the pivots' space and heights above it, from squared distances alone."""
        d = squared.astype(np.float64)
        dots = (d[:, :1] + self.edges - d[:, 1:]) / 2
        inside = dots @ self.inverse.T
        return inside, np.sqrt(np.maximum(d[:, 0] - (inside**2).sum(axis=1), 0))


def squared_distances(v: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact integer squared distances, one column per other vector."""
    out = np.empty((len(v), len(others)), np.int64)
    for j, other in enumerate(others):
        apart = v - other
        out[:, j] = np.einsum("ij,ij->i", apart, apart)
    return out


def bounds(at: tuple[np.ndarray, np.ndarray], others: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the squared distances between two lists of apexes."""
    (a, h), (b, g) = at, others
    flat = np.maximum((a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1) - 2 * (a @ b.T), 0)
    # what doubles may be off by, as a share of the numbers that went in
    size = (a**2).sum(axis=1)[:, None] + (h**2)[:, None] + (b**2).sum(axis=1) + g**2
    slack = 1e-6 * size + 1e-6
    return flat + (h[:, None] - g) ** 2 - slack, flat + (h[:, None] + g) ** 2 + slack


def nearest(v: np.ndarray, squared: np.ndarray, simplex: Simplex, centroids: np.ndarray) -> np.ndarray:
    """Number of each vector's nearest centroid; ties go to the smaller number."""
    lower, upper = bounds(simplex.apexes(squared), simplex.apexes(simplex.distances(centroids)))
    open_ = lower <= upper.min(axis=1)[:, None]
    chosen = open_.argmax(axis=1)
    several = np.flatnonzero(open_.sum(axis=1) > 1)
    if len(several):
        exact = np.full((len(several), len(centroids)), np.iinfo(np.int64).max)
        for j in range(len(centroids)):
            rows = np.flatnonzero(open_[several, j])
            exact[rows, j] = squared_distances(v[several[rows]], centroids[j : j + 1])[:, 0]
        chosen[several] = exact.argmin(axis=1)  # the first of equal ones
    return chosen


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, width).astype(kind)


def _with_pivot_distances(rows: DataFrame, simplex: Simplex, width: int) -> DataFrame:
    schema = T.StructType([*rows.schema.fields, T.StructField("d", T.ArrayType(T.LongType(), False))])
    n = len(simplex.pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = simplex.distances(_matrix(batch.column(1), width, np.int64))
            offsets = pa.array(np.arange(0, d.size + 1, n), pa.int32())
            made = pa.ListArray.from_arrays(offsets, pa.array(d.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), made], names=schema.names)

    return rows.mapInArrow(run, schema)


def _sums(rows: DataFrame, simplex: Simplex, centroids: np.ndarray) -> np.ndarray:
    """Per centroid the sum of its vectors and, last, their number."""
    k, width = centroids.shape
    n = len(simplex.pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, width + 1), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column(0), width, np.int64)
            chosen = nearest(v, _matrix(batch.column(1), n, np.int64), simplex, centroids)
            for j in range(k):
                mine = v[chosen == j]
                total[j, :width] += mine.sum(axis=0)
                total[j, width] += len(mine)
        held = np.flatnonzero(total[:, width])
        sums = pa.array(total[held].tolist(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), sums], names=["cluster", "sums"])

    parts = rows.select("v", "d").mapInArrow(run, "cluster int, sums array<long>")
    entries = parts.select("cluster", F.posexplode("sums").alias("entry", "value"))
    found = entries.groupBy("cluster", "entry").agg(F.sum("value").alias("value"))
    total = np.zeros((k, width + 1), np.int64)
    for row in found.collect():  # k * (width + 1) rows at most
        total[row.cluster, row.entry] = row.value
    return total


def clusters(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    width: int = 64,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    pivots: int = PIVOTS,
    scale: int = SCALE,
    seed: str = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """Per vector vec_id, cluster and distance (squared), and the final centroids."""
    rows = stage(usable(vectors, vec_id, vector, width, scale), "vectors")
    kind = rows.schema["vec_id"]
    schema = T.StructType([kind, T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    centroids = first_by_hash(rows, seed, k)
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], schema), centroids
    simplex = Simplex.over(first_by_hash(rows, PIVOT_SEED, pivots))
    held = stage(_with_pivot_distances(rows, simplex, width), "pivot-distances")
    for _ in range(rounds):
        sums = _sums(held, simplex, centroids)
        counts = sums[:, -1:]
        # floor also below zero; a centroid without vectors stays
        centroids = np.where(counts > 0, sums[:, :-1] // np.maximum(counts, 1), centroids)
    final, n = centroids, len(simplex.pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column(1), width, np.int64)
            chosen = nearest(v, _matrix(batch.column(2), n, np.int64), simplex, final)
            apart = v - final[chosen]
            distance = np.einsum("ij,ij->i", apart, apart)
            made = [batch.column(0), pa.array(chosen.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(made, names=schema.names)

    return stage(held.mapInArrow(assign, schema), "assigned"), centroids


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Beside each vector the inertia of its cluster and of all, and its centroid's digest."""
    found = assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()  # k rows at most
    inertia = {r["cluster"]: r["s"] for r in found}
    per_cluster = [(j, inertia.get(j, 0), sum(inertia.values()), centroid_digest(c)) for j, c in enumerate(centroids)]
    side = assigned.sparkSession.createDataFrame(
        per_cluster, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return assigned.join(F.broadcast(side), "cluster").select(
        *assigned.columns, "cluster_inertia", "inertia", "centroid_sha256"
    )
