"""Centroid clustering against plain loops, and the bounds of the projection."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from zephyrload.llm import centroids

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("v", T.StringType()),
        T.StructField("cluster", T.StringType()),
        T.StructField("Distance", T.StringType()),
    ]
)


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "x", "x", "x") for i, v in vectors], SCHEMA).repartition(3)


def plain(vectors, width, k=8, rounds=10):
    """The definition, vector by vector."""
    most = centroids.MOST
    kept = [
        (i, [min(max(math.floor(1024 * float(np.float32(x))), -most), most) for x in v])
        for i, v in vectors
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    means = [v for _, v in order[:k]]

    def assign(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(means))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(assign(v)[1], []).append(v)
        means = [[sum(x) // len(groups[j]) for x in zip(*groups[j], strict=True)] if j in groups else c for j, c in enumerate(means)]
    return [(i, *assign(v)[::-1]) for i, v in kept], means


def check(spark, vectors, width):
    assigned, found = centroids.clusters(frame(spark, vectors), width=width)
    rows, means = plain(vectors, width)
    key = [(-1 if r[0] is None else r[0], *r[1:]) for r in rows]
    got = [(-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance) for r in assigned.collect()]
    assert sorted(got) == sorted(key)
    assert found.tolist() == means
    total = sum(r[2] for r in rows)
    for r in centroids.with_inertia(assigned, found).collect():
        assert r.inertia == total and r.cluster_inertia == sum(x[2] for x in rows if x[1] == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, means[r.cluster])).encode()).hexdigest()


def test_spread_vectors(spark):
    r = random.Random(1)
    check(spark, [(i, [r.gauss(i % 5, 1.0) for _ in range(6)]) for i in range(120)], 6)


def test_odd_vectors(spark):
    """Nulls, other lengths, infinities, copies, ties, repeated and NULL ids, negative and huge entries."""
    r = random.Random(2)
    vectors = [(i, [r.choice([-1.5, -0.0004, 0.0, 0.3, 1e30]) for _ in range(4)]) for i in range(40)]
    vectors += [(i % 3, [0.25, -0.25, 0.0, 1.0]) for i in range(30)]
    vectors += [(None, [1.0] * 4), (None, [2.0] * 4), (90, None), (91, []), (92, [1.0] * 5), (93, [1.0, None, 1.0, 1.0])]
    vectors += [(94, [float("nan"), 1.0, 1.0, 1.0]), (95, [1.0, float("inf"), 1.0, 1.0])]
    check(spark, vectors, 4)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_vectors(spark, n):
    check(spark, [(i, [float(i), 0.0]) for i in range(n)], 2)


def test_equal_vectors_are_one_cluster(spark):
    check(spark, [(i, [0.5, 0.5, 0.5]) for i in range(25)], 3)


def test_bounds_hold_and_filter():
    r = np.random.default_rng(3)
    v, others = r.integers(-2000, 2000, (400, 16)), r.integers(-2000, 2000, (30, 16))
    v[:50] += 20_000  # far away from the rest
    simplex = centroids.Simplex.over(np.concatenate([v[:3], v[:3], others[:6]]))  # equal pivots among them
    assert len(simplex.pivots) == 9
    exact = centroids.squared_distances(v, others)
    lower, upper = centroids.bounds(simplex.apexes(simplex.distances(v)), simplex.apexes(simplex.distances(others)))
    assert (lower <= exact).all() and (exact <= upper).all()
    assert (lower > upper.min(axis=1)[:, None]).any()
    assert (centroids.nearest(v, simplex.distances(v), simplex, others) == exact.argmin(axis=1)).all()
