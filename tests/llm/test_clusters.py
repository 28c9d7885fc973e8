"""Delta Lloyd against rounds that compare everything."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracefoundry.llm import clusters

SCHEMA = "vec_id long, embedding array<double>, label int, cluster string, distance string, q string"


def brute(rows, k, rounds, dims):
    """Every round compares every vector with every centroid, in Python integers."""
    most = clusters.MOST
    good = [r for r in rows if r[1] is not None and len(r[1]) == dims and all(x is not None and math.isfinite(x) for x in r[1])]
    xs = [[max(-most, min(most, math.floor(1024.0 * x))) for x in r[1]] for r in good]
    order = sorted((hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), x) for r, x in zip(good, xs) if r[0] is not None)
    centres = [x for _, x in order[:k]]
    if not centres:
        return []

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        owner = [nearest(x)[1] for x in xs]
        for j in range(len(centres)):
            own = [x for x, o in zip(xs, owner) if o == j]
            centres[j] = [sum(col) // len(own) for col in zip(*own)] if own else centres[j]
    best = [nearest(x) for x in xs]
    spent = [sum(d for d, j in best if j == c) for c in range(len(centres))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((r[0], j, d, spent[j], sum(spent), names[j]) for r, (d, j) in zip(good, best)), key=repr)


def vectors(seed, n, dims=64, spread=0.3):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    rows = [(i, [m + rng.gauss(0, spread) for m in rng.choice(middles)]) for i in range(n)]
    return [(i, x, i % 3, None, None, None) for i, x in rows]


def check(spark, rows, k=clusters.CLUSTERS, rounds=clusters.ROUNDS, dims=clusters.DIMS):
    got = clusters.cluster_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3), k, rounds, dims)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, k, rounds, dims)


def test_clusters_meet_brute_force(spark):
    rows = vectors(1, 150)
    rows += [rows[0], rows[0], (None, rows[3][1], 1, None, None, None), (7, rows[9][1], 1, None, None, None)]
    bad = [None, [], [1.0] * 63, [1.0] * 65, [None] * 64, [float("nan")] * 64, [1.0] * 63 + [float("inf")]]
    check(spark, rows + [(1000 + i, x, 0, None, None, None) for i, x in enumerate(bad)])


@pytest.mark.parametrize("rows", [[], [(1, None, 0, None, None, None)], [(None, [1.0] * 64, 0, None, None, None)], [(1, [0.5] * 64, 0, None, None, None)] * 3])
def test_few_vectors(spark, rows):
    check(spark, rows)


def test_ties_hot_vector_and_large_components(spark):
    rng = random.Random(3)
    grid = [(i, [float(rng.randint(-1, 1)) for _ in range(2)], 0, None, None, None) for i in range(60)]
    check(spark, grid + [(500 + i, [0.0, 0.0], 0, None, None, None) for i in range(80)], 4, 6, 2)
    large = [(i, [rng.choice([1e300, -1e300, 7e4, 6e4, 5000.5, -0.0001]) for _ in range(2)], 0, None, None, None) for i in range(40)]
    check(spark, large, 5, 4, 2)


def test_reassign_compares_all_that_matters():
    """Old distances and changed centroids give the same owners as comparing everything."""
    rng = np.random.default_rng(5)
    x = rng.integers(-6, 7, (4000, 3)).astype(np.int64)
    centres = rng.integers(-6, 7, (9, 3)).astype(np.int64)
    owner, distance = clusters.reassign(x, np.full(4000, -1, np.int32), np.zeros(4000, np.int64), centres, np.ones(9, bool))
    for _ in range(30):
        changed = rng.random(9) < 0.4
        centres = np.where(changed[:, None], rng.integers(-6, 7, (9, 3)), centres)
        owner, distance = clusters.reassign(x, owner, distance, centres, changed)
        full = clusters.distances(x, centres)
        assert (owner == full.argmin(1)).all() and (distance == full.min(1)).all()


def test_rounds_end_when_nothing_changes(spark, monkeypatch):
    passes = []
    real = clusters.cut
    monkeypatch.setattr(clusters, "cut", lambda df, name: passes.append(name) or real(df, name))
    rows = [(i, [float(i // 10)] * 4, 0, None, None, None) for i in range(20)]
    clusters.cluster_vectors(spark.createDataFrame(rows, SCHEMA), 2, 10, 4).where(F.lit(True)).collect()
    assert passes.count("op13-state") < 8
