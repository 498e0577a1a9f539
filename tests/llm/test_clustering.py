"""Centroid clustering against plain integer arithmetic."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from fieldpanel.llm import centroid_clustering as cc

SCHEMA = "vec_id bigint, embedding array<float>, id string, v int, cluster string"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    rows = [(i, v, "x", 1, "y") for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def brute(rows, width, clusters, rounds):
    """(id, cluster, distance) of every usable row, all centroids measured in Python integers."""
    kept = []
    for i, v in rows:
        if v is None or len(v) != width:
            continue
        if any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    named = sorted(
        (hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept
    )
    centres = [v for _, v in named[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        homes = [nearest(v)[1] for _, v in kept]
        for n in range(len(centres)):
            mine = [v for (_, v), home in zip(kept, homes) if home == n]
            if mine:
                centres[n] = [sum(x) // len(mine) for x in zip(*mine)]
    return [(i, n, d) for i, v in kept for d, n in [nearest(v)]], centres


def key(row):
    return (row[0] is not None, row)


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_equal_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    vectors = rng.normal(scale=0.3, size=(400, 8)).astype(np.float32)
    vectors[200:260] = vectors[0]  # repeated rows
    vectors[260:330] = np.round(vectors[260:330])  # ties between centroids
    vectors = vectors.tolist()
    found = cc.cluster_vectors(table(spark, vectors), width=8, clusters=12, rounds=4)
    want, centres = brute(list(enumerate(vectors)), 8, 12, 4)
    got = [tuple(r) for r in found.assigned.select("id", "cluster", "distance").collect()]
    assert sorted(got) == sorted(want)
    assert found.centroids.tolist() == centres
    rows = cc.described(found).collect()
    assert {r.inertia for r in rows} == {sum(d for _, _, d in want)}
    for r in rows:
        text = ",".join(map(str, centres[r.cluster])).encode()
        assert r.centroid_sha256 == hashlib.sha256(text).hexdigest()
        assert r.cluster_inertia == sum(d for _, n, d in want if n == r.cluster)


def test_unusable_vectors_are_left_out(spark):
    inf, nan = float("inf"), float("nan")
    vectors = [
        [0.5, 1.0], None, [], [1.0], [1.0, 2.0, 3.0], [None, 1.0], [nan, 1.0], [inf, 1.0],
        [1.0, -inf], [3e38, 1.0], [0.25, 1.0], [0.25, 1.0], [-0.5, 7.0],
    ]
    ids = [*range(11), 10, None]
    found = cc.cluster_vectors(table(spark, vectors, ids), width=2, clusters=40, rounds=3)
    rows = [(i, v) for i, v in zip(ids, vectors) if v != [3e38, 1.0]]
    want, _ = brute(rows, 2, 40, 3)
    got = [tuple(r) for r in found.assigned.select("id", "cluster", "distance").collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_no_vectors(spark):
    found = cc.described(cc.cluster_vectors(table(spark, [[1.0]]), width=64))
    assert found.count() == 0
    assert found.columns[:3] == ["vec_id", "cluster", "distance"]


def test_equal_vectors_make_one_pivot(spark):
    found = cc.cluster_vectors(table(spark, [[1.0, 2.0]] * 50), width=2, clusters=5)
    assert {(r.cluster, r.distance) for r in found.assigned.collect()} == {(0, 0)}


def test_bounds_never_exceed_distances_and_do_rule_out():
    rng = np.random.default_rng(3)
    centres = rng.integers(-900, 900, (30, 64))
    rows = np.concatenate([centres[rng.integers(0, 30, 500)] + rng.integers(-40, 40, (500, 64)),
                           centres, rng.integers(-(1 << 26), 1 << 26, (20, 64))])
    index = cc.Index(centres, cc.choose_pivots(centres))
    cached = cc.pivot_distances(rows, index.pivots)
    exact = np.column_stack([cc.squared(rows, c) for c in centres])
    assert (index.bounds(cached) <= exact).all()
    cluster, best, measured = index.assign(rows, cached)
    assert (cluster == exact.argmin(axis=1)).all()
    assert (best == exact.min(axis=1)).all()
    assert measured[:500].mean() < 15  # half of the centroids are never measured


def test_largest_component_fits_a_long():
    for width in (1, 2, 64, 100, 1024):
        edge = cc.largest(width) - 1
        assert width * (2 * edge) ** 2 < 1 << 63
