from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from fieldpanel.operators import neighbors

FEATURES = ["f0", "f1", "f2"]


def table(spark, points, labels, key="id"):
    data = [(int(i), *map(float, p), float(y)) for i, (p, y) in enumerate(zip(points, labels))]
    return spark.createDataFrame(data, f"{key} bigint, f0 double, f1 double, f2 double, y double")


def brute_force(train, queries, k):
    """(query, rank) -> (point, distance), ties by point number."""
    found = {}
    for q, query in enumerate(queries):
        distance = np.round(np.sqrt(((train - query) ** 2).sum(axis=1)), 9)
        for rank, p in enumerate(np.lexsort((np.arange(len(train)), distance))[:k], 1):
            found[q, rank] = (int(p), float(distance[p]))
    return found


def search(spark, train, labels, queries, k, **blocks):
    found = neighbors.knn_neighbors(
        table(spark, train, labels, "point"),
        table(spark, queries, np.zeros(len(queries)), "query"),
        FEATURES, k, "point", "query", "y", **blocks,
    )
    return {(r.query, r["rank"]): (r.point, pytest.approx(r.distance, abs=1e-8))
            for r in found.collect()}


@pytest.mark.parametrize("block_rows", [10_000, 60])
def test_neighbors_are_exact_whatever_the_blocks(spark, block_rows):
    rng = np.random.default_rng(block_rows)
    train, queries = rng.normal(size=(400, 3)), rng.normal(size=(60, 3)) * 2
    got = search(spark, train, np.arange(400), queries, 5, block_rows=block_rows)
    assert got == brute_force(train, queries, 5)


def test_copies_and_ties_on_a_grid(spark):
    """A third of the points are one point; the rest lie on a coarse grid full of ties."""
    rng = np.random.default_rng(4)
    train = rng.integers(0, 4, size=(300, 3)).astype(float)
    train[:100] = 1.0
    queries = np.vstack([rng.integers(0, 4, size=(40, 3)), np.full((30, 3), 1)]).astype(float)
    got = search(spark, train, np.arange(300), queries, 15, block_rows=60)
    assert got == brute_force(train, queries, 15)


def test_box_tree_covers_all_points_and_survives_copies():
    rng = np.random.default_rng(1)
    points = np.vstack([rng.normal(size=(500, 3)), np.ones((400, 3))])
    tree = neighbors.BoxTree(points, 20)
    boxes = tree.locate(points)
    assert set(boxes) == set(range(tree.n_boxes))
    sizes = np.bincount(boxes)
    assert (np.sort(sizes)[:-1] <= 20).all()  # only the box of the copies may be larger
    assert neighbors.BoxTree(np.ones((50, 3)), 5).n_boxes == 1


def test_fewer_points_than_neighbors(spark):
    train = np.array([[0.0, 0, 0], [1, 0, 0]])
    queries = np.array([[0.2, 0, 0]])
    got = search(spark, train, [1, 2], queries, 5, block_rows=1)
    assert got == brute_force(train, queries, 5)


def test_box_limit_keeps_results(spark):
    rng = np.random.default_rng(9)
    train, queries = rng.normal(size=(300, 3)), rng.normal(size=(20, 3))
    got = search(spark, train, np.arange(300), queries, 3, block_rows=1, max_boxes=30)
    assert got == brute_force(train, queries, 3)


def test_regions_are_cut_again(spark):
    """Beyond max_boxes * block_rows points each upper box is a region with its own tree."""
    rng = np.random.default_rng(10)
    train = np.vstack([rng.normal(size=(900, 3)), np.round(rng.normal(size=(500, 3)), 1),
                       np.full((300, 3), 0.25), rng.normal(size=(50, 3)) * 40])
    queries = np.vstack([rng.normal(size=(80, 3)) * 2, np.full((5, 3), 0.25), train[:10]])
    got = search(spark, train, np.arange(len(train)), queries, 7, block_rows=16, max_boxes=6)
    assert got == brute_force(train, queries, 7)


def test_no_box_is_much_larger_than_a_block(spark):
    rng = np.random.default_rng(11)
    points = spark.createDataFrame(
        [(i, 0.0, *map(float, p)) for i, p in enumerate(rng.normal(size=(20_000, 3)))],
        "_point bigint, _label double, f0 double, f1 double, f2 double",
    )
    queries = points.select(F.col("_point").alias("_query"), *FEATURES).limit(10)
    sample = points.select(*FEATURES).limit(2000).toPandas().to_numpy()
    boxes = neighbors._Boxes(points, queries, FEATURES, sample, 20_000, 100, 8)
    sizes = [r.n for r in boxes.extents.collect()]
    assert boxes.regions and sum(sizes) == 20_000
    assert len(sizes) > 150 and np.median(sizes) < 120 and max(sizes) < 600
    assert boxes.home.join(boxes.extents, "_box").count() == 10


def test_descent_reaches_the_boxes_that_all_distances_reach():
    rng = np.random.default_rng(12)
    points = rng.normal(size=(3000, 3))
    tree = neighbors.BoxTree(points, 50)
    box = tree.locate(points)
    low, high = (np.array([f(points[box == b], axis=0) for b in range(tree.n_boxes)])
                 for f in (np.min, np.max))
    tree.set_extents(np.arange(tree.n_boxes), low, high)
    queries, limit = rng.normal(size=(40, 3)) * 2, rng.random(40) * 2
    limit[0] = np.inf
    gap = np.maximum(np.maximum(low[None] - queries[:, None], queries[:, None] - high[None]), 0)
    want = np.argwhere(np.sqrt((gap**2).sum(axis=2)) <= limit[:, None])
    got = np.column_stack(tree.reach(queries, limit))
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10_000), st.integers(1, 4), st.integers(5, 40))
def test_any_shape(spark, seed, k, block_rows):
    rng = np.random.default_rng(seed)
    train = np.round(rng.normal(size=(rng.integers(1, 80), 3)), 1)
    queries = np.round(rng.normal(size=(12, 3)), 1)
    got = search(spark, train, np.arange(len(train)), queries, k, block_rows=block_rows)
    assert got == brute_force(train, queries, k)


def test_no_training_rows(spark):
    empty = table(spark, np.zeros((1, 3)), [0], "point").limit(0)
    with pytest.raises(ValueError, match="training"):
        neighbors.knn_neighbors(
            empty, table(spark, np.zeros((1, 3)), [0], "query"), FEATURES, 1, "point", "query", "y"
        )


def test_a_zero_distance_neighbor_stands_alone(spark, rows):
    found = spark.createDataFrame(
        [("q", 1, 0.0, 10.0), ("q", 2, 0.0, 20.0), ("q", 3, 1.0, 99.0),
         ("r", 1, 1.0, 10.0), ("r", 2, 2.0, 40.0), ("r", 3, 4.0, 0.0)],
        "q string, rank int, distance double, y double",
    )
    weighted = neighbors.knn_predict(found, "q", "y", [2, 3])
    assert rows(weighted) == [
        ("q", 2, 15.0), ("q", 3, 15.0), ("r", 2, pytest.approx(20.0)),
        ("r", 3, pytest.approx((10 + 20) / 1.75)),
    ]
    uniform = neighbors.knn_predict(found, "q", "y", [3], "uniform")
    assert rows(uniform) == [("q", 3, 43.0), ("r", 3, pytest.approx(50 / 3))]
    with pytest.raises(ValueError, match="weights"):
        neighbors.knn_predict(found, "q", "y", [3], "rank")
    with pytest.raises(ValueError, match="key column"):
        neighbors.knn_predict(found.withColumnRenamed("q", "k"), "k", "y", [3])


@pytest.mark.parametrize(
    ("side", "row", "message"),
    [
        ("train", (0, 1.0, 1.0, 1.0, 1.0), "unique"),
        ("test", (0, 1.0, 1.0, 1.0, 1.0), "unique"),
        ("train", (None, 1.0, 1.0, 1.0, 1.0), "not NULL"),
        ("train", (9, None, 1.0, 1.0, 1.0), "NaN"),
        ("test", (9, 1.0, float("nan"), 1.0, 1.0), "NaN"),
    ],
)
def test_rows_that_would_be_merged_or_lost_are_refused(spark, side, row, message):
    schema = "id bigint, f0 double, f1 double, f2 double, y double"
    good = table(spark, np.zeros((3, 3)), np.zeros(3))
    both = {"train": good, "test": good}
    both[side] = good.unionByName(spark.createDataFrame([row], schema))
    with pytest.raises(ValueError, match=message):
        neighbors.knn_neighbors(
            both["train"].withColumnRenamed("id", "point"),
            both["test"].withColumnRenamed("id", "query"),
            FEATURES, 2, "point", "query", "y",
        )
