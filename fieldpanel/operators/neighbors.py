"""Exact nearest-neighbour regression as partitioned joins.

Training points are cut into boxes of about ``block_rows`` points, however many there are: a
tree over a sample on the driver has at most ``max_boxes`` boxes, and if these would hold
too many points, each is a region that tasks cut again by a tree of its own. Trees of regions
stay in a table; rows meet the tree of their region as a stream, so neither the driver nor a
task holds all boxes.

A query first meets the points of its own box, which bounds the distance of its k-th
neighbour, and then only the boxes that come closer than that bound, found by descending the
trees. Within a box, points and queries are cut into blocks of bounded size; each pair of
blocks yields at most k neighbours per query, so no pair list is ever produced and the
result is exact.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from fieldpanel.shipping import ship
from fieldpanel.staging import stage

DISTANCE_DIGITS = 9  # distances equal to this many digits are ties
SAMPLE_ROWS = 20_000  # expected rows of the sample that places the upper box borders
SAMPLE_PER_BOX = 8  # expected sampled rows per box of a region
REGION = 1 << 32  # box numbers of a region start at its number times this


class BoxTree:
    """Boxes as a binary tree: node i sends values up to ``at`` of ``axis`` to its low child.

    Child numbers below zero are leaves: box b is ``-1 - b``.
    """

    def __init__(self, sample: np.ndarray, leaf_rows: int):
        self.axis: list[int] = []
        self.at: list[float] = []
        self.children: list[list[int]] = []
        self.n_boxes = 0
        self.root = self._grow(sample, leaf_rows)
        self.axis, self.at = np.array(self.axis, np.int64), np.array(self.at)
        self.children = np.array(self.children, np.int64).reshape(-1, 2)
        self.low = self.high = np.empty((0, sample.shape[1]))

    def _grow(self, points: np.ndarray, leaf_rows: int) -> int:
        """Halve the sample along its widest axis until a leaf is small."""
        cut = self._cut(points) if len(points) > leaf_rows else None
        if cut is None:
            self.n_boxes += 1
            return -self.n_boxes
        axis, at = cut
        node = len(self.axis)
        self.axis.append(axis)
        self.at.append(at)
        self.children.append([0, 0])
        low = points[:, axis] <= at
        self.children[node] = [
            self._grow(points[low], leaf_rows), self._grow(points[~low], leaf_rows)
        ]
        return node

    @staticmethod
    def _cut(points: np.ndarray) -> tuple[int, float] | None:
        """The widest axis and a value near its median that has points on both sides."""
        for axis in np.argsort(np.ptp(points, axis=0))[::-1]:
            values = points[:, axis]
            at = np.median(values)
            if at >= values.max():  # the upper half is one value: cut below it
                below = values[values < at]
                if not len(below):
                    continue
                at = below.max()
            return int(axis), float(at)
        return None

    def locate(self, points: np.ndarray) -> np.ndarray:
        """Box number of each point: all points go down one level at a time."""
        node = np.full(len(points), self.root)
        moving = np.flatnonzero(node >= 0)
        while len(moving):
            here = node[moving]
            high = points[moving, self.axis[here]] > self.at[here]
            node[moving] = self.children[here, high.astype(int)]
            moving = moving[node[moving] >= 0]
        return -1 - node

    def set_extents(self, boxes: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Give the boxes, and the nodes above them, the extents of the points they hold."""
        nodes = len(self.axis)
        shape = (nodes + self.n_boxes, low.shape[1])
        self.low, self.high = np.full(shape, np.inf), np.full(shape, -np.inf)
        self.low[nodes + boxes], self.high[nodes + boxes] = low, high
        for node in range(nodes - 1, -1, -1):  # children come after their parent
            below = self._rows(self.children[node])
            self.low[node] = self.low[below].min(axis=0)
            self.high[node] = self.high[below].max(axis=0)

    def _rows(self, node: np.ndarray) -> np.ndarray:
        """Places of nodes and boxes in the extents."""
        return np.where(node >= 0, node, len(self.axis) - 1 - node)

    def reach(self, points: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, box) of the boxes that come within each point's limit, by descent."""
        rows, node = np.arange(len(points)), np.full(len(points), self.root)
        found_rows, found_boxes = [], []
        while len(rows):
            at = self._rows(node)
            value = points[rows]
            gap = np.maximum(np.maximum(self.low[at] - value, value - self.high[at]), 0)
            near = np.sqrt((gap**2).sum(axis=1)) <= limit[rows]
            rows, node = rows[near], node[near]
            box = node < 0
            found_rows.append(rows[box])
            found_boxes.append(-1 - node[box])
            rows, node = np.repeat(rows[~box], 2), self.children[node[~box]].ravel()
        none = np.empty(0, np.int64)
        return np.concatenate([none, *found_rows]), np.concatenate([none, *found_boxes])

    def column(self, features: Sequence[str]) -> Column:
        """The box number as a column."""
        if self.n_boxes == 1:
            return F.lit(0).cast("bigint")

        @F.pandas_udf(T.LongType())
        def box(*values: pd.Series) -> pd.Series:
            return pd.Series(self.locate(np.column_stack(values)))

        return box(*[F.col(c) for c in features])


def _block_of(key: str, blocks: Column) -> Column:
    """Block by hash of the unique key: the same block whenever a task is retried."""
    return F.pmod(F.xxhash64(F.col(key)), blocks).cast("int")


def _smallest(distance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k smallest values of each row, the first columns on ties."""
    k = min(k, distance.shape[1])
    limit = np.partition(distance, k - 1, axis=1)[:, k - 1]
    row, at = np.nonzero(distance <= limit[:, None])  # the k smallest and ties of the last
    order = np.lexsort((at, distance[row, at], row))
    row, at = row[order], at[order]
    first = np.searchsorted(row, np.arange(len(distance)))
    keep = np.arange(len(row)) - first[row] < k
    return row[keep], at[keep]


def _block_neighbors(features: list[str], k: int, slice_rows: int = 256):
    """The cogroup function: top k points of one point block for each query of one block."""

    def nearest(queries: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        found = {"_query": [], "_point": [], "_label": [], "distance": []}
        if len(queries) and len(points):
            points = points.sort_values("_point", kind="stable")
            names, labels = points["_point"].to_numpy(), points["_label"].to_numpy()
            p, q = points[features].to_numpy(), queries[features].to_numpy()
            ids = queries["_query"].to_numpy()
            for start in range(0, len(q), slice_rows):
                part = q[start : start + slice_rows]
                square = np.zeros((len(part), len(p)))
                for axis in range(len(features)):
                    square += (part[:, axis, None] - p[None, :, axis]) ** 2
                distance = np.round(np.sqrt(square), DISTANCE_DIGITS)
                row, at = _smallest(distance, k)
                found["_query"].extend(ids[start + row])
                found["_point"].extend(names[at])
                found["_label"].extend(labels[at])
                found["distance"].extend(distance[row, at])
        return pd.DataFrame(found)

    return nearest


def _limit(batch: pd.DataFrame) -> np.ndarray:
    """How far a query has to look: its bound and what rounding may hide."""
    bound = batch["_bound"].fillna(np.inf).to_numpy()
    return bound * (1 + 1e-9) + 10.0**-DISTANCE_DIGITS


def _reached(tree: BoxTree, features: list[str], batch: pd.DataFrame) -> pd.DataFrame:
    """``batch`` repeated for every box its limit reaches into, named by ``_reached``."""
    parts = []
    for start in range(0, len(batch), 1024):
        part = batch.iloc[start : start + 1024]
        rows, boxes = tree.reach(part[features].to_numpy(float), _limit(part))
        parts.append(part.iloc[rows].assign(_reached=boxes))
    return pd.concat(parts) if parts else batch.assign(_reached=np.empty(0, np.int64))


def _nearby_boxes(tree: BoxTree, features: list[str], keep: list[str], name: str):
    """Map function: the boxes that a query's bound reaches into, its own left out."""

    def reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = _reached(tree, features, batch)
            if name == "_box":
                found = found[found["_reached"] != found["_home"]]
            yield found.rename(columns={"_reached": name})[[*keep, name]]

    return reach


# --- regions: boxes that are cut again --------------------------------------


def _grown(features: list[str], leaf_rows: int):
    """Group function: the tree of one region from its sampled points."""

    def grow(sample: pd.DataFrame) -> pd.DataFrame:
        tree = BoxTree(sample[features].to_numpy(float), leaf_rows)
        return pd.DataFrame(
            {"_region": sample["_region"].iloc[:1].to_numpy(), "_tree": [pickle.dumps(tree)]}
        )

    return grow


def _extended(width: int):
    """Cogroup function: a region's tree with the extents of its boxes."""

    def extend(trees: pd.DataFrame, boxes: pd.DataFrame) -> pd.DataFrame:
        tree = pickle.loads(trees["_tree"].iloc[0])
        low, high = (boxes[[f"{s}_{i}" for i in range(width)]].to_numpy() for s in ("low", "high"))
        tree.set_extents((boxes["_box"] % REGION).to_numpy(), low, high)
        return trees.assign(_tree=[pickle.dumps(tree)])

    return extend


def _through_trees(
    rows: DataFrame, trees: DataFrame, use: Callable, schema: T.StructType
) -> DataFrame:
    """``use(tree, rows)`` for the rows of each region, as a stream behind the region's tree.

    A region with more than a fair share of the rows is spread over salts. What is
    broadcast and collected is a row per region, of which the upper tree bounds the number.
    """
    spark = rows.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = rows.groupBy("_region").agg(F.count("*").alias("n")).collect()
    fair = max(-(-sum(r["n"] for r in counts) // width), 1)
    salts = F.broadcast(
        spark.createDataFrame(
            [(r["_region"], -(-r["n"] // fair)) for r in counts], "_region bigint, _salts bigint"
        )
    )
    names = rows.columns
    spread = (
        rows.withColumn("_tie", F.monotonically_increasing_id())
        .join(salts, "_region")
        .withColumn("_salt", F.pmod("_tie", "_salts"))
        .select(*names, "_salt", F.lit(None).cast("binary").alias("_tree"))
    )
    heads = trees.join(salts, "_region").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_salts") - 1))
    )
    heads = heads.select("_region", "_salt", "_tree")
    both = spread.unionByName(heads, allowMissingColumns=True)
    both = both.repartition("_region", "_salt").sortWithinPartitions(
        "_region", "_salt", F.col("_tree").isNull()
    )

    def follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = None
        for batch in batches:
            starts = np.flatnonzero(batch["_tree"].notna().to_numpy())
            for start, end in zip([0, *(starts + 1)], [*starts, len(batch)]):
                if start > 0:
                    tree = pickle.loads(batch["_tree"].iloc[start - 1])
                if end > start:
                    yield use(tree, batch.iloc[start:end][names])

    return both.mapInPandas(follow, schema)


def _top_k(candidates: DataFrame, k: int) -> DataFrame:
    """The k nearest candidates per query. Only k per task and query are shuffled."""
    order = Window.partitionBy("_query").orderBy("distance", "_point")
    return candidates.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def check_points(df: DataFrame, key: str, features: Sequence[str]) -> None:
    """Refuse rows that a search would merge (equal keys) or lose (features without a value)."""
    values = [F.col(f"`{c}`").cast("double") for c in features]
    empty = reduce(or_, [v.isNull() | F.isnan(v) for v in values], F.lit(False))
    per_key = df.groupBy(F.col(f"`{key}`").alias("_key")).agg(
        F.count("*").alias("rows"), F.count_if(empty).alias("empty")
    )
    found = per_key.agg(
        F.max("rows").alias("rows"),
        F.sum("empty").alias("empty"),
        F.count_if(F.col("_key").isNull()).alias("no_key"),
    ).first()
    if found["no_key"] or (found["rows"] or 0) > 1:
        raise ValueError(f"keys in {key!r} must be unique and not NULL")
    if found["empty"]:
        raise ValueError(f"{found['empty']} rows have NULL or NaN features")


def knn_neighbors(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    k: int,
    train_key: str,
    test_key: str,
    label: str,
    block_rows: int = 4096,
    max_boxes: int = 1024,
) -> DataFrame:
    """(``test_key``, rank, ``train_key``, distance, ``label``) of the k nearest.

    Keys must be unique and not NULL, and features neither NULL nor NaN, or the search
    is refused; ``train_key`` breaks ties.
    """
    spark = train.sparkSession
    ship(spark)
    features = list(features)
    check_points(train, train_key, features)
    check_points(test, test_key, features)
    vector = [F.col(c).cast("double").alias(c) for c in features]
    # Of equal points only the k first by key can be anyone's neighbours. The
    # filter on the row number trims such copies before they are shuffled.
    copies = Window.partitionBy(*features).orderBy("_point")
    points = (
        train.select(
            F.col(train_key).alias("_point"), F.col(label).cast("double").alias("_label"), *vector
        )
        .withColumn("_copy", F.row_number().over(copies))
        .filter(F.col("_copy") <= k)
        .drop("_copy")
    )
    points = stage(points, "points")
    queries = stage(test.select(F.col(test_key).alias("_query"), *vector), "queries")

    n_points = points.count()
    if n_points == 0:
        raise ValueError("no training rows")
    sample = points.select(*features)
    if n_points > SAMPLE_ROWS:  # sets borders only: any borders give exact results
        sample = sample.sample(SAMPLE_ROWS / n_points, seed=7)
    sample = sample.toPandas().to_numpy()
    boxes = _Boxes(points, queries, features, sample, n_points, block_rows, max_boxes)
    points = boxes.points

    key_type = {f.name: f.dataType for f in train.schema.fields}[train_key]
    query_type = {f.name: f.dataType for f in test.schema.fields}[test_key]
    found = T.StructType(
        [
            T.StructField("_query", query_type),
            T.StructField("_point", key_type),
            T.StructField("_label", T.DoubleType()),
            T.StructField("distance", T.DoubleType()),
        ]
    )

    def meet(visits: DataFrame) -> DataFrame:
        """Neighbours within each visited box: visits are (_query, features, _box)."""
        waiting = visits.groupBy("_box").agg(F.count("*").alias("visits"))
        # a row per visited box: Spark broadcasts the written table only if it is small
        plan = stage(
            boxes.extents.join(waiting, "_box").select(
                "_box",
                F.ceil(F.col("n") / block_rows).cast("int").alias("_p_blocks"),
                F.ceil(F.col("visits") / block_rows).cast("int").alias("_q_blocks"),
            ),
            "box_plan",
        )
        cells = ["_box", "_p_block", "_q_block"]
        left = (
            visits.join(plan, "_box")
            .withColumn("_q_block", _block_of("_query", F.col("_q_blocks")))
            .withColumn("_p_block", F.explode(F.sequence(F.lit(0), F.col("_p_blocks") - 1)))
            .select(*cells, "_query", *features)
        )
        right = (
            points.join(plan, "_box")
            .withColumn("_p_block", _block_of("_point", F.col("_p_blocks")))
            .withColumn("_q_block", F.explode(F.sequence(F.lit(0), F.col("_q_blocks") - 1)))
            .select(*cells, "_point", "_label", *features)
        )
        return (
            left.groupBy(*cells)
            .cogroup(right.groupBy(*cells))
            .applyInPandas(_block_neighbors(features, k), found)
        )

    home = boxes.home
    first = stage(_top_k(meet(home), k), "home_neighbors")
    if boxes.only_one:
        best = first
    else:
        bounds = first.filter(F.col("rank") == k)
        bounds = bounds.select("_query", F.col("distance").alias("_bound"))
        searching = home.withColumnRenamed("_box", "_home").join(bounds, "_query", "left")
        further = meet(stage(boxes.visits(searching), "visits"))
        best = _top_k(first.drop("rank").unionByName(further), k)
    return best.select(
        F.col("_query").alias(test_key),
        "rank",
        F.col("_point").alias(train_key),
        "distance",
        F.col("_label").alias(label),
    )


class _Boxes:
    """Points and queries with their boxes, and the search for boxes within a bound."""

    def __init__(
        self, points: DataFrame, queries: DataFrame, features: list[str], sample: np.ndarray,
        n_points: int, block_rows: int, max_boxes: int,
    ):
        self.features = features
        wanted = max(n_points // block_rows, 1)
        self.upper = BoxTree(sample, max(-(-len(sample) // min(wanted, max_boxes)), 1))
        self.regions = wanted > max_boxes  # too many points for the boxes of the upper tree
        number = self.upper.column(features)
        if not self.regions:
            self.points = points.withColumn("_box", number)
            self.home = queries.withColumn("_box", number)
            self.extents = stage(self._extents(self.points, "_box"), "boxes")
            outline = self.extents
        else:
            points = points.withColumn("_region", number)
            rate = min(SAMPLE_PER_BOX / block_rows, 1.0)
            trees = stage(
                points.select("_region", *features)
                .sample(rate, seed=11)
                .groupBy("_region")
                .applyInPandas(_grown(features, SAMPLE_PER_BOX), "_region bigint, _tree binary"),
                "trees",
            )
            # a region without a sampled point is a single box
            some = trees.select("_region")
            rest = points.select("_region").distinct().join(some, "_region", "left_anti")
            single = pickle.dumps(BoxTree(np.zeros((1, len(features))), 1))
            rest = rest.withColumn("_tree", F.lit(single))
            trees = stage(trees.unionByName(rest), "trees")
            self.points = stage(self._located(points, trees), "located_points")
            at_home = queries.withColumn("_region", number)
            self.home = stage(self._located(at_home, trees), "located_queries")
            self.extents = stage(
                self._extents(self.points, "_box").withColumn(
                    "_region", F.floor(F.col("_box") / REGION)
                ),
                "boxes",
            )
            self.trees = stage(
                trees.groupBy("_region")
                .cogroup(self.extents.groupBy("_region"))
                .applyInPandas(_extended(len(features)), "_region bigint, _tree binary"),
                "trees",
            )
            outline = self._extents(self.points.withColumn(
                "_region", F.floor(F.col("_box") / REGION)), "_region")
            outline = outline.withColumnRenamed("_region", "_box")
        # a row per box of the upper tree, at most 2 * max_boxes by its construction
        outline = outline.toPandas()
        sides = [[f"{s}_{i}" for i in range(len(features))] for s in ("low", "high")]
        self.upper.set_extents(outline["_box"].to_numpy(), *(outline[c].to_numpy() for c in sides))
        self.only_one = self.upper.n_boxes == 1 and not self.regions

    def _extents(self, points: DataFrame, by: str) -> DataFrame:
        return points.groupBy(by).agg(
            F.count("*").alias("n"),
            *[F.min(c).alias(f"low_{i}") for i, c in enumerate(self.features)],
            *[F.max(c).alias(f"high_{i}") for i, c in enumerate(self.features)],
        )

    def _located(self, rows: DataFrame, trees: DataFrame) -> DataFrame:
        """Rows with a region: the region replaced by the box."""
        features, kept = self.features, [c for c in rows.columns if c != "_region"]

        def locate(tree: BoxTree, batch: pd.DataFrame) -> pd.DataFrame:
            box = batch["_region"] * REGION + tree.locate(batch[features].to_numpy(float))
            return batch[kept].assign(_box=box)

        schema = T.StructType([*rows.select(*kept).schema.fields, T.StructField("_box", T.LongType())])
        return _through_trees(rows, trees, locate, schema)

    def visits(self, searching: DataFrame) -> DataFrame:
        """(_query, features, _box) for every box but its own that a query has to visit."""
        features, out = self.features, ["_query", *self.features]
        fields = searching.select(*out).schema.fields
        number = T.LongType()
        if not self.regions:
            return searching.mapInPandas(
                _nearby_boxes(self.upper, features, out, "_box"),
                T.StructType([*fields, T.StructField("_box", number)]),
            )
        carried = [*out, "_home", "_bound"]
        regions = searching.mapInPandas(
            _nearby_boxes(self.upper, features, carried, "_region"),
            T.StructType(
                [*searching.select(*carried).schema.fields, T.StructField("_region", number)]
            ),
        )

        def visit(tree: BoxTree, batch: pd.DataFrame) -> pd.DataFrame:
            found = _reached(tree, features, batch)
            found["_box"] = found["_region"] * REGION + found["_reached"]
            return found[found["_box"] != found["_home"]][[*out, "_box"]]

        return _through_trees(
            stage(regions, "region_visits"), self.trees, visit,
            T.StructType([*fields, T.StructField("_box", number)]),
        )


def knn_predict(
    neighbors: DataFrame,
    test_key: str,
    label: str,
    ks: Sequence[int],
    weights: str = "distance",
) -> DataFrame:
    """(``test_key``, k, prediction) for every k from one neighbour table.

    ``distance`` weighs by 1/distance; where a neighbour has distance 0, only such
    neighbours count. ``uniform`` takes the plain mean.
    """
    if weights not in ("distance", "uniform"):
        raise ValueError(f"weights must be distance or uniform, not {weights!r}")
    if test_key in ("k", "rank", "distance", label):
        raise ValueError(f"the key column may not be named {test_key!r}")
    each = neighbors.withColumn("k", F.explode(F.array(*[F.lit(k) for k in ks])))
    each = each.filter(F.col("rank") <= F.col("k"))
    y, d = F.col(f"`{label}`"), F.col("distance")
    if weights == "uniform":
        prediction = F.mean(y)
    else:
        exact = F.mean(F.when(d == 0, y))
        w = F.try_divide(F.lit(1.0), d)
        prediction = F.coalesce(exact, F.try_divide(F.sum(w * y), F.sum(w)))
    return each.groupBy(test_key, "k").agg(prediction.alias("prediction"))
