"""Lloyd's centroid clustering of integer vectors with Ptolemaic pivot bounds.

Every vector caches its distances to a few fixed pivots. For a vector q, a centroid c and two
pivots p and s, Ptolemy's inequality gives

    d(q, c) * d(p, s) >= |d(q, p) * d(c, s) - d(q, s) * d(c, p)|,

so each pivot pair bounds d(q, c) from below without reading the vectors. The centroid of
least bound is measured first; a centroid whose bound, rounded down by more than all rounding
errors, exceeds the best distance found is ruled out, and every other one is measured in whole
numbers. The result is therefore exactly that of measuring all of them.

The vectors never move: each round is one pass over a written table, in which a task adds up
its vectors per cluster, and only ``clusters x components`` sums reach the driver.

Defined results: vectors that are null, of another length, or have a null, NaN or infinite
component are left out, and so are those with a component of ``largest(width)`` or more after
scaling (2**27 at 64 components), whose squared distances would not fit a long. Ties go to the smaller cluster. Rows are taken
as they are: equal rows and null ids are kept, each with its result (a null id is hashed as
an empty one; seeds with equal hashes are ordered by their components). Fewer vectors than
clusters give as many clusters as vectors; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fieldpanel.llm.common import stage
from fieldpanel.shipping import ship

PIVOTS = 6
SLACK = 2.0**-44  # far above the relative error of the few float operations of a bound
SLICE = 2048  # vectors measured at a time


def largest(width: int) -> int:
    """Components stay below this, so that the sum of squared differences fits a long."""
    return 1 << (60 - (width - 1).bit_length()) // 2


def squared(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-numbered rows to one point."""
    apart = rows - point
    return np.einsum("ij,ij->i", apart, apart)


def choose_pivots(seeds: np.ndarray, most: int = PIVOTS) -> np.ndarray:
    """Pivots among the seeds, each as far as possible from those before it; no two equal."""
    chosen = [0]
    apart = squared(seeds, seeds[0])
    while len(chosen) < most and apart.max() > 0:
        chosen.append(int(apart.argmax()))
        apart = np.minimum(apart, squared(seeds, seeds[chosen[-1]]))
    return seeds[chosen]


def pivot_distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.column_stack([squared(rows, p) for p in pivots]).astype(np.float64))


@dataclass(frozen=True)
class Index:
    """The centroids of one round beside the fixed pivots."""

    centroids: np.ndarray
    pivots: np.ndarray

    def bounds(self, cached: np.ndarray) -> np.ndarray:
        """Squared lower bounds of the distances to all centroids, rounded down."""
        centre = pivot_distances(self.centroids, self.pivots)
        between = pivot_distances(self.pivots, self.pivots)
        least = np.zeros((len(cached), len(self.centroids)))
        for p, s in combinations(range(len(self.pivots)), 2):
            one = cached[:, p, None] * centre[None, :, s]
            two = cached[:, s, None] * centre[None, :, p]
            bound = (np.abs(one - two) - SLACK * (one + two)) / between[p, s]
            np.maximum(least, bound, out=least)
        return least * least * (1 - SLACK)

    def assign(self, rows: np.ndarray, cached: np.ndarray) -> tuple[np.ndarray, ...]:
        """Nearest centroid, its squared distance, and how many centroids were measured."""
        least = self.bounds(cached)
        seed = least.argmin(axis=1)
        apart = rows - self.centroids[seed]
        best, cluster = np.einsum("ij,ij->i", apart, apart), seed.copy()
        measured = np.ones(len(rows), np.int64)
        for number, centre in enumerate(self.centroids):
            # the best distance is rounded up against the bound
            open_ = (least[:, number] <= best * (1 + SLACK)) & (seed != number)
            at = np.flatnonzero(open_)
            found = squared(rows[at], centre)
            closer = (found < best[at]) | ((found == best[at]) & (number < cluster[at]))
            best[at[closer]], cluster[at[closer]] = found[closer], number
            measured[at] += 1
        return cluster, best, measured


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, SLICE):
        yield batch.slice(at, SLICE)


def _with_pivots(pivots: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in _slices(b)):
            cached = pivot_distances(_matrix(part.column(1), pivots.shape[1], np.int64), pivots)
            ends = np.arange(len(cached) + 1, dtype=np.int32) * len(pivots)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(cached.ravel()))
            yield pa.RecordBatch.from_arrays([*part.columns, lists], ["id", "v", "cached"])

    return run


def _read(part: pa.RecordBatch, index: Index) -> tuple[np.ndarray, np.ndarray]:
    rows = _matrix(part.column("v"), index.centroids.shape[1], np.int64)
    return rows, _matrix(part.column("cached"), len(index.pivots), np.float64)


def _sums(index: Index) -> Callable:
    """Map function: per task and cluster, its rows and the sums of their components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(index.centroids), np.int64)
        total = np.zeros(index.centroids.shape, np.int64)
        for part in (p for b in batches for p in _slices(b)):
            rows, cached = _read(part, index)
            cluster, _, _ = index.assign(rows, cached)
            order = np.argsort(cluster, kind="stable")
            names, starts = np.unique(cluster[order], return_index=True)
            total[names] += np.add.reduceat(rows[order], starts)
            n += np.bincount(cluster, minlength=len(n))
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(some, pa.int32()),
                pa.array(n[some]),
                pa.array(list(total[some]), pa.list_(pa.int64())),
            ],
            ["cluster", "n", "sums"],
        )

    return run


def _assigned(index: Index) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for b in batches for p in _slices(b)):
            cluster, best, measured = index.assign(*_read(part, index))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array(cluster, pa.int32()),
                    pa.array(best),
                    pa.array(measured, pa.int32()),
                ],
                ["id", "cluster", "distance", "measured"],
            )

    return run


def _moved(table: DataFrame, index: Index) -> np.ndarray:
    """The centroids after one round: exact floors of the means, empty clusters as before."""
    each = table.select("v", "cached").mapInArrow(
        _sums(index), "cluster int, n bigint, sums array<bigint>"
    )
    exact = "decimal(38,0)"
    found = (
        each.select("cluster", "n", F.posexplode("sums").alias("axis", "s"))
        .groupBy("cluster", "axis")
        .agg(F.sum(F.col("n").cast(exact)).alias("n"), F.sum(F.col("s").cast(exact)).alias("s"))
        .collect()  # clusters x components rows
    )
    centroids = index.centroids.copy()
    for row in found:
        centroids[row["cluster"], row["axis"]] = int(row["s"]) // int(row["n"])
    return centroids


@dataclass(frozen=True)
class Clustering:
    """``assigned`` has (id, cluster, distance, measured) of every vector kept."""

    assigned: DataFrame
    centroids: np.ndarray


def whole_vectors(df: DataFrame, vec_id: str, vector: str, width: int, scale: float) -> DataFrame:
    """(id, v): the usable vectors with each component x as floor(scale * x)."""
    scaled = F.transform(F.col(f"`{vector}`"), lambda x: F.floor(x.cast("double") * F.lit(scale)))
    usable = F.forall(
        F.col(f"`{vector}`"),
        lambda x: F.coalesce(F.abs(x.cast("double") * F.lit(scale)) < F.lit(largest(width)), F.lit(False)),
    )
    kept = df.where((F.size(F.col(f"`{vector}`")) == width) & usable)
    return kept.select(F.col(f"`{vec_id}`").alias("id"), scaled.cast("array<int>").alias("v"))


def cluster_vectors(
    df: DataFrame,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    width: int = 64,
    scale: float = 256.0,
    clusters: int = 40,
    rounds: int = 5,
    salt: str = "2:",
) -> Clustering:
    """Cluster the vectors of ``df``.

    The first centroids are the vectors whose id, after ``salt``, has the least SHA-256
    digests. ``clusters * width`` numbers are held on the driver and sent to every task.
    """
    spark = df.sparkSession
    ship(spark)
    vectors = whole_vectors(df, vec_id, vector, width, scale)
    name = F.concat(F.lit(salt), F.coalesce(F.col("id").cast("string"), F.lit("")))
    seeds = vectors.select(F.sha2(name, 256).alias("digest"), "v").orderBy("digest", "v")
    first = np.array([row["v"] for row in seeds.limit(clusters).collect()], np.int64)
    if not len(first):
        kind = vectors.schema["id"].dataType.simpleString()
        empty = f"id {kind}, cluster int, distance bigint, measured int"
        return Clustering(spark.createDataFrame([], empty), first.reshape(0, width))
    index = Index(first, choose_pivots(first))
    kind = vectors.schema["id"].dataType.simpleString()
    table = stage(
        vectors.mapInArrow(
            _with_pivots(index.pivots), f"id {kind}, v array<int>, cached array<double>"
        ),
        "vectors",
    )
    for _ in range(rounds):
        centroids = _moved(table, index)
        if np.array_equal(centroids, index.centroids):
            break  # further rounds would change nothing
        index = Index(centroids, index.pivots)
    found = table.mapInArrow(
        _assigned(index), f"id {kind}, cluster int, distance bigint, measured int"
    )
    return Clustering(stage(found, "clusters"), index.centroids)


def described(found: Clustering) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, measured).

    An inertia that does not fit a long is null.
    """
    spark = found.assigned.sparkSession
    per_cluster = (
        found.assigned.groupBy("cluster")
        .agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
        .collect()  # one row per cluster
    )
    whole = sum(int(row["s"]) for row in per_cluster)
    rows = [
        (row["cluster"], *(v if v < 1 << 63 else None for v in (int(row["s"]), whole)), digest)
        for row in per_cluster
        for digest in [
            hashlib.sha256(",".join(map(str, found.centroids[row["cluster"]])).encode()).hexdigest()
        ]
    ]
    about = spark.createDataFrame(
        rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    return found.assigned.join(F.broadcast(about), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia",
        "centroid_sha256", "measured",
    )
