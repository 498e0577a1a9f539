"""Water level, key ranges and copies of repeated rows of the mixture."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldpanel.llm import exact_dedup, mixture


def plain_targets(sizes, weights, share, cap):
    """Targets by dealing what exceeds a cap again, round by round."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, target, free = share * sum(sizes.values()), {}, set(order)
    while free:
        total = sum(weight[s] for s in free)
        full = {s for s in free if left * weight[s] / total >= cap * sizes[s]}
        if not full:
            return target | {s: left * weight[s] / total for s in free}
        for s in full:
            target[s] = cap * sizes[s]
        left, free = left - sum(target[s] for s in full), free - full
    return target


@pytest.mark.parametrize("share, cap", [(1.5, 2.0), (0.4, 2.0), (1.9, 2.0), (2.5, 2.0), (1.0, 1.1)])
def test_one_pass_level_equals_dealing_by_rounds(spark, share, cap):
    sizes = {f"s{i:03d}": (i * 7919) % 1009 * (1 + i % 5) for i in range(200)}
    sizes |= {None: 4000, "zero": 0}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixture.targets(frame, (3, 1, 2), share, cap).collect()}
    assert got == pytest.approx(plain_targets(sizes, (3, 1, 2), share, cap))


def test_targets_of_no_sources_and_of_no_words(spark):
    kind = "source string, source_size bigint"
    assert mixture.targets(spark.createDataFrame([], kind), (3, 1, 2), 1.5, 2.0).collect() == []
    zero = spark.createDataFrame([("a", 0), (None, 0)], kind)
    assert {r.target for r in mixture.targets(zero, (3, 1, 2), 1.5, 2.0).collect()} == {0.0}


@pytest.mark.parametrize("weight", ["0.001D", "1D", "if(id % 3 = 0, 0.002D, 0.9D)", "id % 50 + 0.5D"])
def test_ranges_hold_alike_many_rows_for_any_weights(spark, weight):
    rows = spark.range(20_000).withColumn("w", F.expr(weight))
    keyed = rows.select(
        mixture.sampling_key(F.col("id"), F.col("w"), 7).alias("k"),
        mixture.weight_bucket(F.col("w")).alias("bucket"),
    )
    shares = keyed.groupBy("bucket").agg((F.count(F.lit(1)) / 20_000).alias("share"))
    curve = shares.agg(F.array_sort(F.collect_list(F.struct("bucket", "share"))).alias("curve"))
    placed = keyed.crossJoin(curve).select(
        F.least(F.floor(mixture.share_below(F.col("k"), F.col("curve")) * 20), F.lit(19)).alias("r")
    )
    counts = Counter(r.r for r in placed.collect())
    assert set(counts) == set(range(20)) and max(counts.values()) < 3 * 1000


def test_repeated_rows_take_what_the_plan_gives(spark):
    """Rows alike in identifier and text: their copies are each row's own, none is rounded up."""
    rows = [(1, "one two three", "a", "x")] * 9 + [(i, f"w{i} v", "b", "y") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, _mix_file string")
    planned = sum(r.taken for r in mixture.mix(docs).collect())
    out = mixture.mixed(docs)
    assert out.columns == docs.columns
    taken = sum(len(r.text.split()) for r in out.collect())
    assert taken == pytest.approx(planned, abs=3)
    assert taken == pytest.approx(1.5 * (27 + 80), abs=5)


def test_mixed_rows_follow_the_plan_without_a_shuffle_of_texts(spark):
    """Every row as often as the plan says, though the plan is too large to broadcast."""
    docs = spark.range(40_000).select(
        F.col("id").alias("doc_id"),
        F.expr("repeat(concat('w', id % 7, ' '), int(id % 5))").alias("text"),
        F.expr("if(id % 4 = 0, null, concat('s', id % 4))").alias("source"),
    )
    key = F.struct("doc_id", F.xxhash64("text").alias("d"))
    plan = mixture.mix(docs.withColumn("doc_id", key)).collect()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        out = mixture.mixed(docs)
        got = Counter(r.doc_id for r in out.collect())
        shown = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == Counter({r.doc_id.doc_id: r.copies for r in plan if r.copies})
    assert len({r.copies for r in plan}) > 1
    assert "hashpartitioning" not in shown


def test_hot_text_is_dealt_over_tasks(spark, tmp_path):
    """A text that holds half of all rows, with weak digests too; results as counted plainly."""
    texts = ["hot"] * 300 + [f"cold {i % 150}" for i in range(300)] + [None, "", "hot!"]
    rows = list(enumerate(texts))
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6).write.parquet(path)
    size = Counter(t or "" for t in texts)
    keep = {t or "": i for i, t in rows}
    want = {(i, keep[t or ""], size[t or ""], keep[t or ""] == i) for i, t in rows}
    for digest in (exact_dedup.sha256, lambda c: F.substring(c, 1, 3)):
        got = exact_dedup.deduplicate(spark, path, digest=digest)
        assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got.collect()} == want
        assert got.count() == len(rows)
