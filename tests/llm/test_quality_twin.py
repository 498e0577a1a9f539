"""Features, priors and posteriors of the quality classifier against plain Python."""

from __future__ import annotations

import math
from collections import defaultdict

import pytest
import regex

from fieldpanel.llm import quality

SF_DIR = "/root/testdata/sf0.001"
EDGE = 1e-4


def plain_features(text):
    text = text or ""
    n = max(len(text), 1)
    words = [w for w in regex.split(r"[\x20\x09-\x0D]+", text.lower()) if w]
    lines = [line for line in text.split("\n") if line]
    w = max(len(words), 1)

    def left(pattern):
        return len(regex.sub(pattern, "", text)) / n

    return [
        math.log1p(len(words)),
        len(text) / w,
        len(set(words)) / w,
        len(set(lines)) / max(len(lines), 1),
        left(r"[^\p{Lu}]+"),
        left(r"[\p{L}\p{N}\s.,;:'\"()-]+"),
        left(r"[^\p{N}]+"),
        sum(a == b for a, b in zip(words, words[1:])) / w,
    ]


def strength(between, mean):
    return min(max(mean * (1 - mean) / between - 1, 1.0), 1e6) if between > 0 else 1e6


def logit(p):
    p = min(max(p, EDGE), 1 - EDGE)
    return math.log(p / (1 - p))


def plain_scores(rows, weights):
    """(classifier, host, path, posterior) per (doc_id, text, host, path)."""
    own = [
        weights[0] + sum(w * x for w, x in zip(weights[1:], plain_features(text)))
        for _, text, _, _ in rows
    ]
    chance = [1 / (1 + math.exp(-o)) for o in own]
    paths, hosts = defaultdict(lambda: [0, 0.0]), defaultdict(lambda: [0, 0.0])
    for (_, _, host, path), p in zip(rows, chance):
        for site in (paths[host, path], hosts[host]):
            site[0] += 1
            site[1] += p
    mean = min(max(sum(chance) / len(rows), EDGE), 1 - EDGE)

    def between(sites):
        return sum((g / n - m) ** 2 - m * (1 - m) / n for n, g, m in sites) / len(sites)

    host_strength = strength(between([(n, g, mean) for n, g in hosts.values()]), mean)
    rate = {
        h: (g + host_strength * mean) / (n + host_strength) for h, (n, g) in hosts.items()
    }
    path_strength = strength(between([(n, g, rate[h]) for (h, _), (n, g) in paths.items()]), mean)
    found = []
    for (_, _, host, path), o, p in zip(rows, own, chance):
        n, good = paths[host, path]
        prior = path_strength * rate[host]
        others = (prior + good - p) / (path_strength + n - 1)
        posterior = 1 / (1 + math.exp(-(o + logit(others) - logit(mean))))
        found.append((p, rate[host], (prior + good) / (path_strength + n), posterior))
    return found


@pytest.mark.parametrize("extra", [False, True])
def test_scores_equal_a_plain_twin(spark, extra):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select(
        "doc_id", "text", "source", "lang"
    )
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    if extra:  # sparse, null and repeated sites, empty and long texts
        odd = [(9001, None, None, None), (9002, "", "rare", "xx"), (9003, "A! " * 40_000, None, "en"),
               (9004, "same 1", "rare", None), (9004, "same 1", "rare", None), (None, "x", "rare", "xx")]
        docs = docs.unionAll(spark.createDataFrame(odd, docs.schema))
    weights = quality.fit(docs, labels, "doc_id", "text", quality.FIT_ROWS)
    rows = [tuple(r) for r in docs.collect()]
    want = sorted(
        (str(r[0]), str(r[1])[:50], len(r[1] or ""), s)
        for r, s in zip(rows, plain_scores(rows, weights))
    )
    got = sorted(
        (str(r.doc_id), str(r.text)[:50], len(r.text or ""),
         (r.quality.classifier, r.quality.host, r.quality.path, r.quality.posterior))
        for r in quality.score(docs, labels).collect()
    )
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:3] == b[:3]
        assert a[3] == pytest.approx(b[3], rel=1e-6, abs=1e-9)


def test_reruns_and_other_partitions_agree_to_the_last_bit(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    runs = [
        sorted(map(str, quality.score(d, labels, columns=["doc_id"]).collect()))
        for d in (docs, docs.repartition(7), docs.repartition(13, "lang"))
    ]
    assert runs[0] == runs[1] == runs[2]


def test_columns_that_clash_with_the_operator(spark):
    names = ["_own", "_path", "_host", "_of_host", "_of_path", "host", "path", "n", "good", "units"]
    kind = ", ".join(f"`{n}` string" for n in names)
    rows = [(i, "some words here", "en", "a", *names) for i in range(4)]
    docs = spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, {kind}")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id bigint, quality int")
    scored = quality.score(docs, labels)
    assert scored.columns == [*docs.columns, "quality"] and scored.count() == 4
    kept = quality.keep_good(docs.withColumnRenamed("n", "quality"), labels)
    assert kept.columns == docs.withColumnRenamed("n", "quality").columns
    assert {r.quality for r in kept.collect()} <= {"n"}
