"""Line deduplication against plain Python, and its undoing."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from fieldpanel.llm import line_dedup as ld
from fieldpanel.llm.cuckoo import CuckooFilter

SCHEMA = "doc_id bigint, text string, row string, k1 int, keys string"
SPACE = " \t\n\v\f\r"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA).repartition(3)


def key_of(line):
    key = "".join(c.lower() if c.isascii() else c for c in line.strip(SPACE))
    return key if len(key) >= 10 else None


def brute(rows, corpus=None):
    """(doc_id, n_lines, n_dropped, kept) of every row, judged against the whole corpus."""
    holders = {}
    for i, text in rows if corpus is None else corpus:
        for line in (text or "").split("\n"):
            holders.setdefault(key_of(line), set()).add(i)
    found = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            ids = holders.get(key_of(line), {i})
            first = min((x for x in ids if x is not None), default=None)
            if key_of(line) is None or len(ids) < 2 or i == first:
                kept.append(line)
        text = "\n".join(kept)
        found.append((i, len(lines), len(lines) - len(kept), text))
    return sorted(found, key=str)


def result(df):
    rows = df.collect()
    for r in rows:
        assert r.kept_sha256 == hashlib.sha256(r.kept.encode()).hexdigest()
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in rows), key=str)


ODD = [
    (1, "A shared line here\nshort\nown line of one"),
    (1, "another text\n  a SHARED line here\t"),
    (2, "a shared line here\nshort\na shared line here"),
    (3, None),
    (4, ""),
    (None, "a shared line here\nonly nulls share this"),
    (None, "only nulls share this\nÄÖÜ äöü äöü"),
    (5, "ÄÖÜ äöü äöü\näöü äöü äöü\n padded line "),
    (6, " padded line \npadded line\n" + "long line " * 100_000),
    (7, "long line " * 100_000 + "\r\n\n\n"),
    (8, "same row of text"),
    (8, "same row of text"),
    (9, "éééééééééé\nééééééééé"),
    (10, "éééééééééé\nééééééééé"),
]


def test_odd_rows(spark):
    got = result(ld.deduplicate(table(spark, ODD), keep_text=True))
    assert got == brute(ODD)


def test_empty_table(spark):
    docs = table(spark, ODD).limit(0)
    assert ld.deduplicate(docs).collect() == []
    index = ld.LineIndex.empty(spark).insert(docs).insert(table(spark, ODD))
    assert result(ld.deduplicate(table(spark, ODD), index, keep_text=True)) == brute(ODD)


def made(seed, ids):
    rng = random.Random(seed)
    lines = [f"line number {n} of the pool" for n in range(60)]
    return [
        (i, "\n".join(rng.choice(lines) if rng.random() < 0.7 else f"own line {i} {rng.random()}"
                      for _ in range(rng.randint(0, 12))))
        for i in ids
    ]


def states(index):
    refs = sorted(tuple(r) for r in index.refs.collect())
    return refs, sorted(tuple(r)[:3] for r in index.postings.collect())


def checked_filters(index):
    """Every key's entries are in its filter."""
    filters = {r.shard: CuckooFilter.read(r.slots, r.stash) for r in index.filters.collect()}
    rows = index.refs.select("k1", "k2", ld.level().alias("level")).collect()
    entries = 0
    for r in rows:
        words = np.array([[r.k1, r.k2]], np.int64).view(np.uint64)
        assert filters[(r.k1 >> 32) % index.shards].count(words)[0] >= r.level
        entries += r.level
    held = sum(int((f.slots > 0).sum()) + len(f.stash) for f in filters.values())
    assert held == entries


@pytest.mark.parametrize("small", [False, True])
def test_insertions_and_deletions_are_reversible(spark, monkeypatch, small):
    if small:  # several shards, several cells for each, filters made anew
        monkeypatch.setattr(ld, "SHARD_KEYS", 8)
        monkeypatch.setattr(ld, "CELL_ROWS", 4)
    one, two = made(1, range(10, 40)), made(2, [*range(0, 10), *range(40, 60)])
    first = ld.LineIndex.empty(spark).insert(table(spark, one))
    both = first.insert(table(spark, two))
    checked_filters(first)
    checked_filters(both)
    assert result(ld.deduplicate(table(spark, one), first, keep_text=True)) == brute(one)
    # smaller ids came later and take lines over
    assert result(ld.deduplicate(table(spark, one), both, keep_text=True)) == brute(one, one + two)
    whole = ld.LineIndex.empty(spark).insert(table(spark, one + two))
    assert states(both) == states(whole)

    gone = spark.createDataFrame([(i,) for i, _ in two] + [(999,), (None,)], "doc_id bigint")
    back = both.delete(gone)
    checked_filters(back)
    assert states(back) == states(first)
    assert result(ld.deduplicate(table(spark, one), back, keep_text=True)) == brute(one)
    half = both.delete(spark.createDataFrame([(i,) for i in range(0, 60, 2)], "doc_id bigint"))
    left = [(i, t) for i, t in one + two if i % 2]
    checked_filters(half)
    assert result(ld.deduplicate(table(spark, left), half, keep_text=True)) == brute(left)
    none = back.delete(table(spark, one))
    assert states(none) == ([], [])
    checked_filters(none)


def test_cuckoo_filter_loses_nothing_and_counts():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 1 << 63, (6000, 2), dtype=np.uint64)
    held = CuckooFilter(2048)  # 8,192 slots for 9,000 entries: it overflows into the stash
    held.add(keys)
    held.add(keys[:3000])
    assert (held.count(keys[:3000]) >= 2).all() and (held.count(keys[3000:]) >= 1).all()
    assert len(held.stash) > 0
    held = CuckooFilter.read(*held.written())
    held.remove(keys[:3000])
    held.remove(keys[3000:])
    assert (held.count(keys[:3000]) >= 1).all()
    assert int((held.slots > 0).sum()) + len(held.stash) == 3000
    held.remove(keys[:3000])
    assert not held.slots.any() and not len(held.stash)


def test_cuckoo_filter_seldom_errs():
    rng = np.random.default_rng(6)
    held = CuckooFilter.sized(20_000)
    held.add(rng.integers(0, 1 << 63, (20_000, 2), dtype=np.uint64))
    other = rng.integers(0, 1 << 63, (100_000, 2), dtype=np.uint64)
    assert (held.count(other) > 0).mean() < 3e-4
    assert len(held.stash) == 0


def test_equal_keys_overflow_into_the_stash():
    same = np.full((20, 2), 7, np.uint64)
    held = CuckooFilter(64)
    held.add(same)
    assert held.count(same[:1])[0] == 20
    held.remove(same[:19])
    assert held.count(same[:1])[0] == 1
