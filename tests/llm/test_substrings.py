"""Repeated substrings against a dictionary of all windows."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from fieldpanel.llm import substring_dedup as sub


def brute(docs: list[tuple]) -> dict:
    seen: set[bytes] = set()
    want = {}
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is None, d[0] or 0)):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - sub.LENGTH + 1):
            window = data[i : i + sub.LENGTH]
            if window in seen:
                gone[i : i + sub.LENGTH] = True
            seen.add(window)
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        spans = int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())
        want[doc_id] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return want


def test_cover_reaches_every_difference():
    found = {(a - b) % sub.PERIOD for a in sub.COVER for b in sub.COVER}
    assert found == set(range(sub.PERIOD))


@pytest.mark.parametrize("chunk", [4 << 20, 20_000])
def test_equals_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(sub, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(sub, "RANGE_BYTES", 100_000)
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = [tuple(r) for r in rows.collect()]
    docs += [(1001, None), (1002, ""), (1003, "a" * 99), (1004, "a" * 350), (1005, "é" * 200),
             (None, docs[3][1][:300]), (1006, "x" + docs[5][1][10:170] + "y")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    got = {
        r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
        for r in sub.remove_repeats(frame).collect()
    }
    assert got == brute(docs)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert sub.remove_repeats(frame).collect() == []


def test_rows_of_one_identifier_have_a_fixed_order(spark):
    base = "".join(f"{i:04d}" for i in range(90))
    docs = [(5, base[i * 20 :] + str(i) * (i + 1)) for i in range(8)] + [(None, base), (None, base)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    before = {t.name for t in spark.catalog.listTables()}
    runs = [sorted(map(str, sub.remove_repeats(frame).collect())) for _ in range(3)]
    assert runs[0] == runs[1] == runs[2]
    assert {t.name for t in spark.catalog.listTables()} == before
