"""The whole pipeline stage by stage against plain Python, and on odd tables."""

from __future__ import annotations

import base64
import hashlib
import re

import pytest
import tiktoken
import xxhash

import corpus_pipeline
from fieldpanel.llm import bpe

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text):
    """Bits set in more than half of the hashes of the three-word shingles."""
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(
        1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
    )


def near_groups(texts):
    """Group number of every text by all pairs of fingerprints."""
    prints = [fingerprint(t) for t in texts]
    root = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3 and root[a] != root[b]:
                old, new = root[a], root[b]
                root = [new if r == old else r for r in root]
    return root


@pytest.fixture(scope="module")
def encoding():
    import public_tokenizers

    with open(public_tokenizers.path(bpe.VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def stages(spark, sf_dir):
    """What went into and came out of every stage, as rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = []
    for name, step in corpus_pipeline.STAGES:
        out = corpus_pipeline.stage(step(spark, docs, sf_dir), f"test_{name}")
        found.append((name, docs.collect(), out.collect(), out.columns))
        docs = out
    return found


def follow(found, encoding, columns, near_target=0.1):
    """Check every stage on its own input; a mix of few documents is as near as they allow."""
    by_name = {name: (before, after, names) for name, before, after, names in found}
    for name, (before, after, names) in by_name.items():
        if name != "tokens":
            assert names == columns
            assert set(after) <= set(before)

    before, after, _ = by_name["exact_dedup"]
    assert sorted(r.text or "" for r in after) == sorted({r.text or "" for r in before})

    before, after, _ = by_name["near_dedup"]
    texts = sorted({r.text or "" for r in before})
    group = dict(zip(texts, near_groups(texts)))
    kept = [group[r.text or ""] for r in after]
    assert sorted(kept) == sorted(set(group.values()))  # a row of every group, no second one

    before, after, _ = by_name["mixture"]
    size = {r: len(WORD.findall(r.text or "")) for r in before}
    assert sum(size[r] for r in after) == pytest.approx(1.5 * sum(size.values()), rel=near_target)

    before, after, _ = by_name["tokens"]
    want = sorted(
        (str(r.doc_id), tuple(encoding.encode_ordinary(r.text or ""))) for r in before
    )
    assert sorted((str(r.doc_id), tuple(r.ids)) for r in after) == want
    assert all(r.intact and r.n_tokens == len(r.ids) for r in after)


def test_stages_on_a_table(spark, encoding):
    found = stages(spark, SF_DIR)
    columns = spark.read.parquet(f"{SF_DIR}/documents.parquet").columns
    follow(found, encoding, columns)
    quality = found[0]
    assert 0 < len(quality[2]) < len(quality[1])
    run = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted((r.doc_id, r.ids_sha256) for r in run) == sorted(
        (r.doc_id, r.ids_sha256) for r in found[-1][2]
    )


NAMES = ["_n", "_doc_id", "_digest", "_row", "_kept_row", "_kept_file", "quality", "digest",
         "_mix_copies", "_range", "size", "fp", "at", "root", "n"]
PROSE = [
    "Most of the visitors came back in autumn, when the harbour was quiet and the light was low.",
    "The second report describes how the water was measured and why the figures were corrected.",
    "He kept the letters in a wooden box and read them again whenever the house was empty.",
]


def written(spark, folder, rows, labels):
    text = ", ".join(f"{n} string" for n in NAMES)
    schema = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {text}"
    docs = spark.createDataFrame([(*r, *NAMES) for r in rows], schema)
    docs.write.parquet(f"{folder}/documents.parquet")
    kind = "doc_id bigint, quality int, toxic int"
    spark.createDataFrame(labels, kind).write.parquet(f"{folder}/labels.parquet")


def test_odd_tables_pass_through_every_stage(spark, encoding, tmp_path):
    long = " ".join(f"word{i}" for i in range(60_000))
    rows = [(i, text, "en", "a", 1) for i, text in enumerate(PROSE * 2)]
    rows += [(None, PROSE[0] + " x", "en", None, 1), (None, PROSE[1] + " more words here", None, "b", 1),
             (3, "ab c", None, None, None), (3, "ab c", None, None, None), (20, None, "en", "a", 0),
             (21, "", "en", "b", 0), (22, long, "de", "b", 0), (22, "Ünï ☃ \x00 code", "de", "b", 0)]
    written(spark, str(tmp_path), rows, [])
    found = stages(spark, str(tmp_path))
    follow(found, encoding, ["doc_id", "text", "lang", "source", "n_chars", *NAMES], 0.5)
    assert len(found[0][2]) == len(rows)  # without labels nothing is rejected


def test_an_empty_table(spark, tmp_path):
    written(spark, str(tmp_path), [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_token_parts_are_bounded_and_whole(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(bpe, "PART_BYTES", 64)
    texts = ["one two three", None, "", "word " * 100, "x"]
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, None, 4, 5], "text": texts})
    coder = bpe.encoder()
    parts = list(bpe.coded(coder, batch, True))
    assert [p.num_rows for p in parts] == [4, 1]
    got = [r for p in parts for r in p.to_pylist()]
    assert [r["doc_id"] for r in got] == [1, 2, None, 4, 5]
    for row, text in zip(got, texts):
        ids = b"".join(i.to_bytes(4, "little") for i in row["ids"])
        assert ids == coder.encode(text or "") and row["n_tokens"] == len(row["ids"])
        assert row["ids_sha256"] == hashlib.sha256(ids).hexdigest()
    bare = list(bpe.coded(coder, batch, False))
    assert [r["n_tokens"] for p in bare for r in p.to_pylist()] == [r["n_tokens"] for r in got]
    assert bare[0].schema.names[-1] == "intact"
