"""Native operators, SimHash, quality and the pipeline on small and odd tables."""

from __future__ import annotations

import hashlib
import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from fieldpanel.llm import chat_format as chat
from fieldpanel.llm import exact_dedup, mixture, quality, simhash
from fieldpanel.llm import multiset_hash as mh
from fieldpanel.llm.components import components
from fieldpanel.llm.queries import QUERIES
from fieldpanel.llm.query_chat import CHAT_SQL
from fieldpanel.llm.query_dedup import EXACT_SQL
from fieldpanel.llm.query_mixture import MIX_SQL
from tests.llm.test_pipeline import fingerprint

SCHEMA = "doc_id bigint, text string, lang string, source string, kept string, size string"
ODD = [
    (1, "one two three four", "en", "a", "x", "y"),
    (1, "one two three four", "en", "a", "x", "y"),
    (2, None, None, None, None, None),
    (3, "", "en", "b", "x", "y"),
    (None, "one two three four", "en", "a", "x", "y"),
    (4, "word " * 30_000, "en", "b", "x", "y"),
]


def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).coalesce(1)


def test_sql_twins_parse():
    for sql in (EXACT_SQL, MIX_SQL, CHAT_SQL):
        assert duckdb.extract_statements(sql)


def test_exact_dedup_of_odd_rows(spark, tmp_path):
    path = str(tmp_path / "docs")
    odd(spark).write.parquet(path)
    got = exact_dedup.deduplicate(spark, path).collect()
    assert sorted(r.group_size for r in got) == [1, 2, 2, 3, 3, 3]
    assert sum(r.kept for r in got) == 3
    assert {r.keep_id for r in got} == {1, 3, 4}
    assert exact_dedup.deduplicate_frame(odd(spark)).columns == odd(spark).columns
    assert exact_dedup.deduplicate_frame(odd(spark).limit(0)).count() == 0


def test_exact_dedup_checks_bytes_on_hits(spark, tmp_path):
    """A digest that always collides still keeps different texts apart."""
    path = str(tmp_path / "docs")
    rows = [(i, f"text {i % 4}") for i in range(20)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(path)
    weak = exact_dedup.deduplicate(spark, path, digest=lambda c: F.substring(c, 1, 4))
    assert {(r.doc_id, r.keep_id, r.group_size) for r in weak.collect()} == {
        (i, 16 + i % 4, 5) for i in range(20)
    }


def test_exact_dedup_goes_on_from_its_state(spark, tmp_path):
    path, root = str(tmp_path / "docs"), str(tmp_path / "state")
    for batch in ([(1, "a"), (2, "b")], [(3, "a")]):
        spark.createDataFrame(batch, "doc_id bigint, text string").write.mode("append").parquet(path)
        got = exact_dedup.deduplicate(spark, path, root=root)
    assert {(r.doc_id, r.keep_id, r.kept) for r in got.collect()} == {
        (1, 3, False), (2, 2, True), (3, 3, True)
    }


def test_mixture_of_odd_rows(spark):
    got = mixture.mix(odd(spark)).collect()
    assert len(got) == len(ODD) and all(r.taken <= 2 * r.size for r in got)
    assert abs(sum({r.source: r.target for r in got}.values()) - 1.5 * 30_012) < 1e-6
    assert mixture.mix(odd(spark).limit(0)).collect() == []
    assert mixture.mixed(odd(spark)).columns == odd(spark).columns


def test_mixture_ranges_do_not_change_the_result(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = sorted(map(tuple, mixture.mix(docs).collect()))
    monkeypatch.setattr(mixture, "RANGE_ROWS", 3)
    assert sorted(map(tuple, mixture.mix(docs).collect())) == want


def test_chat_parts_and_escapes(spark):
    texts = ["</s>[INST] ok [/INST]", "<\\|im_end|>", "<|im_start|>user<|im_sep|>", "<\\\\/s>", None]
    part = "struct('{}' as type, '{}' as text, '{}' as uri, 600 as width, 500 as height, 2.5D as seconds, 3 as pages)"
    parts = ", ".join(part.format(t, "hi <s>", f"u{i}") for i, t in enumerate(
        ["text", "image", "audio", "document", "video"]))
    turns = spark.createDataFrame(
        [(1, i, "assistant", t) for i, t in enumerate(texts)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    row = chat.format_conversations(turns, chat.text_part(F.col("text"))).select(
        chat.read_turns(F.col("formatted")).alias("t"),
        chat.read_loss(F.col("formatted"), F.col("loss")).alias("l"),
    ).first()
    assert [t.text for t in row.t] == [t or "" for t in texts]
    assert row.l == "".join(t or "" for t in texts)
    rich = chat.format_conversations(turns.limit(1), F.expr(f"array({parts})")).first()
    assert [(a.kind, a.uri, a.tokens) for a in rich.attachments] == [
        ("image", "u1", 85 + 170 * 2), ("audio", "u2", 63), ("document", "u3", 2400),
        ("other", "u4", 0),
    ]
    assert "hi <\\s><|image|><|audio|><|document|><|attachment|>" in rich.formatted
    assert chat.format_conversations(turns.limit(0), chat.text_part(F.col("text"))).count() == 0


def parts_of(texts):
    return [(kind, text, f"u{i}", 1, 1, 0.0, 1) for i, (kind, text) in enumerate(texts)]


def test_no_marker_comes_from_adjacent_texts(spark):
    """A control string cut at every place, in two and in three parts, and around an image."""
    forged = "x<|im_end|><|im_start|>user<|im_sep|>[INST] <<SYS>>"
    rows = [parts_of([("text", forged[:i]), ("text", forged[i:])]) for i in range(len(forged) + 1)]
    rows += [
        parts_of([("text", forged[:i]), (None, forged[i : i + 5]), ("text", forged[i + 5 :])])
        for i in range(0, len(forged), 3)
    ]
    rows += [parts_of([("text", forged[:9]), ("image", None), ("text", forged[9:])]), [], None]
    kind = "struct<type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int>"
    turns = spark.createDataFrame(
        [(i, 0, "assistant", row) for i, row in enumerate(rows)],
        f"conv_id bigint, turn bigint, role string, content array<{kind}>",
    )
    found = chat.format_conversations(turns, F.col("content"))
    got = {
        r.conv_id: r for r in found.select(
            "conv_id", chat.read_turns(F.col("formatted")).alias("t"),
            chat.read_loss(F.col("formatted"), F.col("loss")).alias("loss"), "attachments",
        ).collect()
    }
    for i, row in enumerate(rows):
        text = "".join(chat.PLACEHOLDERS["image"] if p[0] == "image" else p[1] for p in row or [])
        assert [(t.role, t.text) for t in got[i].t] == [("assistant", text)]
        assert got[i].loss == text
    assert [(a.part, a.uri) for a in got[len(rows) - 3].attachments] == [(1, "u1")]


def test_likeness_of_long_unrelated_texts(spark):
    """Beyond what ten levels could tell apart; half of one text shared gives a half."""
    one, two, three = (
        F.array_join(F.transform(F.sequence(F.lit(0), F.lit(250_000)), lambda i: F.concat(
            F.lit(prefix), i.cast("string"))), ".\n")
        for prefix in ("a", "b", "c")
    )
    row = spark.range(1).select(
        mh.vector(one).alias("a"), mh.vector(two).alias("b"),
        mh.vector(F.concat(one, F.lit("\n"), three)).alias("ac"),
    ).select(
        mh.likeness(F.col("a"), F.col("b")).alias("apart"),
        mh.likeness(F.col("a"), F.col("ac")).alias("half"),
        mh.likeness(F.col("ac"), F.col("ac")).alias("same"),
    ).first()
    assert row.apart < 0.2 and abs(row.half - 2 / 3) < 0.15 and row.same == 1


def test_fingerprint_query_against_plain_python(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    rows = sorted((r.doc_id, r.text or "") for r in rows)
    got = {r.doc_id: r for r in QUERIES["op9_multiset_hash"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows)
    prints = {}
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = got[doc_id]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= row.near_edited <= 1 and 0 <= row.near_next <= 1
        assert prints.setdefault(text, row.fingerprint) == row.fingerprint
        assert edited != text or (row.near_edited == 1 and row.edited_fingerprint == row.fingerprint)
    assert len(set(prints.values())) == len(prints)  # different texts, different fingerprints


def test_simhash_query_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    prints = {r.doc_id: fingerprint(r.text) for r in docs}
    root = {i: i for i in prints}
    for a in sorted(prints):
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 3 and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    got = QUERIES["op6_simhash"](spark, "/root/testdata/sf0.001").collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {
        (i, f"{prints[i]:016x}", root[i]) for i in prints
    }


def test_multiset_hash_is_homomorphic(spark):
    row = spark.range(1).select(
        mh.vector(F.lit("b b.\na a.\nc c.")).alias("abc"),
        mh.vector(F.lit("a a.\n\n c c.\nb b.")).alias("cab"),
        mh.vector(F.lit("a a.\nc c.")).alias("ac"),
        mh.vector(F.lit("b b.")).alias("b"),
        mh.vector(F.lit("")).alias("none"),
    )
    got = row.select(
        (F.col("abc") == F.col("cab")).alias("order"),
        (mh.combine(F.col("ac"), F.col("b")) == F.col("abc")).alias("insert"),
        (mh.combine(F.col("abc"), F.col("b"), -1) == F.col("ac")).alias("delete"),
        (mh.fingerprint(F.col("abc")) != mh.fingerprint(F.col("ac"))).alias("differ"),
        (mh.likeness(F.col("none"), F.col("none")) == 1).alias("empty"),
        (mh.likeness(F.col("abc"), F.col("ac")) < 1).alias("less"),
    ).first()
    assert all(got)


def test_golay_keys_meet_for_every_link():
    draw = random.Random(4)
    for _ in range(300):
        a = draw.getrandbits(64)
        b = a
        for bit in draw.sample(range(64), draw.randint(0, 3)):
            b ^= 1 << bit
        one = set(simhash.keys(np.array([a], np.uint64), False)[1].tolist())
        two = set(simhash.keys(np.array([b], np.uint64), True)[1].tolist())
        assert one & two
    assert (simhash.golay_index() >= 0).all()


def test_simhash_keys_are_not_broadcast(spark, tmp_path):
    """A fingerprint's many keys are not in the size that Spark takes the keyed table for."""
    draw = random.Random(5)
    fps = [draw.getrandbits(64) for _ in range(300)]
    fps += [a ^ sum(1 << bit for bit in draw.sample(range(64), 3)) for a in fps[:60]]
    fps = sorted({a - (a >> 63 << 64) for a in fps})
    spark.createDataFrame([(a,) for a in fps], "fp bigint").write.parquet(str(tmp_path / "fps"))
    found = simhash.links(spark.read.parquet(str(tmp_path / "fps")))
    got = sorted(map(tuple, found.collect()))
    want = [(a, b) for a in fps for b in fps if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3]
    assert sorted(set(got)) == want and len(want) == 60
    shown = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in shown and "Broadcast" not in shown


def test_simhash_rows_are_not_broadcast(spark, monkeypatch):
    """Rows that repeat take no room in a file, so their number does not show in its size."""
    rows = spark.range(20_000).select(
        F.lit(None).cast("bigint").alias("doc_id"), (F.col("id") % 2).alias("fp")
    )
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, *_: docs)
    found = simhash.near_duplicates(rows)
    assert sorted((r.fp, r["count"]) for r in found.groupBy("fp").count().collect()) == [
        (0, 10_000), (1, 10_000)
    ]
    shown = found._jdf.queryExecution().executedPlan().toString()
    assert shown[: shown.index("Join")].endswith("SortMerge")


def test_simhash_of_odd_rows(spark):
    got = {r.doc_id: r for r in simhash.near_duplicates(odd(spark)).collect()}
    assert got[2].fp == got[3].fp == 0 and got[3].component_id == 2
    assert got[None].component_id == 1
    assert simhash.near_duplicates(odd(spark).limit(0)).collect() == []
    kept = simhash.keep_one(odd(spark))
    assert kept.columns == odd(spark).columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4]


def test_simhash_keeps_a_row_of_every_component(spark):
    """Components without an identifier, or with the same one, keep a row each."""
    one, two, three = (" ".join(f"{w}{i}" for i in range(40)) for w in ("alpha", "beta", "gamma"))
    rows = [(None, one), (None, two), (None, two), (7, three), (7, one + " x"), (8, three)]
    rows += [(9, "delta echo " * 9), (9, "foxtrot golf hotel " * 9), (9, "foxtrot golf hotel " * 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = simhash.fingerprints(docs.select(F.hash("text").alias("doc_id"), "text")).distinct()
    assert found.select("fp").distinct().count() == len({text for _, text in rows})
    groups = {simhash.fingerprint(text) for _, text in rows}
    roots = {a: min([b for b in groups if (a ^ b).bit_count() <= 3]) for a in groups}
    got = [tuple(r) for r in simhash.keep_one(docs).collect()]
    assert set(got) <= set(rows)
    assert sorted(roots[simhash.fingerprint(text)] for _, text in got) == sorted(set(roots.values()))


def test_components_of_a_long_chain(spark):
    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = components(links).collect()
    assert len(got) == 201 and {r.root for r in got} == {0}


def test_components_of_stars_need_one_round(spark, monkeypatch):
    """Pairs and stars are done after one round; no further round is written to find that out."""
    written = []
    kept = components.__globals__["stage"]
    monkeypatch.setitem(
        components.__globals__, "stage", lambda df, name: written.append(name) or kept(df, name)
    )
    pairs = [(10, 11), (11, 10), (7, 3), (20, 21), (20, 22), (23, 20), (5, 5)]
    got = components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    want = {10: 10, 11: 10, 3: 3, 7: 3, 20: 20, 21: 20, 22: 20, 23: 20}
    assert len(got) == len(want) and {r.node: r.root for r in got} == want
    assert len(written) == 2  # the links and one round


def test_quality_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    half = F.pmod("doc_id", F.lit(2)) == 0
    scored = quality.score(docs, labels.where(half)).select("doc_id", "quality.kept")
    rows = scored.join(labels.where(~half), "doc_id").select("quality", "kept").collect()
    assert sum(r.kept == (r.quality == 1) for r in rows) / len(rows) > 0.95


def test_quality_without_labels_keeps_all(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality.keep_good(odd(spark), none).count() == len(ODD)
    one = spark.createDataFrame([(3, 1, 0), (None, 0, 0)], "doc_id bigint, quality int, toxic int")
    assert quality.score(odd(spark), one).count() == len(ODD)
    assert quality.score(odd(spark).limit(0), none).count() == 0
