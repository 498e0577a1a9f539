"""Base spans against the plain patterns, disclosure against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldpanel.llm import pii
from fieldpanel.llm.query_pii import op4

SF_DIR = "/root/testdata/sf0.001"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def valid(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def base(text: str | None) -> list[str]:
    return [
        f"{kind}:{m.start()}:{m.end()}"
        for kind, pattern in PLAIN.items()
        for m in re.finditer(pattern, text or "")
        if valid(kind, m.group())
    ]


def odd_texts() -> list[str | None]:
    draw = random.Random(3)
    pieces = ["a@b.c", "x_@y-z.co.uk", "_q@r.s", "1.2.3.4", "999.1.1.1", "001.002.3.255", "5.6",
              "4644348398010899", "4111 1111-1111 1111", "+1 (706) 555-3138", "+49.", "é", "🙂",
              " ", "-", ".", "@", "\n", "12", "+", "%", "word", "1234567890123456789012"]
    made = ["".join(draw.choice(pieces) for _ in range(draw.randint(0, 14))) for _ in range(3000)]
    return [None, "", "a" * 30_000, "1" * 30_000, "1 " * 12_000, "+1" * 10_000, "a.b@" * 6_000,
            "a@b.c " * 3000, *made]


def test_base_spans_equal_the_plain_patterns(spark):
    texts = odd_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    spans = pii.base_spans(F.coalesce("text", F.lit("")))
    for row in docs.select("doc_id", spans.alias("s")).collect():
        got = [f"{s.kind}:{s.start}:{s.end}" for s in row.s]
        assert got == base(texts[row.doc_id]), repr(texts[row.doc_id])[:200]


@pytest.fixture(scope="module")
def found(spark):
    return {r.doc_id: r for r in op4(spark, SF_DIR).collect()}


def test_query_contract(spark, found):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(rows)
    for doc_id, text in rows:
        want, got = base(text), found[doc_id]
        assert got.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert got.spans.split(",")[: len(want)] == want or not want
        for kind in PLAIN:
            assert got[f"n_{kind}"] == sum(w.startswith(kind) for w in want)


def test_disclosure_against_brute_force(spark):
    draw = random.Random(8)
    common = ["alpha", "beta", "gamma", "delta"]
    texts = []
    for i in range(60):
        words = [draw.choice(common) for _ in range(12)]
        if i % 3 == 0:
            words[6:6] = ["zebra", "a@b.co", draw.choice(common)]
        texts.append(" ".join(words))
    texts.append("zebra far away from it: " + "alpha " * 30 + "write to a@b.co, please")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {
        (r.doc_id, s.start, s.end)
        for r in pii.find(docs).collect() for s in r.spans if s.kind == "term"
    }
    assert got == brute_terms(texts)
    # wherever the word stands in a text that mentions the address, and nowhere else
    assert {texts[i][a:b] for i, a, b in got} == {"zebra"} and len(got) == 21
    clean = pii.find(docs, keep_text=True).select("text", pii.redact(F.col("text"), F.col("spans")))
    assert not any("zebra" in r[1] or "@" in r[1] for r in clean.collect())


def brute_terms(texts, window=80):
    """Term spans of texts whose only base spans are emails."""
    corpus = Counter(w for t in texts for w in re.findall(r"\w{3,}", t.lower()))
    total, both, mentioned = sum(corpus.values()), Counter(), {}
    for i, text in enumerate(texts):
        spans = [(m.start(), m.end(), m[0].lower()) for m in re.finditer(PLAIN["email"], text)]
        mentioned[i] = {re.sub(r"\W", "", e) for _, _, e in spans}
        for t in re.finditer(r"\w{3,}", text):
            if any(t.start() < b and a < t.end() for a, b, _ in spans):
                continue
            for e in {re.sub(r"\W", "", e) for a, b, e in spans
                      if t.start() < b + window and t.end() > a - window}:
                both[e, t[0].lower()] += 1
    size = Counter()
    for (e, _), n in both.items():
        size[e] += n
    told = set()
    for (e, t), n in both.items():
        table = [(n, size[e] * corpus[t] / total)]
        table.append((size[e] - n, size[e] - table[0][1]))
        table.append((corpus[t] - n, corpus[t] - table[0][1]))
        table.append((total - size[e] - corpus[t] + n, total - size[e] - corpus[t] + table[0][1]))
        ratio = 2 * sum(o * math.log(o / x) for o, x in table if o > 0 and x > 0)
        share = math.log2(n * total / (size[e] * corpus[t])) / math.log2(total / size[e])
        if n > table[0][1] and ratio >= 10.83 and share >= 0.9:
            told.add((e, t))
    found = set()
    for i, text in enumerate(texts):
        spans = [m.span() for m in re.finditer(PLAIN["email"], text)]
        for t in re.finditer(r"\w{3,}", text):
            if any((e, t[0].lower()) in told for e in mentioned[i]) and not any(
                t.start() < b and a < t.end() for a, b in spans
            ):
                found.add((i, *t.span()))
    return found


@pytest.mark.parametrize("few", [64, 0])
def test_terms_against_brute_force_on_prose(spark, monkeypatch, few):
    monkeypatch.setattr(pii, "FEW", few)
    draw = random.Random(12)
    words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7))) for _ in range(400)]
    texts = []
    for i in range(120):
        text = [draw.choice(words) for _ in range(draw.randint(0, 80))]
        for _ in range(draw.choice([0, 0, 1, 2])):
            who = draw.randint(0, 9)
            at = draw.randint(0, len(text))
            text[at:at] = [f"Secret{who}", f"user{who}@mail.org", "x" * draw.choice([3, 200])]
        texts.append(" ".join(text))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = {
        (r.doc_id, s.start, s.end)
        for r in pii.find(docs).collect() for s in r.spans if s.kind == "term"
    }
    assert got == brute_terms(texts) and len(got) > 50


def test_a_text_of_very_many_mentions_ends(spark):
    """Neither the search nor the redaction takes the product of text and mentions."""
    many = " ".join(f"w{i} a{i}@b.co" for i in range(16_000))
    docs = spark.createDataFrame([(1, many), (2, "plain")], "doc_id bigint, text string")
    found = pii.find(docs, keep_text=True)
    row = found.select(
        "doc_id", F.size("base").alias("n"),
        F.length(pii.redact(F.col("text"), F.col("base"))).alias("left"),
    ).orderBy("doc_id").collect()[0]
    assert row.n == 16_000
    assert row.left == sum(len(f"w{i} [email] ") for i in range(16_000)) - 1


def test_redaction_of_overlapping_and_generalised_spans(spark):
    text = "Ünal born 1987 met Zoë ☃ at x@y.zz now"
    spans = [("term", 0, 4, "generalise"), ("term", 10, 14, "generalise"), ("term", 19, 22, "remove"),
             ("email", 28, 34, "remove"), ("ip", 30, 36, "remove")]
    df = spark.createDataFrame(
        [(text, spans), (text, []), ("", [])],
        "text string, spans array<struct<kind:string,start:bigint,end:bigint,action:string>>",
    )
    got = [r[0] for r in df.select(pii.redact(F.col("text"), F.col("spans"))).collect()]
    assert got == ["[name] born 19xx met  ☃ at [email]ow", text, ""]


def test_odd_tables(spark):
    docs = spark.createDataFrame(
        [(1, "a@b.co", "x"), (1, "a@b.co", "x"), (None, None, "y")],
        "doc_id bigint, text string, spans string",
    )
    assert len(pii.find(docs).collect()) == 3
    assert pii.find(docs.limit(0)).collect() == []
