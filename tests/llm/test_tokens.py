"""Tokenizers against the public libraries, on whole texts and random strings."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer, models, pre_tokenizers

from fieldpanel.llm import bpe, unigram_count

ALPHABET = "aaaabctheing  \n\t\x1c\x1f\x85\xa0éèß'sS.,!0123 ​　᠎漢字🙂🏽\x00"


def random_texts(n: int, longest: int = 60) -> list[str]:
    draw = random.Random(5)
    return ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, longest))) for _ in range(n)]


@pytest.fixture(scope="module")
def reference():
    path = public_tokenizers.path(bpe.VOCABULARY)
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path),
        special_tokens={},
    )


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    odd = ["", "a" * 5000, " " * 3000, "ab" * 2000, "\n" * 999, "<|endoftext|>", "ĠĠ", "0" * 400]
    return [r[0] for r in rows] + odd + random_texts(3000)


def test_bpe_equals_the_library(reference, texts):
    coder = bpe.encoder()
    for text in texts:
        ids = coder.encode(text)
        assert list(memoryview(ids).cast("I")) == reference.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


def test_bpe_backtracks_and_marks_dead_ends():
    ranks = {bytes([c]): c for c in range(256)}
    for i, token in enumerate([b"ab", b"bc", b"cd", b"abc", b"bcd", b"dd", b"cdd"]):
        ranks[token] = 256 + i
    coder = bpe.Encoder(ranks, r"\S+")
    draw = random.Random(1)
    for _ in range(500):
        data = bytes(draw.choice(b"abcd") for _ in range(draw.randint(1, 14)))
        assert coder.encode_piece(data) == ([ranks[data]] if data in ranks else coder.merge(data))


def test_bpe_frame(spark, reference):
    rows = [(1, "the cat"), (2, None), (None, ""), (1, "the cat"), (3, "é" * 30000)]
    docs = spark.createDataFrame(
        [(a, b, "x") for a, b in rows], "doc_id bigint, text string, n_tokens string"
    )
    got = bpe.tokenize(docs, keep_ids=True).collect()
    assert len(got) == 5 and all(r.intact for r in got)
    by_id = {r.doc_id: r for r in got}
    assert by_id[3].ids == reference.encode_ordinary("é" * 30000)
    assert by_id[2].n_tokens == 0 and by_id[None].ids == []
    assert by_id[1].decoded_sha256 == hashlib.sha256(b"the cat").hexdigest()
    assert bpe.tokenize(docs.limit(0)).collect() == []


def test_counts_equal_the_library(texts):
    pieces = unigram_count.read_pieces(public_tokenizers.path(unigram_count.MODEL))
    vocab = [("<unk>", 0.0), *[(f"<0x{b:02X}>", 0.0) for b in range(256)], *pieces]
    tokenizer = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    counter = unigram_count.counter()
    for text in texts:
        if "<" not in text:
            want = len(tokenizer.encode(text, add_special_tokens=False).ids)
            assert counter.text(text)[1] == want, text[:80]


def test_counts_follow_the_tie_rule():
    counter = unigram_count.Counter([("a", -1.0), ("aa", -2.0), ("aaa", -3.0), ("b", -9.0)])
    assert counter.word("aaa") == (-3.0, 1)  # equal scores: the earliest start
    assert counter.word("aaaa") == (-4.0, 2)
    assert counter.word("é") == (-19.0, 2)  # two bytes
    assert counter.text(None or "") == (0.0, 0, 0)


def test_count_frame(spark):
    docs = spark.createDataFrame(
        [(1, "the cat"), (2, None), (None, " "), (1, "the cat")], "doc_id bigint, text string"
    )
    got = {r.doc_id: r for r in unigram_count.count_tokens(docs).collect()}
    assert got[2].n_tokens == 0 and got[1].n_words == 2 and got[None].n_words == 1
    assert unigram_count.count_tokens(docs.limit(0)).collect() == []
