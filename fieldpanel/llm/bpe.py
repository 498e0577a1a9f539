"""Byte-level BPE encoding and decoding in linear time.

The vocabulary's byte strings are mapped to Latin-1 text, so that an Aho-Corasick automaton
lists every token that starts at every byte of a piece. A piece is encoded from left to
right by the longest token that is compatible with the one before it; where none is, the
last token is given up for a shorter one, and the position is marked as dead. Two adjacent
tokens are compatible if merging their joined bytes gives back just these two; a sequence
whose neighbours are all compatible is the one that the merges make. Compatibility and the
encodings of short pieces are memoised in tables of bounded size that only save time.

Defined results: null text counts as empty and has no tokens; texts of any length are
encoded whole; an empty table gives no rows; repeated rows give equal results.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fieldpanel.shipping import ship

VOCABULARY = "byte_bpe_50k.tiktoken"
MEMO_PIECES, MEMO_PAIRS, MEMO_LENGTH = 200_000, 500_000, 64
PART_BYTES = 4 << 20  # packed ids gathered before they are passed on


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines)
        return {base64.b64decode(p[0]): int(p[1]) for p in pairs if p}


class Encoder:
    """Encodes texts by a rank table; ``pattern`` cuts a text into pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import ahocorasick
        import regex

        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            # a token that its own merges do not make only stands for a whole piece
            if len(token) == 1 or self.merge(token) == [rank]:
                self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces: dict[str, bytes] = {}

    def merge(self, data: bytes) -> list[int]:
        """The definition: join the adjacent pair of least rank, leftmost first."""
        ranks, parts = self.ranks, [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            joined = [ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
            least = min(joined)
            if least == 1 << 60:
                break
            i = joined.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [ranks[p] for p in parts]

    def compatible(self, left: int, right: int) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            known = self.merge(self.token[left] + self.token[right]) == [left, right]
            self.pairs[left, right] = known
        return known

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        end = len(data)
        options: list[list[tuple[int, int]]] = [[] for _ in range(end + 1)]
        for last, match in self.automaton.iter(data.decode("latin-1")):
            options[last + 1 - match[0]].append(match)  # shortest first
        dead = bytearray(end + 1)
        path: list[tuple[int, int, int]] = []  # position, option, token
        at, option = 0, len(options[0]) - 1
        while at < end:
            while option >= 0:
                length, token = options[at][option]
                if not dead[at + length] and (not path or self.compatible(path[-1][2], token)):
                    path.append((at, option, token))
                    at += length
                    option = len(options[at]) - 1
                    break
                option -= 1
            else:
                dead[at] = 1
                at, option, _ = path.pop()
                option -= 1
        return [token for _, _, token in path]

    def packed(self, piece: str) -> bytes:
        ids = self.encode_piece(piece.encode())
        found = b"".join(i.to_bytes(4, "little") for i in ids)
        if len(piece) <= MEMO_LENGTH:
            if len(self.pieces) >= MEMO_PIECES:
                self.pieces.clear()
            self.pieces[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        known, packed = self.pieces.get, self.packed
        return b"".join([known(p) or packed(p) for p in self.find(text)])

    def decode(self, ids: bytes) -> bytes:
        token = self.token
        return b"".join([token[i] for i in memoryview(ids).cast("I")])


def coded(coder: Encoder, batch: pa.RecordBatch, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    """The result rows of a batch (doc_id, text), in parts of about ``PART_BYTES`` of ids.

    Ids stay packed bytes until they are the values of an Arrow list, so a task holds one part
    beside its input batch, however many rows the batch has.
    """
    rows: list[tuple] = []
    parts: list[bytes] = []
    start = held = 0
    for at, value in enumerate(batch.column(1)):
        text = value.as_py() or ""
        ids = coder.encode(text)
        decoded = coder.decode(ids)
        rows.append((
            len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest(),
            decoded == text.encode(),
        ))
        held += len(ids)
        if keep_ids:
            parts.append(ids)
        if held >= PART_BYTES or at == batch.num_rows - 1:
            done = batch.column(0).slice(start, len(rows))
            yield _part(done, rows, parts if keep_ids else None)
            rows, parts, start, held = [], [], at + 1, 0


def _part(doc_id: pa.Array, rows: list[tuple], parts: list[bytes] | None) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.string(), pa.bool_())
    arrays = [doc_id, *(pa.array(c, kind) for c, kind in zip(zip(*rows), kinds))]
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "intact"]
    if parts is not None:
        ends = pa.array(np.cumsum([0, *(len(p) // 4 for p in parts)]), pa.int32())
        values = pa.Array.from_buffers(
            pa.int32(), sum(map(len, parts)) // 4, [None, pa.py_buffer(b"".join(parts))]
        )
        arrays.append(pa.ListArray.from_arrays(ends, values))
        names.append("ids")
    return pa.RecordBatch.from_arrays(arrays, names)


@lru_cache(maxsize=2)
def encoder(path: str | None = None, pattern: str | None = None) -> Encoder:
    """One encoder per Python worker; the default is the public vocabulary."""
    import public_tokenizers

    path = path or public_tokenizers.path(VOCABULARY)
    return Encoder(read_ranks(path), pattern or public_tokenizers.PATTERN)


def tokenize(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    pattern: str | None = None,
    keep_ids: bool = False,
) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256, intact (and ids).

    ``decoded_sha256`` digests the bytes decoded from the ids; ``intact`` says that they are
    the text's own. ``ids`` (array<int>) is returned if asked for.
    """
    ship(docs.sparkSession)
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, intact boolean"
    if keep_ids:
        schema += ", ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from fieldpanel.llm import bpe as made

        coder = made.encoder(path, pattern)
        for batch in batches:
            yield from made.coded(coder, batch, keep_ids)

    columns = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return columns.mapInArrow(run, schema)
