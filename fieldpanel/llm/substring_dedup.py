"""Repeated substrings by a distributed difference cover.

A byte is removed if a ``LENGTH``-byte string covers it that also starts earlier. Only whether
two suffixes agree in their first ``LENGTH`` bytes matters, so the suffix sort is cut short:

1. Sample: positions whose offset modulo ``PERIOD`` lies in a difference cover. Any two
   positions reach sampled ones by a common shift below ``PERIOD``, so two equal windows hold
   a common sampled tuple of ``LENGTH - PERIOD + 1`` bytes. Tuples are named and sorted.
2. Recurse: names that occur once are final. Only suffixes within reach of a repeated
   name go on, which most of the text does not.
3. Merge: the remaining suffixes are named by their first ``LENGTH`` bytes and sorted with
   the document order; a suffix whose left neighbour has the same name repeats.

Names are 64-bit hashes of the bytes (sampled names keep fewer bits, which can only send
more suffixes on); a false removal needs a 64-bit collision. Names travel in sorted,
compressed blocks per chunk of documents and name range; the answer is one bit per name.
Chunks are written once, bucketed, so texts are never shuffled. A later whole copy of a
text is settled by its digest alone.

Defined results: null text is empty; texts shorter than ``LENGTH`` bytes lose nothing; rows
of equal identifier are different documents in the order of the input's partitions and rows;
null identifiers come last, as if they were the largest long; an empty table gives no rows;
extra columns are not read. One text has to fit in a task, at some 40 bytes of memory a byte.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from fieldpanel.llm.common import shuffle_width, stage, staging_path, text_of
from fieldpanel.shipping import ship

LENGTH = 100
# A perfect difference set modulo 73: every difference modulo 73 occurs once.
PERIOD, COVER = 73, (0, 1, 3, 7, 15, 31, 36, 54, 63)
CHUNK_BYTES = 4 << 20
RANGE_BYTES = 16 << 20  # input bytes per name range
_BASE = 0x9E3779B97F4A7C15
_LAST = np.iinfo(np.int64).max


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(n, _BASE, np.uint64))
        down = np.cumprod(np.full(n, pow(_BASE, -1, 1 << 64), np.uint64))
    return up, down


def window_names(data: np.ndarray, width: int, at: np.ndarray | None = None) -> np.ndarray:
    """64-bit names of the ``width``-byte windows starting at ``at`` (default: all)."""
    n = len(data)
    up, down = _powers(1 << max(16, int(n).bit_length()))
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        if at is None:
            at = np.arange(max(0, n - width + 1))
        h = (sums[at + width] - sums[at]) * down[at]
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
            h ^= h >> np.uint64(shift)
            h *= np.uint64(factor)
        h ^= h >> np.uint64(33)
    return h


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes, one plane per byte."""
    import zstandard

    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).reshape(-1).view(dtype)


class Chunk:
    """Some documents in order, and what is known of their suffixes."""

    def __init__(self, ids: list, texts: list[bytes], copies: list[int], ranges: int) -> None:
        self.ids = [(_LAST if i is None else i) for i in ids]
        self.texts, self.copies = texts, set(copies or ())
        self.order = sorted(
            (i for i in range(len(ids)) if i not in self.copies and len(texts[i]) >= LENGTH),
            key=lambda i: (self.ids[i], i),
        )
        sizes = np.array([len(texts[i]) for i in self.order], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.data = np.frombuffer(b"".join(texts[i] for i in self.order), np.uint8)
        self.shift = np.uint64(64 - (ranges - 1).bit_length()) if ranges > 1 else None

    def blocks(self, names: np.ndarray) -> list[tuple[int, int, int]]:
        """(range, from, to) of sorted names."""
        if not len(names):
            return []
        if self.shift is None:
            return [(0, 0, len(names))]
        ranges = (names >> self.shift).astype(np.int64)
        found, first = np.unique(ranges, return_index=True)
        return list(zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(names)]))

    def marked(self, names: np.ndarray, answers: list) -> np.ndarray:
        bits = {a["range"]: a["bits"] for a in answers or ()}
        mark = np.zeros(len(names), bool)
        for where, first, last in self.blocks(names):
            mark[first:last] = np.unpackbits(
                np.frombuffer(bits[where], np.uint8), count=last - first
            ).astype(bool)
        return mark

    def sample(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sampled positions, their distinct sorted names, and the name of each position."""
        width = LENGTH - PERIOD + 1
        parts = [np.zeros(0, np.int64)]
        for start, end in zip(self.starts[:-1], self.starts[1:]):
            grid = np.arange(0, end - start, PERIOD)[:, None] + np.array(COVER)[None, :]
            grid = grid.reshape(-1)
            parts.append(start + grid[grid <= end - start - width])
        at = np.concatenate(parts)
        names = window_names(self.data, width, at)
        # 32 bits beside the range: more bits would only travel
        keep = np.uint64(32) if self.shift is None else self.shift - np.uint64(32)
        names, which = np.unique(names >> keep << keep, return_inverse=True)
        return at, names, which

    def repeated(self, answers: list) -> np.ndarray:
        """Sampled positions whose name occurs again, in this chunk or in another."""
        at, names, which = self.sample()
        here = np.bincount(which, minlength=len(names)) > 1
        return at[(here | self.marked(names, answers))[which]]

    def suffixes(self, answers: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Suffixes within reach of a repeated name: positions, names, first, name of each."""
        repeated = self.repeated(answers)
        reach = np.zeros(len(self.data) + 1, np.int32)
        low = np.maximum(repeated - PERIOD + 1, 0)
        np.add.at(reach, low, 1)
        np.add.at(reach, repeated + 1, -1)
        reach = np.cumsum(reach)[:-1] > 0
        for end in self.starts[1:]:
            reach[max(0, end - LENGTH + 1) : end] = False
        at = np.flatnonzero(reach)
        names, first, which = np.unique(
            window_names(self.data, LENGTH, at), return_index=True, return_inverse=True
        )
        return at, names, first, which

    def removed(self, answers: list, repeats: list) -> Iterator[tuple[int, np.ndarray | None]]:
        """(row, flags of removed bytes or None for all) of every document."""
        at, names, first, which = self.suffixes(answers)
        again = self.marked(names, repeats)[which]
        later = np.ones(len(at), bool)
        later[first] = False
        hit = at[again | later]
        cover = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + LENGTH, -1)
        cover = np.cumsum(cover)[:-1] > 0
        spans = {row: (s, e) for row, s, e in zip(self.order, self.starts[:-1], self.starts[1:])}
        for row, text in enumerate(self.texts):
            if row in spans:
                yield row, cover[spans[row][0] : spans[row][1]]
            elif row in self.copies and len(text) >= LENGTH:
                yield row, None
            else:
                yield row, np.zeros(len(text), bool)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _chunked(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Documents in rows of about ``CHUNK_BYTES``: chunk, ids, texts."""
    kinds = pa.schema(
        [("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("texts", pa.list_(pa.binary()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list = []
        size = 0
        # partitions and what they hold are numbered, so a retried task makes the same chunks
        names = count(TaskContext.get().partitionId() << 40)

        def made() -> pa.RecordBatch:
            row = {"chunk": [next(names)], "ids": [ids], "texts": [texts]}
            return pa.RecordBatch.from_pydict(row, kinds)

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = t.as_py()
                if ids and size + len(data) > CHUNK_BYTES:
                    yield made()
                    ids, texts, size = [], [], 0
                ids.append(i)
                texts.append(data)
                size += len(data)
        if ids:
            yield made()

    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("id"), text_of(text).cast("binary").alias("data")
    )
    return rows.mapInArrow(run, "chunk bigint, ids array<bigint>, texts array<binary>")


def _blocks(chunks: DataFrame, ranges: int, merge: bool) -> DataFrame:
    """Sorted names by chunk and range: of samples, or (merge) of the suffixes left."""
    kinds = pa.schema(
        [("range", pa.int64()), ("chunk", pa.int64()), ("names", pa.binary()), ("ids", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from fieldpanel.llm.substring_dedup import Chunk as Made, pack as packed

        for row in _each(batches):
            chunk = Made(row["ids"], row["texts"], row["copies"], ranges)
            if merge:
                at, names, first, _ = chunk.suffixes(row["answers"])
                doc = np.searchsorted(chunk.starts, at[first], side="right") - 1
                ids = np.array([chunk.ids[i] for i in chunk.order], np.int64)[doc]
            else:
                names = chunk.sample()[1]
            out: dict[str, list] = {name: [] for name in kinds.names}
            for where, a, b in chunk.blocks(names):
                out["range"].append(where)
                out["chunk"].append(row["chunk"])
                out["names"].append(packed(np.diff(names[a:b], prepend=np.uint64(0))))
                out["ids"].append(packed(ids[a:b]) if merge else b"")
            yield pa.RecordBatch.from_pydict(out, kinds)

    return chunks.mapInArrow(run, "range bigint, chunk bigint, names binary, ids binary")


def _compared(blocks: DataFrame, merge: bool) -> DataFrame:
    """Per chunk the bits of its names: repeated anywhere, or (merge) also found earlier."""

    def run(table: pa.Table) -> pa.Table:
        from fieldpanel.llm.substring_dedup import unpack as unpacked

        names = [np.cumsum(unpacked(b.as_py(), np.uint64)) for b in table["names"]]
        counts = [len(n) for n in names]
        every = np.concatenate(names)
        chunk = np.repeat(np.array(table["chunk"].to_pylist(), np.int64), counts)
        if merge:
            ids = np.concatenate([unpacked(b.as_py(), np.int64) for b in table["ids"]])
            order = np.lexsort((chunk, ids, every))
        else:
            order = np.argsort(every, kind="stable")
        same = np.zeros(len(every), bool)
        same[1:] = every[order][1:] == every[order][:-1]
        if not merge:
            same[:-1] |= same[1:]
        mark = np.empty(len(every), bool)
        mark[order] = same
        parts = np.split(mark, np.cumsum(counts)[:-1])
        return pa.table(
            {
                "chunk": table["chunk"],
                "range": table["range"],
                "bits": pa.array([np.packbits(p).tobytes() for p in parts], pa.binary()),
            }
        )

    bits = blocks.groupBy("range").applyInArrow(run, "chunk bigint, range bigint, bits binary")
    return bits.groupBy("chunk").agg(F.collect_list(F.struct("range", "bits")).alias("found"))


def remove_repeats(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", keep_text: bool = False
) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept bytes)."""
    spark = docs.sparkSession
    ship(spark)
    name = f"chunks_{uuid.uuid4().hex}"
    writer = _chunked(docs, doc_id, text).write.bucketBy(shuffle_width(spark), "chunk")
    writer.option("path", staging_path(spark, "chunks")).option("compression", "zstd").saveAsTable(
        name
    )
    chunks = spark.table(name)
    size = F.aggregate("texts", F.lit(0).cast("bigint"), lambda n, t: n + F.length(t))
    total = chunks.agg(F.sum(size)).first()[0] or 0
    ranges = 1 << max(0, -(-total // RANGE_BYTES) - 1).bit_length()

    digests = stage(
        chunks.select("chunk", "ids", F.posexplode("texts").alias("row", "t")).select(
            "chunk", "row", F.coalesce(F.get("ids", F.col("row")), F.lit(int(_LAST))).alias("id"),
            F.sha2("t", 256).alias("digest"),
        ),
        "digests",
    )
    first = digests.groupBy("digest").agg(
        F.min(F.struct("id", "chunk", "row")).alias("first"), F.count(F.lit(1)).alias("n")
    )
    later = digests.join(first.where(F.col("n") > 1), "digest").where(
        F.struct("id", "chunk", "row") != F.col("first")
    )
    copies = stage(later.groupBy("chunk").agg(F.collect_list("row").alias("copies")), "copies")

    known = chunks.join(copies, "chunk", "left")
    answers = stage(_compared(_blocks(known, ranges, False), False), "answers")
    known = known.join(answers.withColumnRenamed("found", "answers"), "chunk", "left")
    repeats = stage(_compared(_blocks(known, ranges, True), True), "repeats")
    known = known.join(repeats.withColumnRenamed("found", "repeats"), "chunk", "left")

    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
              ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    if keep_text:
        fields.append(("kept", pa.binary()))
        schema += ", kept binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from fieldpanel.llm.substring_dedup import Chunk as Made

        for row in _each(batches):
            chunk = Made(row["ids"], row["texts"], row["copies"], ranges)
            out: dict[str, list] = {n: [] for n, _ in fields}
            for i, gone in chunk.removed(row["answers"], row["repeats"]):
                data = row["texts"][i]
                if gone is None:
                    gone = np.ones(len(data), bool)
                kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                out["doc_id"].append(row["ids"][i])
                out["n_bytes"].append(len(data))
                out["n_removed"].append(int(gone.sum()))
                out["n_spans"].append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if keep_text:
                    out["kept"].append(kept)
            yield pa.RecordBatch.from_pydict(out, pa.schema(fields))

    found = stage(known.mapInArrow(run, schema), "substring_dedup")
    spark.sql(f"DROP TABLE {name}")  # the catalogue's entry; its files go with the staged ones
    return found
