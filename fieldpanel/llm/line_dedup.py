"""Line deduplication that can be undone: cuckoo filters over exact reference counts.

A line's key is the line without ASCII white space at its ends and with A-Z lower-cased, held
as 128 bits of its SHA-256. Of the documents that hold a key, the one of smallest id keeps its
lines. A ``LineIndex`` holds three written tables:

* ``postings`` (k1, k2, row, doc): which row holds which key;
* ``refs`` (k1, k2, refs, first, last, unnamed): the exact reference count of every live key,
  with the smallest and largest id that refer to it and whether a null id does;
* ``filters`` (shard, slots, stash): per shard of about ``SHARD_KEYS`` keys a cuckoo filter
  with one entry for a live key and a second one if at least two documents share it.

A line whose key counts less than two in its filter stays; only the others are looked up in the
exact counts. Inserting documents looks up only keys the filter may hold, and appends all
others. Deleting documents recounts only the keys they held: a line dropped because of a
deleted document comes back. Every operation returns a new index and leaves the old one as it
is.

Postings meet filters and counts in cells of one shard. A shard with many postings (a line of
very many documents) is spread over salts, so no cell exceeds ``CELL_ROWS`` or a 64th of a fair
share of all postings, whichever is more.

Defined results: null or empty text is one empty line. Keys of fewer than ``shortest`` code
points are never dropped. Rows of one id are one document, and all null ids are one document
that comes after every other id. Repeated rows have equal results. An empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fieldpanel.llm.common import shuffle_width, stage, text_of
from fieldpanel.llm.cuckoo import CuckooFilter
from fieldpanel.shipping import ship

SHORTEST = 10
SHARD_KEYS = 1 << 12
CELL_ROWS = 1 << 17
_SPACE = b" \t\n\v\f\r"
_KEY = ["k1", "k2"]


def line_key(line: bytes, shortest: int = SHORTEST) -> bytes | None:
    """16 bytes that stand for the line's key, None for a key that is too short."""
    key = line.strip(_SPACE).lower()
    if len(key) < shortest or (len(key) < 4 * shortest and len(key.decode()) < shortest):
        return None
    return hashlib.sha256(key).digest()[:16]


def row_name(doc_id: str, text: str) -> Column:
    """A name that only rows equal in id and text share; they have equal results."""
    whole = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("\n"), text_of(text))
    return F.substring(F.sha2(whole, 256), 1, 32)


def _named(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        row_name(doc_id, text).alias("row"),
        F.col(doc_id).cast("bigint").alias("doc"),
        text_of(text).alias("text"),
    )


def postings(docs: DataFrame, doc_id: str, text: str, shortest: int) -> DataFrame:
    """(k1, k2, row, doc), each key once per row."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found, owner = [], []
                for number, value in enumerate(part.column("text")):
                    lines = value.as_buffer().to_pybytes().split(b"\n")
                    keys = {line_key(line, shortest) for line in lines}
                    keys.discard(None)
                    found.extend(keys)
                    owner.append(np.full(len(keys), number))
                words = np.frombuffer(b"".join(found), ">i8").astype(np.int64).reshape(-1, 2)
                rows = pa.array(np.concatenate(owner))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words[:, 0]), pa.array(words[:, 1]),
                     part.column("row").take(rows), part.column("doc").take(rows)],
                    [*_KEY, "row", "doc"],
                )

    named = _named(docs, doc_id, text)
    return named.mapInArrow(run, "k1 bigint, k2 bigint, row string, doc bigint")


def counted(found: DataFrame) -> DataFrame:
    """The exact references to every key."""
    return found.groupBy(*_KEY).agg(
        F.count(F.lit(1)).alias("refs"),
        F.min("doc").alias("first"),
        F.max("doc").alias("last"),
        F.coalesce(F.bool_or(F.col("doc").isNull()), F.lit(False)).alias("unnamed"),
    )


def _merged(refs: DataFrame) -> DataFrame:
    """One row per key from several partial counts."""
    return refs.groupBy(*_KEY).agg(
        F.sum("refs").alias("refs"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.bool_or("unnamed").alias("unnamed"),
    )


def level() -> Column:
    """Entries of a key in the filter: 2 if several documents share it, else 1."""
    shared = (F.col("first") < F.col("last")) | (F.col("unnamed") & F.col("first").isNotNull())
    return F.when(shared, 2).otherwise(1)


def _shard(shards: int) -> Column:
    return F.pmod(F.shiftright("k1", 32), F.lit(shards)).cast("int")


def _words(table: pa.Table) -> np.ndarray:
    pair = [table.column(c).combine_chunks().to_numpy().view(np.uint64) for c in _KEY]
    return np.column_stack(pair)


def _filter_of(rows: pa.Table) -> CuckooFilter | None:
    if not rows.num_rows:
        return None
    return CuckooFilter.read(rows.column("slots")[0].as_py(), rows.column("stash")[0].as_py())


_FILTER = "shard int, slots binary, stash binary"
_REFS = "k1 bigint, k2 bigint, refs bigint, first bigint, last bigint, unnamed boolean"


def _changed(keys: pa.Table, filters: pa.Table) -> pa.Table:
    """One shard's filter after the entries that ``change`` states came or went."""
    change = keys.column("change").combine_chunks().to_numpy()
    words = _words(keys)
    found = _filter_of(filters) or CuckooFilter.sized(max(int(change.clip(0).sum()), 2 * SHARD_KEYS))
    shard = (keys if keys.num_rows else filters).column("shard")[:1]
    for times in (1, 2):
        found.remove(words[change <= -times])
        found.add(words[change >= times])
    slots, stash = found.written()
    return pa.table(
        {"shard": shard, "slots": pa.array([slots]), "stash": pa.array([stash], pa.binary())}
    )


def _may_be_known(keys: pa.Table, filters: pa.Table) -> pa.Table:
    """Keys of one shard with the number of entries its filter may hold of them."""
    found = _filter_of(filters)
    seen = found.count(_words(keys)) if found else np.zeros(keys.num_rows, np.int64)
    return pa.table({**{c: keys.column(c) for c in _KEY}, "seen": pa.array(seen, pa.int64())})


def _cell(held: pa.Table, known: pa.Table) -> pa.Table:
    """The postings of one cell that lose their lines: (row, k1, k2).

    ``known`` has the shard's filter in one row and its shared keys in the others.
    """
    slots = known.column("slots").combine_chunks()
    words = _words(held)
    at = np.empty(0, np.int64)
    if held.num_rows and known.num_rows:
        found = _filter_of(known.filter(slots.is_valid()))
        at = np.flatnonzero(found.count(words) >= 2)
    drop = []
    if len(at):
        exact = known.filter(slots.is_null())
        firsts = dict(zip(map(tuple, _words(exact).tolist()), exact.column("first").to_pylist()))
        docs = held.column("doc").take(pa.array(at)).to_pylist()
        for i, key, doc in zip(at.tolist(), map(tuple, words[at].tolist()), docs):
            first = firsts.get(key)  # none: the filter was wrong
            if first is not None and doc != first:
                drop.append(i)
    return held.take(pa.array(drop, pa.int64())).select(["row", *_KEY])


@dataclass(frozen=True)
class LineIndex:
    postings: DataFrame
    refs: DataFrame
    filters: DataFrame
    shards: int
    shortest: int = SHORTEST

    @classmethod
    def empty(cls, spark, shortest: int = SHORTEST) -> LineIndex:
        """An index of no documents."""
        held = spark.createDataFrame([], "k1 bigint, k2 bigint, row string, doc bigint")
        refs = spark.createDataFrame([], _REFS)
        return cls(held, refs, spark.createDataFrame([], _FILTER), 0, shortest)

    def insert(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> LineIndex:
        """The index with the documents of ``docs`` added."""
        batch = stage(postings(docs, doc_id, text, self.shortest), "postings")
        added = stage(counted(batch), "added")
        held = batch if self.shards == 0 else self.postings.unionByName(batch)
        if self.shards == 0:
            return _built(held, added, self.shortest)
        by_shard = added.withColumn("shard", _shard(self.shards))
        seen = stage(
            by_shard.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(
                _may_be_known, "k1 bigint, k2 bigint, seen bigint"
            ),
            "seen",
        )
        # only keys that the filter may hold are looked up in the exact counts
        known = seen.where("seen > 0").select(*_KEY)
        before = stage(self.refs.join(known, _KEY, "left_semi"), "before")
        after = stage(_merged(before.unionByName(added)), "after")
        refs = self.refs.join(known, _KEY, "left_anti").unionByName(after)
        return self._with(held, refs, before, after)

    def delete(self, ids: DataFrame, doc_id: str = "doc_id") -> LineIndex:
        """The index without the documents whose ids are given; unknown ids change nothing."""
        ids = stage(ids.select(F.col(doc_id).cast("bigint").alias("doc")).distinct(), "ids")
        gone, left = self.postings.alias("p"), ids.alias("i")
        same = F.col("p.doc").eqNullSafe(F.col("i.doc"))
        touched = stage(gone.join(left, same, "left_semi").select(*_KEY).distinct(), "touched")
        held = stage(gone.join(left, same, "left_anti"), "postings")
        before = stage(self.refs.join(touched, _KEY, "left_semi"), "before")
        after = stage(counted(held.join(touched, _KEY, "left_semi")), "after")
        refs = self.refs.join(touched, _KEY, "left_anti").unionByName(after)
        return self._with(held, refs, before, after)

    def _with(
        self, held: DataFrame, refs: DataFrame, before: DataFrame, after: DataFrame
    ) -> LineIndex:
        """The index after some keys' counts went from ``before`` to ``after``."""
        refs = stage(refs, "refs")
        if refs.count() > 2 * SHARD_KEYS * self.shards:
            return _built(held, refs, self.shortest)
        moves = before.select(*_KEY, (-level()).alias("change")).unionByName(
            after.select(*_KEY, level().alias("change"))
        )
        moves = moves.groupBy(*_KEY).agg(F.sum("change").alias("change")).where("change != 0")
        moves = moves.withColumn("shard", _shard(self.shards))
        filters = moves.groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInArrow(
            _changed, _FILTER
        )
        return LineIndex(held, refs, stage(filters, "filters"), self.shards, self.shortest)

    def _salts(self) -> DataFrame:
        """(shard, salts) of the shards with more postings than one cell takes.

        A cell takes ``CELL_ROWS`` or a 64th of a fair share of all postings, so there are
        at most 64 such shards per shuffle partition.
        """
        per_shard = self.refs.groupBy(_shard(self.shards).alias("shard")).agg(
            F.sum("refs").alias("n")
        )
        whole = self.refs.agg(F.sum("refs")).first()[0] or 0
        width = shuffle_width(self.refs.sparkSession)
        most = max(CELL_ROWS, -(-whole // (64 * width)))
        return per_shard.where(F.col("n") > most).select(
            "shard", F.ceil(F.col("n") / F.lit(most)).alias("salts")
        )

    def dropped(self, held: DataFrame | None = None) -> DataFrame:
        """(row, k1, k2): the keys whose lines the rows lose; by default of all rows held."""
        if self.shards == 0:
            return self.postings.select("row", *_KEY)
        held = self.postings if held is None else held
        salts = F.broadcast(stage(self._salts(), "salts"))
        cells = ["shard", "salt"]
        spread = F.coalesce("salts", F.lit(1))
        left = (
            held.withColumn("shard", _shard(self.shards))
            .withColumn("_at", F.monotonically_increasing_id())
            .join(salts, "shard", "left")
            .select(*cells[:1], F.pmod("_at", spread).alias("salt"), "row", "doc", *_KEY)
        )
        shared = self.refs.where(level() == 2).select(
            _shard(self.shards).alias("shard"), *_KEY, "first",
            F.lit(None).cast("binary").alias("slots"), F.lit(None).cast("binary").alias("stash"),
        )
        filters = self.filters.select(
            "shard", *[F.lit(None).cast("bigint").alias(c) for c in (*_KEY, "first")],
            "slots", "stash",
        )
        right = shared.unionByName(filters).join(salts, "shard", "left").withColumn(
            "salt", F.explode(F.sequence(F.lit(0).cast("bigint"), spread - 1))
        )
        found = left.groupBy(*cells).cogroup(right.groupBy(*cells)).applyInArrow(
            _cell, "row string, k1 bigint, k2 bigint"
        )
        return stage(found, "dropped")


def _built(held: DataFrame, refs: DataFrame, shortest: int) -> LineIndex:
    """Filters made anew from the exact counts, for as many shards as their number asks for."""
    shards = max(-(-refs.count() // SHARD_KEYS), 1)
    spark = refs.sparkSession
    moves = refs.select(*_KEY, level().alias("change"), _shard(shards).alias("shard"))
    none = spark.createDataFrame([], _FILTER)
    filters = moves.groupBy("shard").cogroup(none.groupBy("shard")).applyInArrow(_changed, _FILTER)
    return LineIndex(held, refs, stage(filters, "filters"), shards, shortest)


def _cleaner(shortest: int, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, keys in zip(*(batch.column(c) for c in ("doc", "text", "keys"))):
                raw = text.as_buffer().to_pybytes()
                lines = raw.split(b"\n")
                n, kept = len(lines), raw
                if keys.is_valid:
                    lost = {k.as_py() for k in keys.values}
                    lines = [x for x in lines if line_key(x, shortest) not in lost]
                    kept = b"\n".join(lines)
                digest = hashlib.sha256(kept).hexdigest()
                rows.append((doc.as_py(), n, n - len(lines), digest, kept if keep_text else None))
            names = ["doc_id", "n_lines", "n_dropped", "kept_sha256", "kept"]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            columns = list(zip(*rows)) or [()] * 5
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
            arrays[4] = arrays[4].cast(pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def deduplicate(
    docs: DataFrame,
    index: LineIndex | None = None,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    shortest: int = SHORTEST,
    keep_text: bool = False,
) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every row, and the text left if asked for.

    Without an ``index`` the documents are compared with each other. An index must hold the
    documents; it may hold others beside them, whose lines count as well.
    """
    ship(docs.sparkSession)
    if index is None:
        index = LineIndex.empty(docs.sparkSession, shortest).insert(docs, doc_id, text)
        lost = index.dropped()
    else:
        held = stage(postings(docs, doc_id, text, index.shortest), "postings")
        lost = index.dropped(held)
    key = F.concat(*[F.unhex(F.lpad(F.hex(c), 16, "0")) for c in _KEY])
    per_row = lost.groupBy("row").agg(F.collect_set(key).alias("keys"))
    joined = _named(docs, doc_id, text).join(per_row, "row", "left").select("doc", "text", "keys")
    schema = "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string, kept string"
    found = joined.mapInArrow(_cleaner(index.shortest, keep_text), schema)
    return found if keep_text else found.drop("kept")
