"""SimHash near-duplicates by Golay-code fuzzy hashing.

The binary Golay code of length 23 is perfect: every 23-bit word lies within 3 bits of
exactly one of its 4096 codewords. ``near(v)`` is the set of codeword indices of v and of
all words one bit away (at most 6), ``own(v)`` the index of v alone. Words within one bit
of each other have own(v) in near(w); words within two bits have a common index in near.

A 64-bit fingerprint is cut into segments A (23 bits), B (23) and C (18). Of at most three
differing bits, by the pigeonhole principle:

* none in C: one of A and B has at most one; C and own/near of that segment meet;
* none in A (or B), some in C: the other of A and B has at most two; A (or B) and near of
  the other meet;
* one each in A, B and C: own(A) with near(B) meets near(A) with own(B).

So every linked pair shares one of these keys, of 24 to 35 bits, and no key has to be
capped. Distinct fingerprints are joined on the keys and verified within the join, linked
fingerprints form components, and documents follow their fingerprint.

Defined results: null and empty texts have fingerprint zero and are linked like any other;
null identifiers never name a component unless it has no other; repeated rows keep their
rows; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fieldpanel.llm.common import fresh, stage, text_of
from fieldpanel.llm.components import components
from fieldpanel.shipping import ship

SEED = 42
SHINGLE = 3
MAX_BITS = 3  # the keys above are complete for this radius
GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
_A, _B, _C = (0, 23), (23, 23), (46, 18)  # first bit, bits


def fingerprint(text: str) -> int:
    """64 majority bits of the XXH64 of all shingles, repeats included."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    join = b" ".join
    shingles = zip(*[words[i:] for i in range(SHINGLE)]) if len(words) >= SHINGLE else [words]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(join(s), SEED) for s in shingles])
    bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64)
    majority = 2 * bits.sum(axis=0, dtype=np.int64) > len(bits)
    return int.from_bytes(np.packbits(majority).tobytes(), "big")


@lru_cache(maxsize=1)
def golay_index() -> np.ndarray:
    """For each 23-bit word, the index (message) of the codeword within three bits."""
    message = np.arange(4096, dtype=np.int64)
    rest = message << 11
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    codewords = (message << 11) | rest
    single = [1 << i for i in range(23)]
    errors = {0, *single}
    errors |= {a ^ b for a in single for b in single}
    errors |= {a ^ b for a in list(errors) for b in single}
    index = np.full(1 << 23, -1, np.int16)
    for error in errors:
        index[codewords ^ error] = message
    return index


def near_indices(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, indices): the distinct codeword indices within one bit of each word."""
    index = golay_index()
    flips = np.array([0] + [1 << i for i in range(23)], np.int64)
    found = np.sort(index[words[:, None] ^ flips[None, :]], axis=1)
    new = np.ones(found.shape, bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    return np.nonzero(new)[0], found[new].astype(np.int64)


def keys(fingerprints: np.ndarray, probe: bool) -> tuple[np.ndarray, np.ndarray]:
    """(rows, keys) of one side; linked fingerprints share a key of opposite sides."""

    def segment(at: tuple[int, int]) -> np.ndarray:
        shifted = fingerprints >> np.uint64(at[0])
        return (shifted & np.uint64((1 << at[1]) - 1)).astype(np.int64)

    a, b, c = segment(_A), segment(_B), segment(_C)
    every = np.arange(len(fingerprints))
    own_a, own_b = (golay_index()[s].astype(np.int64) for s in (a, b))
    (rows_a, near_a), (rows_b, near_b) = near_indices(a), near_indices(b)

    def family(n: int, exact: np.ndarray, rows: np.ndarray, index: np.ndarray):
        return rows, (np.int64(n) << 40) | (exact[rows] << 12) | index

    if probe:
        made = [family(1, c, rows_a, near_a), family(2, c, rows_b, near_b)]
    else:
        made = [family(1, c, every, own_a), family(2, c, every, own_b)]
    made += [family(3, a, rows_b, near_b), family(4, b, rows_a, near_a)]
    # own(A) and near(B) on one side, near(A) and own(B) on the other, as A << 12 | B
    if probe:
        crossed = rows_a, (np.int64(5) << 40) | (near_a << 12) | own_b[rows_a]
    else:
        crossed = rows_b, (np.int64(5) << 40) | (own_a[rows_b] << 12) | near_b
    made.append(crossed)
    return np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made])


def fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", digest: Column | None = None
) -> DataFrame:
    """(doc_id, fp) of every document, and its digest where one is given.

    fp holds the 64 bits as a signed number.
    """
    ship(docs.sparkSession)
    extra = [] if digest is None else ["digest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from fieldpanel.llm.simhash import fingerprint as made

        for batch in batches:
            found = np.array([made(t.as_py() or "") for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column(0), "fp": pa.array(found.view(np.int64))}
                | {name: batch.column(2) for name in extra}
            )

    columns = [F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")]
    columns += [] if digest is None else [digest.alias("digest")]
    schema = ", ".join(["doc_id bigint, fp bigint", *[f"{name} string" for name in extra]])
    return docs.select(*columns).mapInArrow(run, schema)


def _keyed(distinct: DataFrame, probe: bool, name: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from fieldpanel.llm.simhash import keys as made

        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            rows, found = made(fps.view(np.uint64), probe)
            yield pa.RecordBatch.from_pydict({"key": pa.array(found), name: pa.array(fps[rows])})

    return distinct.select("fp").mapInArrow(run, f"key bigint, {name} bigint")


def links(distinct: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of distinct fingerprints (fp) within three bits.

    Spark takes a keyed table for little more than the file of ``distinct``, but it has up to
    20 or 30 rows per fingerprint, so the join is told to shuffle both and broadcast neither.
    """
    probes = _keyed(distinct, True, "b").hint("merge")
    pairs = _keyed(distinct, False, "a").join(probes, "key")
    differing = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return pairs.where((F.col("a") < F.col("b")) & (differing <= MAX_BITS)).select("a", "b")


def _groups(marked: DataFrame) -> DataFrame:
    """(fp, root, component_id) of every distinct fingerprint; root is its least linked one.

    A join with it shuffles: rows that repeat in the other table shrink its file, by whose size
    Spark would broadcast that table.
    """
    distinct = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    found = components(links(distinct).distinct())
    rooted = distinct.join(found, F.col("fp") == F.col("node"))
    least = rooted.groupBy("root").agg(F.min("low").alias("component"))
    linked = stage(
        rooted.join(least, "root").select(F.col("fp").alias("node"), "root", "component"),
        "components",
    )
    return distinct.join(linked, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.coalesce("component", "low").alias("component_id"),
    ).hint("merge")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, fp, component_id (smallest reachable doc_id)."""
    marked = stage(fingerprints(docs, doc_id, text), "fingerprints")
    return marked.join(_groups(marked), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one per component: see ``one_per_group``."""
    digest = F.sha2(text_of(text), 256)
    marked = stage(fingerprints(docs, doc_id, text, digest), "fingerprints")
    found = marked.join(_groups(marked), "fp")
    return one_per_group(docs, found.select("root", "doc_id", "digest"), doc_id, text)


def one_per_group(docs: DataFrame, found: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row of ``docs`` for every root in ``found`` (root, doc_id, digest of the text).

    The smallest identifier stays, null only where a group has no other; of several texts
    with it the one with the least digest, and one of the rows that repeat both. Rows are
    found again by identifier and text, so groups that share an identifier, or have none,
    keep a row each.
    """
    own = fresh(docs.columns, "_doc_id", "_digest", "_n", "_row")
    order = F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "digest")
    rows = found.groupBy("root", "doc_id", "digest").agg(F.count(F.lit(1)).alias("n"))
    chosen = stage(
        rows.groupBy("root").agg(F.min_by(F.struct("doc_id", "digest", "n"), order).alias("row"))
        .select(*[F.col(f"row.{c}").alias(n) for c, n in zip(("doc_id", "digest", "n"), own)]),
        "chosen",
    )
    same = F.col(doc_id).cast("bigint").eqNullSafe(F.col(own[0]))
    same &= F.sha2(text_of(text), 256) == F.col(own[1])
    kept = docs.join(chosen, same)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    once = kept.where(F.col(own[2]) == 1).select(*columns)
    row = F.struct(*columns)
    again = kept.where(F.col(own[2]) > 1).groupBy(*own[:2]).agg(
        F.min_by(row, F.to_json(row)).alias(own[3])
    )
    return once.unionByName(again.select(f"{own[3]}.*"))
