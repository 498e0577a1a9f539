"""Document fingerprints by a homomorphic multiset hash of paragraphs.

Every paragraph is hashed to a wide vector; a document's fingerprint is the sum of its
paragraphs' vectors modulo powers of two. Sums do not depend on order, equal multisets of
paragraphs have equal fingerprints, and paragraphs are inserted or deleted by adding or
subtracting their own fingerprint (``combine``), without the rest of the document.

A vector has two parts. ``DENSE`` lanes of 32 bits hold the hash of the whole paragraph and
decide equality. The other lanes make fingerprints comparable: each clause of the paragraph
adds a byte to one of ``LANES`` lanes of one of ``LEVELS`` levels, level l being chosen with
probability 2**-(l+1). Two fingerprints then differ in few lanes of every level that the
differing clauses rarely hit, from which ``likeness`` estimates the size of the difference.
The deepest level sees one clause in 2**27, so no text a string can hold exceeds the estimate;
occupied lanes alone are stored, so short texts do not pay for the depth.

Defined results: null text counts as empty; empty texts have the fingerprint of the empty
multiset and likeness 1 among each other; white space around paragraphs and clauses does
not count; an empty table gives no rows; repeated rows have equal fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fieldpanel.llm.common import let

DENSE = 16
LANES = 32
LEVELS = 28
_BYTE = 256
_MASK = 0xFFFFFFFF


def paragraphs(text: Column) -> Column:
    """The lines of a text that hold more than white space, trimmed."""
    return F.filter(F.transform(F.split(text, r"\n"), lambda p: F.trim(p)), lambda p: p != "")


def clauses(text: Column) -> Column:
    """The stretches of a text between line ends, or punctuation with a space after it."""
    parts = F.split(text, r"\n|(?<=[.,;:!?|%#$&*]) ")
    return F.filter(F.transform(parts, lambda c: F.trim(c)), lambda c: c != "")


def _zero() -> Column:
    return F.lit(0).cast("bigint")


def _code(clause: Column) -> Column:
    """Lane and value of a clause as one number: lane * 256 + value."""
    h = F.xxhash64(clause)
    # value, lane and level come from different bits: 0 to 7, 8 to 12 and 32 to 58
    bits = F.shiftrightunsigned(h, 32).bitwiseAND(F.lit((1 << (LEVELS - 1)) - 1))
    bits = bits.bitwiseOR(F.lit(1 << (LEVELS - 1)))
    level = F.bit_count(bits.bitwiseAND(-bits) - 1)
    lane = level * LANES + F.pmod(F.shiftrightunsigned(h, 8), F.lit(LANES))
    value = h.bitwiseAND(F.lit(_BYTE - 1))
    return (lane * _BYTE + F.when(value == 0, F.lit(1)).otherwise(value)).cast("bigint")


def _sum_lanes(codes: Column) -> Column:
    """Codes with one entry per lane, in lane order, summed modulo 256; zero sums go."""
    start = F.struct(
        F.array().cast("array<bigint>").alias("done"),
        F.lit(-1).cast("bigint").alias("lane"),
        _zero().alias("sum"),
    )

    def closed(acc: Column) -> Column:
        last = F.array((acc["lane"] * _BYTE + acc["sum"]).cast("bigint"))
        return F.when(acc["sum"] == 0, acc["done"]).otherwise(F.concat(acc["done"], last))

    def add(acc: Column, code: Column) -> Column:
        lane, value = F.floor(code / _BYTE), code % _BYTE
        same = lane == acc["lane"]
        return F.struct(
            F.when(same, acc["done"]).otherwise(closed(acc)).alias("done"),
            lane.cast("bigint").alias("lane"),
            F.when(same, (acc["sum"] + value) % _BYTE).otherwise(value).cast("bigint").alias("sum"),
        )

    return F.aggregate(F.sort_array(codes), start, add, closed)


def vector(text: Column) -> Column:
    """struct(n, dense, lanes): clauses counted, dense sums, and sparse lane sums."""

    def total(hashes: Column, shift: int) -> Column:
        def add(acc: Column, h: Column) -> Column:
            part = F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(_MASK))
            return (acc + part).bitwiseAND(F.lit(_MASK))

        return F.aggregate(hashes, _zero(), add)

    def dense(lines: Column) -> Column:
        def pair(i: int) -> Column:
            hashes = F.transform(lines, lambda p: F.xxhash64(p, F.lit(i)))
            return let(hashes, lambda h: F.array(total(h, 0), total(h, 32)))

        return F.flatten(F.array(*[pair(i) for i in range(DENSE // 2)]))

    return let(
        clauses(text),
        lambda parts: F.struct(
            F.size(parts).cast("bigint").alias("n"),
            let(paragraphs(text), dense).alias("dense"),
            _sum_lanes(F.transform(parts, _code)).alias("lanes"),
        ),
    )


def combine(left: Column, right: Column, sign: int = 1) -> Column:
    """The vector of a multiset with another one's paragraphs added (1) or removed (-1)."""
    other = right["lanes"]
    if sign < 0:
        other = F.transform(other, lambda c: c - c % _BYTE + (_BYTE - c % _BYTE) % _BYTE)
    return F.struct(
        (left["n"] + sign * right["n"]).alias("n"),
        F.zip_with(
            left["dense"], right["dense"], lambda a, b: F.pmod(a + sign * b, F.lit(_MASK + 1))
        ).alias("dense"),
        _sum_lanes(F.concat(left["lanes"], other)).alias("lanes"),
    )


def fingerprint(vec: Column) -> Column:
    """A vector as text: count, dense lanes and the occupied sparse lanes in hexadecimal."""

    def padded(values: Column, digits: int) -> Column:
        return F.array_join(F.transform(values, lambda v: F.lpad(F.hex(v), digits, "0")), "")

    return F.lower(
        F.concat(F.hex(vec["n"]), F.lit(":"), padded(vec["dense"], 8), F.lit(":"),
                 padded(vec["lanes"], 5))
    )


def likeness(a: Column, b: Column) -> Column:
    """1 - (estimated clauses in one text only) / (clauses of both texts), within 0 and 1.

    The first level with at most three quarters of its lanes differing is decoded with
    all levels above it: together they see 2**-l of the difference.
    """
    def lanes_of(odd: Column) -> Column:
        lanes = F.array_distinct(F.transform(odd, lambda c: F.floor(c / _BYTE)))
        return F.transform(lanes, lambda lane: F.floor(lane / LANES))

    def per_level(levels: Column) -> Column:
        def lanes_at(level: int) -> Column:
            return F.size(F.filter(levels, lambda x: x == level))

        return F.array(*[lanes_at(i) for i in range(LEVELS)])

    def estimate(counts: Column) -> Column:
        usable = F.array_position(F.transform(counts, lambda k: k <= LANES * 3 // 4), True)
        level = F.when(usable == 0, F.lit(LEVELS)).otherwise(usable).cast("int")
        hits = F.transform(
            F.slice(counts, level, F.lit(LEVELS)),
            lambda k: -LANES * F.log(1 - F.least(k, F.lit(LANES - 1)) / F.lit(float(LANES))),
        )
        seen = F.aggregate(hits, F.lit(0.0), lambda acc, x: acc + x)
        return seen * F.pow(F.lit(2.0), level - 1)

    odd = F.array_union(
        F.array_except(a["lanes"], b["lanes"]), F.array_except(b["lanes"], a["lanes"])
    )
    differing = let(let(lanes_of(odd), per_level), estimate)
    like = F.greatest(F.lit(0.0), 1.0 - differing / F.greatest(a["n"] + b["n"], F.lit(1)))
    return F.when(a == b, F.lit(1.0)).otherwise(like)
