"""Exact quantiles without a sort: histograms that close in on the wanted ranks.

Every wanted rank of a column lies in a bracket of values, at first the column's range. A round
counts the rows of all brackets of all columns in bins, in one aggregation, and keeps the
least and largest value of each bin; the bin that holds the rank becomes the next bracket.
A bracket with one value is the answer. A round narrows a bracket a thousandfold, so a
handful of rounds settles any number of rows. Bins are of equal width, or of equal width in
the logarithm where one bin of the round before still held a large part of its rows. Only
bins reach the driver, at most ``BINS`` per bracket.

NULL is ignored; NaN counts as larger than any other value.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from fieldpanel.operators.profile import column
from fieldpanel.staging import reread

BINS = 1024
HEAVY = 0.25  # share of a bracket's rows in one bin that asks for the other kind of bins


@dataclass(frozen=True)
class _Bracket:
    """Values from ``low`` to ``high`` of the column, ``below`` of its rows being smaller."""

    place: int
    low: float
    high: float
    below: int
    rows: int
    logarithmic: bool

    def _position(self, value: Column) -> Column:
        if not self.logarithmic:
            return value / 2  # halves, so that a difference cannot overflow
        size = F.when(F.abs(value) == math.inf, 1100.0).otherwise(F.log2(F.abs(value)))
        return F.when(value == 0, 0.0).otherwise(F.signum(value) * (size + 1080))

    def bin(self, value: Column) -> Column:
        """A number that never falls as the value grows; both ends have bins of their own."""
        low, high = (self._position(F.lit(end)) for end in (self.low, self.high))
        part = F.try_divide(self._position(value) - low, high - low) * BINS
        inner = F.floor(F.least(F.greatest(F.coalesce(part, F.lit(1.0)), F.lit(1.0)),
                                F.lit(BINS - 2.0))).cast("int")
        return F.when(value == self.low, 0).when(value == self.high, BINS - 1).otherwise(inner)


def values_at_ranks(
    df: DataFrame, columns: Sequence[str], ranks: Callable[[int], Sequence[int]]
) -> dict[str, tuple[int, list[float]]]:
    """Per column the number of its values, and those at ``ranks(number)``, counted from 1.

    Columns without values are left out.
    """
    columns = list(columns)
    table = reread(
        df.select(*[(column(c).cast("double") + 0.0).alias(f"c{i}") for i, c in enumerate(columns)])
    )
    proper = [F.when(~F.isnan(f"c{i}"), F.col(f"c{i}")) for i in range(len(columns))]
    first = table.agg(
        *[
            F.struct(
                F.count(f"c{i}").alias("n"), F.count(v).alias("proper"),
                F.min(v).alias("low"), F.max(v).alias("high"),
            ).alias(f"c{i}")
            for i, v in enumerate(proper)
        ]
    ).first()
    open_: dict[tuple[int, int], _Bracket] = {}
    found: dict[tuple[int, int], float] = {}
    wanted: dict[int, list[int]] = {}
    for i in range(len(columns)):
        seen = first[f"c{i}"]
        wanted[i] = list(ranks(seen["n"])) if seen["n"] else []
        for rank in wanted[i]:
            if rank > seen["proper"]:
                found[i, rank] = math.nan
            else:
                wide = math.isinf(seen["low"]) or math.isinf(seen["high"])
                open_[i, rank] = _Bracket(i, seen["low"], seen["high"], 0, seen["proper"], wide)
    while True:
        for key, bracket in list(open_.items()):
            if bracket.low == bracket.high:
                found[key] = bracket.low
                del open_[key]
        if not open_:
            break
        brackets = list(set(open_.values()))
        bins = _counted(table, brackets)
        open_ = {
            key: _narrowed(bracket, key[1], bins[brackets.index(bracket)])
            for key, bracket in open_.items()
        }
    return {
        c: (first[f"c{i}"]["n"], [found[i, rank] for rank in wanted[i]])
        for i, c in enumerate(columns) if wanted[i]
    }


def _counted(table: DataFrame, brackets: Sequence[_Bracket]) -> list[list]:
    """The bins of every bracket in order, from one pass."""
    rows = []
    for number, b in enumerate(brackets):
        value = F.col(f"c{b.place}")
        inside = ~F.isnan(value) & (value >= b.low) & (value <= b.high)
        row = F.struct(F.lit(number).alias("b"), b.bin(value).alias("bin"), value.alias("v"))
        rows.append(F.when(inside, row))
    cells = table.select(F.inline(F.array_compact(F.array(*rows)))).groupBy("b", "bin").agg(
        F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    found: list[list] = [[] for _ in brackets]
    for row in cells.collect():  # at most BINS rows per bracket
        found[row["b"]].append(row)
    return [sorted(bins, key=lambda row: row["bin"]) for bins in found]


def _narrowed(bracket: _Bracket, rank: int, bins: Sequence) -> _Bracket:
    """The bin that holds the rank."""
    below = bracket.below
    for row in bins:
        if below + row["n"] >= rank:
            break
        below += row["n"]
    wide = math.isinf(row["low"]) or math.isinf(row["high"])
    other = row["n"] > HEAVY * bracket.rows and not bracket.logarithmic
    return _Bracket(bracket.place, row["low"], row["high"], below, row["n"], wide or other)
