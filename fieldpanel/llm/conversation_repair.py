"""Conversation structure repair by weighted interval parsing (see ``turn_grammar``).

Rows are sorted once over all tasks and numbered in that order, so a conversation of any length
is a run of numbers that may cross tasks. Blocks of at most ``BLOCK`` neighbouring rows are
parsed first; the cells of a conversation that has several are then combined in rounds, at
most ``FAN`` neighbouring cells at a time. Repaired rows are read as a stream sorted by
conversation, each conversation's audit ahead of its rows, so a task holds one audit and one
batch of rows, never a conversation. (A digest of a whole conversation is sequential by nature:
the rows of one conversation pass through one task.)

Defined results: a null role or text is one space. Rows go by turn, nulls first; rows of one
turn by role and then by the text's SHA-256, so copies are adjacent. A null conversation id
is a conversation of its own. An empty role has no initial, so no pair with it is legal. Gaps
that do not fit a long are null. A conversation has rows or is not there; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from fieldpanel.llm import turn_grammar as grammar
from fieldpanel.llm.common import shuffle_width, stage
from fieldpanel.shipping import ship

BLOCK_BITS = 8  # rows of a block: 256
FAN_BITS = 4  # cells combined at a time: 16
_SPACE = " \t\n\x0b\f\r"
_ROW_BITS = 33  # of a number: the row within its task, as numbered by Spark


def ordered(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, digest, pos) with ascending numbers in each conversation."""
    plain = rows.select(
        F.col(conv).cast("bigint").alias("conv"),
        F.col(turn).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    ).withColumn("digest", F.sha2("text", 256))
    # equal rows are spread by the last key; in which order they come makes no difference
    keys = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "digest", "tie")]
    spread = plain.withColumn("tie", F.monotonically_increasing_id())
    width = shuffle_width(rows.sparkSession)
    sorted_ = spread.repartitionByRange(width, *keys).sortWithinPartitions(*keys).drop("tie")
    return stage(sorted_.withColumn("pos", F.monotonically_increasing_id()), "turns")


def with_faults(turns: DataFrame) -> DataFrame:
    """(conv, turn, pos, initial, fault) of every row; fault is b, d, t or -."""
    seen = F.rtrim(F.col("text"), F.lit(_SPACE))
    base = turns.select(
        "conv", "turn", "pos", "role", "digest", F.substring("role", 1, 1).alias("initial"),
        F.substring(seen, -1, 1).alias("ending"),
    )
    first = base.where("ending != ''").groupBy("conv", "role", "digest").agg(
        F.min("pos").alias("pos")
    )
    # the first of equal rows, joined by number: no key is hot
    found = base.join(first.select("pos", F.lit(True).alias("new")), "pos", "left")
    fault = (
        F.when(F.col("ending") == "", "b")
        .when(F.col("new").isNull(), "d")
        .when(~F.col("ending").isin(".", "!", "?"), "t")
        .otherwise("-")
    )
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
    return stage(
        found.select("conv", "turn", "pos", known.alias("initial"), fault.alias("fault")), "faults"
    )


def counts(faults: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated)."""
    per_turn = faults.groupBy("conv", "turn").agg(
        *[F.count_if(F.col("fault") == f).alias(f) for f in "bdt"]
    )
    wide = "decimal(20,0)"
    span = F.max("turn").cast(wide) - F.min("turn").cast(wide) + 1 - F.count("turn")
    return per_turn.groupBy("conv").agg(
        F.coalesce(span, F.lit(0)).alias("gaps"),
        *[F.sum(f).alias(n) for f, n in zip("bdt", ("blank", "duplicate", "truncated"))],
    ).withColumn("gaps", F.col("gaps").try_cast("bigint"))


@F.pandas_udf(T.StringType())
def _parsed(codes: pd.Series) -> pd.Series:
    """A block's initials at both ends, its illegal pairs, and its cell."""

    def parse(code: str) -> str:
        initials = code[::2]
        cell = grammar.write(grammar.span(code))
        return f"{initials[0]}{initials[-1]}|{grammar.illegal_pairs(initials)}|{cell}"

    return codes.map(parse)


@F.pandas_udf(T.StringType())
def _combined(blocks: pd.Series) -> pd.Series:
    """Neighbouring blocks as one."""

    def join(parts: list[str]) -> str:
        ends, illegal, cells = zip(*(part.split("|") for part in parts))
        pairs = zip(ends, ends[1:])
        across = sum(grammar.illegal_pairs(a[1] + b[0]) for a, b in pairs)
        cell = grammar.join([grammar.read(c) for c in cells])
        whole = across + sum(map(int, illegal))
        return f"{ends[0][0]}{ends[-1][1]}|{whole}|{grammar.write(cell)}"

    return blocks.map(join)


@F.pandas_udf(
    T.StructType()
    .add("illegal", T.LongType())
    .add("cost", T.LongType())
    .add("audit", T.StringType())
)
def _answered(blocks: pd.Series) -> pd.DataFrame:
    rows = []
    for block in blocks:
        _, illegal, cell = block.split("|")
        rows.append((int(illegal), *grammar.answer(grammar.read(cell))))
    return pd.DataFrame(rows, columns=["illegal", "cost", "audit"])


def _in_order(value: Column) -> Column:
    """The values of a group of bounded size by their number."""
    return F.transform(F.sort_array(F.collect_list(F.struct("seq", value))), lambda s: s["value"])


def parsed(faults: DataFrame) -> DataFrame:
    """(conv, illegal, cost, audit) of every conversation."""
    task = F.shiftright("pos", _ROW_BITS)
    within = F.col("pos").bitwiseAND((1 << _ROW_BITS) - 1)
    block = F.shiftright(within, BLOCK_BITS)
    row = faults.agg(F.max(block).alias("b"), F.max(task).alias("t")).first()
    if row["b"] is None:
        return faults.select("conv", *[F.lit(0).cast("bigint").alias(c) for c in ("illegal", "cost")],
                             F.lit("").alias("audit"))
    bits = int(row["b"]).bit_length()
    code = F.concat("initial", "fault").alias("value")
    numbered = faults.select(
        "conv", F.col("pos").alias("seq"), code,
        (F.shiftleft(task, bits) + block).alias("block"),
    )
    cells = numbered.groupBy("conv", "block").agg(
        F.array_join(_in_order(F.col("value")), "").alias("codes")
    )
    cells = stage(cells.select("conv", F.col("block").alias("seq"),
                               _parsed("codes").alias("value")), "cells")
    done, left = None, cells
    for _ in range(-(-(bits + int(row["t"]).bit_length()) // FAN_BITS) + 1):
        many = left.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
        split = left.join(
            many.withColumnRenamed("conv", "of"), F.col("conv").eqNullSafe(F.col("of"))
        ).drop("of")
        whole = split.where("n = 1").select("conv", "value")
        done = whole if done is None else done.unionByName(whole)
        left = split.where("n > 1").select("conv", "seq", "value")
        if left.isEmpty():
            break
        up = F.shiftright("seq", FAN_BITS)
        grouped = left.groupBy("conv", up.alias("up")).agg(
            _in_order(F.col("value")).alias("blocks")
        )
        left = stage(
            grouped.select("conv", F.col("up").alias("seq"), _combined("blocks").alias("value")),
            "cells",
        )
    found = done.select("conv", _answered("value").alias("a"))
    return found.select("conv", "a.illegal", "a.cost", "a.audit")


class _Writer:
    """Follows one audit through its conversation's rows."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.last = audit, 0, ""

    def _insert(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield "I", self._next(), ""

    def _next(self) -> str:
        """The role that the grammar wants here: user first and after an assistant."""
        self.last = "a" if self.last == "u" else "u"
        return {"u": "user", "a": "assistant"}[self.last]

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self._insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.last = role[:1]
            yield edit, role, text
        elif edit == "R":
            yield edit, self._next(), text

    def end(self) -> Iterator[tuple[str, str, str]]:
        yield from self._insert()


def _streamed(turns: DataFrame, answers: DataFrame) -> DataFrame:
    """Every conversation's audit followed by its rows, sorted within tasks."""
    rows = turns.select("conv", "pos", "role", "text")
    heads = answers.select(
        "conv", F.lit(-1).cast("bigint").alias("pos"), F.lit("").alias("role"),
        F.col("audit").alias("text"),
    )
    return rows.unionByName(heads).repartition("conv").sortWithinPartitions(
        F.col("conv").asc_nulls_first(), "pos"
    )


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv, None) at a conversation's end, else (conv, (edit, role, text)) per repaired row."""
    writer, conv = None, None
    for batch in batches:
        for name, pos, role, text in zip(*batch.columns):
            if pos.as_py() == -1:
                if writer is not None:
                    yield from ((conv, step) for step in writer.end())
                    yield conv, None
                conv, writer = name.as_py(), _Writer(text.as_py())
            else:
                yield from ((conv, s) for s in writer.row(role.as_py(), text.as_py()))
    if writer is not None:
        yield from ((conv, step) for step in writer.end())
        yield conv, None


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, digests, digest, first = [], [], hashlib.sha256(), True
    for conv, step in _follow(batches):
        if step is not None:
            digest.update(f"{'' if first else chr(10)}{step[1]}:{step[2]}".encode())
            first = False
            continue
        names.append(conv)
        digests.append(digest.hexdigest())
        digest, first = hashlib.sha256(), True
        if len(names) == 4096:
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(digests)],
                                             ["conv", "repaired_sha256"])
            names, digests = [], []
    yield pa.RecordBatch.from_arrays(
        [pa.array(names, pa.int64()), pa.array(digests, pa.string())], ["conv", "repaired_sha256"]
    )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    titles = ["conv", "place", "edit", "role", "text"]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], titles)

    rows: list[tuple] = []
    place, size = 0, 0
    for conv, step in _follow(batches):
        if step is None:
            place = 0
            continue
        rows.append((conv, place, *step))
        place, size = place + 1, size + len(step[2])
        if len(rows) == 4096 or size > 1 << 22:
            yield batch(rows)
            rows, size = [], 0
    yield batch(rows)


@dataclass(frozen=True)
class Repair:
    """``turns`` as read, and per conversation (conv, illegal, cost, audit) and the counts."""

    turns: DataFrame
    counts: DataFrame
    answers: DataFrame

    def rows(self) -> DataFrame:
        """The repaired rows: (conv, place, edit, role, text)."""
        schema = "conv bigint, place bigint, edit string, role string, text string"
        return _streamed(self.turns, self.answers).mapInArrow(_rows, schema)

    def summary(self) -> DataFrame:
        """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)."""
        digests = _streamed(self.turns, self.answers).mapInArrow(
            _digests, "conv bigint, repaired_sha256 string"
        )
        found = self.answers.alias("a")
        for side, name in ((self.counts, "c"), (digests, "d")):
            same = F.col("a.conv").eqNullSafe(F.col(f"{name}.conv"))
            found = found.join(side.alias(name), same)
        return found.select(
            F.col("a.conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated",
            "illegal", "cost", "audit", "repaired_sha256",
        )


def repair(
    rows: DataFrame,
    *,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> Repair:
    """Find the cheapest repair of every conversation in ``rows``.

    Keeping a row costs 0, another role 3, deleting 4 (a must for blank and repeated rows),
    inserting an empty row 3; a truncated row that stays costs 3 more.
    """
    ship(rows.sparkSession)
    turns = ordered(rows, conv, turn, role, text)
    faults = with_faults(turns)
    return Repair(turns, counts(faults), stage(parsed(faults), "answers"))
