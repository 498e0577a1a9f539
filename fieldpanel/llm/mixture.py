"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document draws the key ``-ln(u) / weight`` from its own hash and its quality weight;
in key order a source's documents form a weighted sample without replacement of any
length. A source takes complete epochs first (every document once per epoch), then the
documents of smallest key until the rest of its token budget is used; the document at the
border is taken if that brings the source nearer to its target.

The order within a source is never sorted as a whole. Keys are cut into ranges of about
``RANGE_ROWS`` documents by the share of keys expected below them, which the source's own
histogram of weights gives; ranges are summed before they are shuffled, and only the one
range per source that holds the border is sorted, so a source of any size takes part.

Defined results: null text has size 0; null sources form one source; a missing, negative
or NaN weight counts as ``LEAST_WEIGHT``; documents that repeat a key and an identifier
are ordered by size; sources without words get target 0; an empty table gives no rows;
extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldpanel.llm.common import WORD, fresh, stage, text_of
from fieldpanel.operators.ordering import running_total

RANGE_ROWS = 4096
LEAST_WEIGHT = 1e-3
MEASURES = ["size", "_key", "_bucket"]


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def quality_weight(text: Column) -> Column:
    """Share of the text that is letters and plain spaces: a cheap stand-in for quality."""
    other = F.length(F.regexp_replace(text, r"[\p{L} ]+", ""))
    return 1.0 - other / F.greatest(F.length(text), F.lit(1))


def safe_weight(weight: Column) -> Column:
    safe = F.when(weight > LEAST_WEIGHT, weight).otherwise(LEAST_WEIGHT)
    return F.when(F.isnan(safe), F.lit(LEAST_WEIGHT)).otherwise(safe)


def sampling_key(doc_id: Column, weight: Column, seed: int) -> Column:
    """``-ln(u) / weight`` with u in (0, 1) from 52 bits of a digest: reruns agree."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), doc_id.cast("string")))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")
    u = (bits + F.lit(0.5)) / F.lit(float(2**52))
    return -F.log(u) / weight


def weight_bucket(weight: Column) -> Column:
    """Number of the weight's quarter octave; those above 2**60 share the last one."""
    return F.least(F.floor(4 * F.log2(weight)), F.lit(240).cast("bigint"))


def share_below(key: Column, curve: Column) -> Column:
    """Expected share of keys up to ``key``; ``curve`` holds (bucket, share) of the weights.

    A sum of monotone terms in a fixed order, so it is monotone in the key.
    """

    def add(total: Column, part: Column) -> Column:
        middle = F.pow(F.lit(2.0), (part["bucket"] + 0.5) / 4)
        return total + part["share"] * (1 - F.exp(-key * middle))

    return F.aggregate(curve, F.lit(0.0), add)


def measures(
    body: Column, drawn: Column, seed: int = 7, quality: Column | None = None
) -> list[Column]:
    """The columns ``MEASURES`` of a document: its words, random key and weight bucket."""
    weight = safe_weight(quality_weight(body) if quality is None else quality)
    return [n_words(body), sampling_key(drawn, weight, seed), weight_bucket(weight)]


def targets(sources: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """Add ``target`` to (source, source_size): ``share`` of all tokens, dealt by weight.

    Sources in code point order, null last, weigh ``weights``, repeating. What exceeds
    ``cap`` times a source's size is dealt again among the rest until none is above. In the
    order in which a rising water level caps them, running sums give every source the
    level if it were the first not to be capped; the first one that holds is the level.
    """
    ranked = running_total(
        sources, [F.col("source").asc_nulls_last()], F.lit(1).cast("bigint"), "_rank"
    )
    turn = F.pmod(F.col("_rank") - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    ranked = stage(
        ranked.withColumns({"_w": weight, "_cap": F.col("source_size") * F.lit(float(cap))}).drop(
            "_rank"
        ),
        "sources",
    )
    total, weighed = ranked.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)) * F.lit(float(share)), F.sum("_w")
    ).first()
    order = [F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last()]
    summed = running_total(ranked, order, F.col("_cap"), "_caps")
    summed = running_total(summed, order, F.col("_w"), "_ws")
    level = (F.lit(total) - F.col("_caps") + F.col("_cap")) / (
        F.lit(weighed) - F.col("_ws") + F.col("_w")
    )
    found = summed.where(level <= F.col("_cap") / F.col("_w")).agg(F.min_by(level, "_ws")).first()
    aim = F.col("_cap")
    if found[0] is not None:  # else the caps hold less than is shared
        aim = F.least(aim, F.lit(found[0]) * F.col("_w"))
    return ranked.withColumn("target", aim).drop("_w", "_cap")


def mix(
    docs: DataFrame,
    *,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 7,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    quality: Column | None = None,
    drawn_from: Column | None = None,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    ``copies`` is how often the mix holds the document, ``taken`` the words this makes.
    ``drawn_from`` is what the random keys are drawn from, by default the identifier.
    """
    drawn = F.col(doc_id) if drawn_from is None else drawn_from
    measured = measures(text_of(text), drawn, seed, quality)
    sized = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        *[value.alias(name) for name, value in zip(MEASURES, measured)],
    )
    plan = deal(stage(sized, "sized"), weights, share, cap)
    return plan.drop("_key", "_epochs").withColumn("taken", F.col("copies") * F.col("size"))


def deal(
    sized: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
) -> DataFrame:
    """The mix of a written table (doc_id, source and ``MEASURES``), one row per document.

    Columns: doc_id, source, size, source_size, target, _key, _epochs, copies. Of a source's
    documents by (_key, doc_id, size) the first ones have one copy more than ``_epochs``.
    """
    sums = (
        sized.groupBy("source", "_bucket")
        .agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
        .groupBy("source")
        .agg(
            F.sum("size").alias("source_size"), F.sum("n").alias("_n"),
            F.array_sort(F.collect_list(F.struct(F.col("_bucket").alias("bucket"), "n")))
            .alias("_weights"),
        )
    )
    curve = F.transform(
        "_weights", lambda w: F.struct(w["bucket"], (w["n"] / F.col("_n")).alias("share"))
    )
    sources = stage(sums.withColumn("_curve", curve).drop("_weights"), "source_sizes")
    budget = targets(sources.select("source", "source_size"), weights, share, cap)
    same = F.col("s.source").eqNullSafe(F.col("b.source"))
    budget = sources.alias("s").join(budget.alias("b"), same).select(
        "s.source", "s.source_size", "_n", "_curve", "target"
    )
    epochs = F.floor(F.try_divide("target", "source_size"))
    budget = stage(
        budget.withColumn("_epochs", F.coalesce(epochs, F.lit(0)))
        .withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size"))
        .withColumn("_ranges", F.ceil(F.col("_n") / RANGE_ROWS)),
        "budgets",
    )

    place = F.floor(share_below(F.col("_key"), F.col("_curve")) * F.col("_ranges"))
    same = F.col("d.source").eqNullSafe(F.col("b.source"))
    ranged = sized.alias("d").join(budget.alias("b"), same).select(
        *[f"d.{c}" for c in sized.columns if c != "_bucket"],
        *[c for c in budget.columns if c not in ("source", "_curve", "_n")],
        F.least(place, F.col("_ranges") - 1).alias("_range"),
    )
    before = Window.partitionBy("source").orderBy("_range")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        ranged.groupBy("source", "_range", "_rest")
        .agg(F.sum("size").alias("_sum"))
        .withColumn("_start", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        .select(
            F.col("source").alias("_source"), F.col("_range").alias("_at"), "_start",
            ((F.col("_start") <= F.col("_rest")) & (F.col("_start") + F.col("_sum") > F.col("_rest")))
            .alias("_border"),
        )
    )
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_at"))
    placed = stage(ranged.join(ranges, same), "placed")

    inside = Window.partitionBy("source", "_range").orderBy("_key", "doc_id", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, 0)
    first = F.col("_start") + F.sum("size").over(inside) - F.col("size")
    columns = ["doc_id", "source", "size", "source_size", "target", "_key", "_epochs"]
    border = placed.where("_border").withColumn("_first", first).select(
        *columns, (F.col("_epochs") + (F.col("_first") + F.col("size") / 2 <= F.col("_rest"))
                   .cast("bigint")).alias("copies"),
    )
    whole = placed.where(~F.col("_border")).select(
        *columns,
        (F.col("_epochs") + (F.col("_start") <= F.col("_rest")).cast("bigint")).alias("copies"),
    )
    return whole.unionAll(border)


def mixed(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, columns unchanged.

    ``docs`` is written to the shared folder first with its measures, so that a row is known by
    its file and number there; of rows that repeat an identifier and a text each has its own
    copies. The mix ends at one row of every source, and whether a row comes before that one
    shows in the row itself, so texts are neither measured twice nor shuffled.
    """
    own = fresh(
        docs.columns, "_mix_drawn", "_mix_size", "_mix_key", "_mix_bucket", "_mix_at",
        "_mix_source", "_mix_epochs", "_mix_last", "_mix_copy",
    )
    drawn = F.struct(F.col(doc_id).cast("bigint").alias("id"), F.xxhash64(text_of(text)).alias("d"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    measured = zip(own, [drawn, *measures(text_of(text), drawn)])
    landed = stage(docs.select(*columns, *[value.alias(name) for name, value in measured]), "mixing")
    at = F.struct(
        F.col(own[0]).alias("drawn"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )
    plan = deal(
        landed.select(
            at.alias("doc_id"), F.col(source).alias("source"),
            *[F.col(n).alias(name) for n, name in zip(own[1:], MEASURES)],
        )
    )
    more = F.when(F.col("copies") > F.col("_epochs"), F.struct("_key", "doc_id"))
    last = stage(
        plan.groupBy(F.col("source").alias(own[5])).agg(
            F.min("_epochs").alias(own[6]), F.max(more).alias(own[7])
        ),
        "last",
    )
    placed = landed.select(
        *columns, F.struct(F.col(own[2]).alias("_key"), at.alias("doc_id")).alias(own[4])
    )
    copies = F.col(own[6]) + F.coalesce(F.col(own[4]) <= F.col(own[7]), F.lit(False)).cast("bigint")
    times = F.explode(F.array_repeat(F.lit(0), copies.cast("int"))).alias(own[8])
    same = F.col(source).eqNullSafe(F.col(own[5]))
    return placed.join(last, same).select(*columns, times).drop(own[8])
