"""Personal data: fixed patterns, and information-theoretic sanitisation of their context.

Base spans (email, ip, card, phone) come from patterns. Their values are the protected
entities. Around every mention, the terms that a window reaches are counted against the whole
corpus: with n(c, t) occurrences of term t in windows of entity c, n(c) of all terms there,
n(t) occurrences of t and N terms in the corpus, t discloses

    PMI(c; t) / IC(c) = log2(n(c,t) N / (n(c) n(t))) / log2(N / n(c))

of c: 1 if t occurs nowhere else, 0 if it is independent. Where the log-likelihood ratio says
that chance does not explain how often they meet (at least ``significance``, 10.83 being one
case in a thousand) and t discloses at least ``threshold``, t becomes a span of kind ``term``
wherever it stands in a document that mentions c; it is generalised, and removed from
``remove`` on. Base spans always stay. Emails, addresses, cards and phones are removed.

Mentions and terms of a document meet in cells of the window's width, so the work grows with
the number of both and not with their product, nor with the length of the text.

Patterns start only where a run of their first characters starts (or at the last match's
end), and never backtrack over a run, so long texts without a match take linear time.

Defined results: null text counts as empty; matches that fail a check are dropped without
another try; terms that overlap a base span are never spans of their own; rows of equal
identifier are kept apart; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fieldpanel.llm.common import let, stage, text_of
from fieldpanel.operators.joins import attach

KINDS = ["email", "ip", "card", "phone", "term"]

# The base patterns, written so that no run is scanned twice.
PATTERNS = {
    "email": (
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
    ),
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
IP_PARTS = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"

WINDOW = 80  # characters on either side of a mention
TERM = r"[\p{L}\p{N}]{3,}"
SIGNIFICANCE, THRESHOLD, REMOVE = 10.83, 0.9, 0.98
FEW = 64  # mentions of a text that its terms are compared with one by one
_CHUNK = 512


def _running(lengths: Column, largest: bool = False) -> Column:
    """Inclusive running sums, or maxima, of an array of numbers that are not negative, in
    chunks so that long ones stay cheap."""

    def merged(one: Column, two: Column) -> Column:
        return F.greatest(one, two) if largest else one + two

    def along(values: Column) -> Column:
        start = F.struct(
            F.lit(0).cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("sums")
        )

        def add(acc: Column, x: Column) -> Column:
            at = merged(acc["at"], x)
            return F.struct(at.alias("at"), F.concat(acc["sums"], F.array(at)).alias("sums"))

        return F.aggregate(values, start, add, lambda acc: acc["sums"])

    def shifted(chunks: Column) -> Column:
        totals = along(F.transform(chunks, lambda c: F.element_at(c, -1)))
        starts = F.concat(F.array(F.lit(0).cast("bigint")), totals)
        return F.flatten(
            F.zip_with(
                chunks, F.slice(starts, 1, F.size(chunks)),
                lambda c, before: F.transform(c, lambda x: merged(x, before)),
            )
        )

    n = F.size(lengths)
    parts = F.transform(
        F.sequence(F.lit(0), F.floor((n - 1) / _CHUNK)),
        lambda k: along(F.slice(lengths, (k * _CHUNK + 1).cast("int"), F.lit(_CHUNK))),
    )
    empty = F.array().cast("array<bigint>")
    return F.when(n == 0, empty).otherwise(let(parts, shifted))


def located(text: Column, pattern: str) -> Column:
    """All matches as array<struct<start, end, value>>; code points, end exclusive."""

    def spans(found: Column) -> Column:
        matches, gaps = found["matches"], found["gaps"]
        lengths = F.zip_with(
            F.slice(gaps, 1, F.size(matches)), matches,
            lambda g, m: (F.length(g) + F.length(m)).cast("bigint"),
        )
        return F.zip_with(
            matches, _running(lengths),
            lambda m, end: F.struct((end - F.length(m)).alias("start"), end.alias("end"),
                                    m.alias("value")),
        )

    both = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("matches"),
        F.split(text, pattern, -1).alias("gaps"),
    )
    empty = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    return F.when(text.rlike(pattern), let(both, spans)).otherwise(empty)


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(IP_PARTS)
    if kind == "card":
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """array<struct<kind, start, end, value>> by kind as listed, then start."""

    def of(kind: str) -> Column:
        # what every match holds, so that most texts skip the pattern
        needed = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}
        found = located(text, PATTERNS[kind])
        if kind in needed:
            empty = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
            found = F.when(needed[kind], found).otherwise(empty)
        return F.transform(
            F.filter(found, lambda s: _valid(kind, s["value"])),
            lambda s: F.struct(
                F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                s["value"].alias("value"),
            ),
        )

    return F.concat(*[of(kind) for kind in KINDS[:4]])


def _cells(first: Column, last: Column, window: int) -> Column:
    """The cells that code points ``first`` to ``last`` lie in."""
    return F.sequence(F.floor(first / window), F.floor(last / window))


def _near(terms: DataFrame, mentions: DataFrame, window: int) -> DataFrame:
    """(row, start, end, term, entity, over) of terms that a mention's window reaches.

    ``terms`` is (row, start, end, term), ``mentions`` (row, first, last, entity) with the last
    exclusive. ``over`` says whether the term and the mention overlap.
    """
    left = terms.withColumn(
        "cell", F.explode(_cells(F.col("start"), F.col("end") - 1, window))
    )
    low = F.greatest(F.col("first") - window, F.lit(0).cast("bigint"))
    right = mentions.withColumn("cell", F.explode(_cells(low, F.col("last") + window - 1, window)))
    reached = (F.col("start") < F.col("last") + window) & (F.col("end") > F.col("first") - window)
    over = (F.col("start") < F.col("last")) & (F.col("first") < F.col("end"))
    return left.join(right, ["row", "cell"]).where(reached).select(
        "row", "start", "end", "term", "entity", over.alias("over")
    )


def disclosing(
    pairs: DataFrame, corpus_terms: DataFrame, significance: float, threshold: float
) -> DataFrame:
    """(entity, term, disclosure) of the terms that give an entity away.

    ``pairs`` has a row per term occurrence in a window (entity, term), ``corpus_terms`` one per
    term (term, n_term).
    """
    together = stage(
        pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both")), "together"
    )
    entities = together.groupBy("entity").agg(F.sum("n_both").alias("n_entity"))
    total = float(corpus_terms.agg(F.sum("n_term")).first()[0] or 1)
    both, entity, term = F.col("n_both"), F.col("n_entity"), F.col("n_term")
    expected = entity * term / F.lit(total)

    def part(seen: Column, chance: Column) -> Column:
        return F.when((seen > 0) & (chance > 0), seen * F.log(seen / chance)).otherwise(0.0)

    # of the table of occurrences with and without the entity, of the term and of all others
    ratio = 2 * (
        part(both, expected)
        + part(entity - both, entity - expected)
        + part(term - both, term - expected)
        + part(total - entity - term + both, total - entity - term + expected)
    )
    told = F.log2(both * total / (entity * term))
    needed = F.log2(F.lit(total) / entity)
    return (
        together.join(entities, "entity")
        .join(corpus_terms, "term")
        .where((both > expected) & (ratio >= significance))
        .withColumn("disclosure", F.when(needed > 0, told / needed).otherwise(0.0))
        .where(F.col("disclosure") >= threshold)
        .select("entity", "term", "disclosure")
    )


def find(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    significance: float = SIGNIFICANCE,
    threshold: float = THRESHOLD,
    remove: float = REMOVE,
    keep_text: bool = False,
) -> DataFrame:
    """One row per document: doc_id, base, spans (and text if asked for).

    ``base`` and ``spans`` are array<struct<kind, start, end, action>>.
    """
    body = text_of(text)
    kept = [body.alias("text")] if keep_text else []
    seen = docs.select(
        F.col(doc_id).alias("doc_id"), body.alias("_text"), base_spans(body).alias("_spans")
    )
    nothing = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    rows = stage(
        seen.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "_spans",
            # the terms of texts that mention an entity; no other text can have a span
            F.when(F.size("_spans") > 0, located(F.col("_text"), TERM)).otherwise(nothing)
            .alias("_terms"),
            *[F.col("_text").alias("text") for _ in kept],
        ),
        "base_spans",
    )
    terms = rows.select("row", F.explode("_terms").alias("t")).select(
        "row", "t.start", "t.end", F.lower("t.value").alias("term")
    )
    # Only terms near a mention are counted with it. Where mentions are few they are compared with
    # every term in place, so that other terms need not travel; where they are many, most
    # terms are near one anyway, and all of them go to the cells.
    within = F.filter(
        "_terms",
        lambda t: F.exists(
            "_spans",
            lambda s: (t["start"] < s["end"] + window) & (t["end"] > s["start"] - window),
        ),
    )
    candidates = rows.select(
        "row", F.explode(F.when(F.size("_spans") <= FEW, within).otherwise(F.col("_terms"))).alias("t")
    ).select("row", "t.start", "t.end", F.lower("t.value").alias("term"))
    plain = F.regexp_replace(F.lower(F.col("s.value")), r"[^\p{L}\p{N}]", "")
    mentions = stage(
        rows.select("row", F.explode("_spans").alias("s")).select(
            "row", F.col("s.start").alias("first"), F.col("s.end").alias("last"),
            F.concat_ws(":", "s.kind", plain).alias("entity"),
        ),
        "mentions",
    )
    near = stage(_near(candidates, mentions, window), "near")
    over = stage(near.where("over").select("row", "start").distinct(), "over")
    # each occurrence counts once for an entity, however often that is mentioned around it
    pairs = near.join(over, ["row", "start"], "left_anti").select(
        "row", "start", "term", "entity"
    ).distinct()
    words = docs.select(
        F.explode(F.regexp_extract_all(F.lower(body), F.lit(TERM), F.lit(0))).alias("term")
    )
    corpus = stage(words.groupBy("term").agg(F.count(F.lit(1)).alias("n_term")), "terms")
    told = disclosing(pairs, corpus, significance, threshold)
    mentioned = mentions.select("row", "entity").distinct()
    added = (
        # the disclosing terms are broadcast only if they measure small
        attach(terms, told, ["term"])
        .join(mentioned, ["row", "entity"], "left_semi")
        .join(over, ["row", "start"], "left_anti")
        .groupBy("row", "start", "end")
        .agg(F.max("disclosure").alias("d"))
        .groupBy("row")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(
                        "start", "end",
                        F.when(F.col("d") >= remove, "remove").otherwise("generalise")
                        .alias("action"),
                    )
                )
            ).alias("_added")
        )
    )
    base = F.transform(
        "_spans",
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"),
                           s["end"].alias("end"), F.lit("remove").alias("action")),
    )
    found = F.transform(
        F.coalesce("_added", F.array().cast("array<struct<start:bigint,end:bigint,action:string>>")),
        lambda s: F.struct(F.lit("term").alias("kind"), s["start"].alias("start"),
                           s["end"].alias("end"), s["action"].alias("action")),
    )
    return rows.drop("_terms").join(added, "row", "left").select(
        "doc_id", base.alias("base"), F.concat(base, found).alias("spans"),
        *["text" for _ in kept],
    )


def _cut(pieces: Column, start: Column, end: Column) -> Column:
    """Code points from ``start`` to ``end`` of a text in pieces of ``_CHUNK`` code points."""
    first, last = F.floor(start / _CHUNK), F.floor((end - 1) / _CHUNK)
    some = F.slice(pieces, (first + 1).cast("int"), (last - first + 1).cast("int"))
    found = F.substring(
        F.array_join(some, ""), (start - first * _CHUNK + 1).cast("int"),
        (end - start).cast("int"),
    )
    return F.when(end > start, found).otherwise("")


def generalised(value: Column) -> Column:
    """What a term looks like: numbers keep their leading half, words whether they are names."""
    half = F.floor(F.length(value) / 2).cast("int")
    number = F.rpad(F.substring(value, F.lit(1), F.length(value) - half), F.length(value), F.lit("x"))
    return F.when(value.rlike("^[0-9]+$"), number).when(
        value.rlike(r"^\p{Lu}"), "[name]"
    ).otherwise("[word]")


def redact(text: Column, spans: Column) -> Column:
    """The text with base spans replaced by their kind, and terms generalised or removed.

    Spans that begin inside an earlier one are replaced with it. Every piece of the text is
    cut out once, so long texts with many spans take linear time.
    """

    def written(parts: Column) -> Column:
        pieces, ordered, reached = parts["pieces"], parts["ordered"], parts["reached"]

        def piece(s: Column, i: Column) -> Column:
            at = F.when(i == 0, F.lit(0).cast("bigint")).otherwise(F.get(reached, i - 1))
            mark = F.when(s["kind"] != "term", F.concat(F.lit("["), s["kind"], F.lit("]")))
            mark = mark.when(
                s["action"] == "generalise", generalised(_cut(pieces, s["start"], s["end"]))
            ).otherwise("")
            inside = s["start"] < at
            return F.concat(
                _cut(pieces, at, F.greatest(s["start"], at)), F.when(inside, "").otherwise(mark)
            )

        end = F.coalesce(F.try_element_at(reached, F.lit(-1)), F.lit(0).cast("bigint"))
        rest = _cut(pieces, end, F.greatest(F.length(text).cast("bigint"), end))
        return F.concat(F.array_join(F.transform(ordered, piece), ""), rest)

    ordered = F.sort_array(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                              s["kind"].alias("kind"), s["action"].alias("action")))
    )
    # how far the spans up to each one reach
    ends = F.transform(ordered, lambda s: s["end"])
    return let(
        F.struct(
            F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_CHUNK}}}"), F.lit(0)).alias("pieces"),
            ordered.alias("ordered"), _running(ends, largest=True).alias("reached"),
        ),
        written,
    )
