"""Quality classifier with hierarchical empirical Bayes over sites.

A logistic model on character and word statistics gives each document's own evidence.
Its sums over all documents, grouped by host and by path within the host, give site
posteriors: a path is shrunk towards its host and a host towards the global rate, each by
a Beta prior whose strength is estimated from how much the sites really differ (method of
moments), so sparse sites say little. A document's posterior odds are its own odds times
the odds of its path without itself, relative to the global odds.

The model is fitted on labelled documents only, about ``fit_rows`` of them at most, chosen
by a hash of the identifier; all other statistics cover every document.

Defined results: null text counts as empty; null hosts and null paths are sites of their
own; labels that are null or name no document are ignored; with no usable labels every
document has even odds and is kept, with labels of one class only all have that class's
smoothed odds; repeated rows get equal scores; an empty table gives no rows; extra
columns pass through ``score`` unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from fieldpanel.llm.common import fresh, let, stage, text_of

FIT_ROWS = 20_000
KEEP_ABOVE = 0.5
FEATURES = [
    "log_words", "word_length", "distinct_words", "distinct_lines", "upper", "symbols",
    "digits", "repeats",
]
UNIT = 2.0**-32  # chances are summed in whole units: sums do not depend on their order
_EDGE = 1e-4  # rates are kept this far from 0 and 1


def features(text: Column) -> Column:
    """array<double> in the order of ``FEATURES``; one pass per statistic, whole texts."""

    def ratio(part: Column, whole: Column) -> Column:
        return part.cast("double") / F.greatest(whole, F.lit(1)).cast("double")

    def left(pattern: str) -> Column:
        """Share of characters outside ``pattern``."""
        return ratio(F.length(F.regexp_replace(text, pattern, "")), F.length(text))

    def of_words(words: Column) -> Column:
        neighbours = F.zip_with(
            words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: a == b
        )
        return F.array(
            F.log1p(F.size(words).cast("double")),
            ratio(F.length(text), F.size(words)),
            ratio(F.size(F.array_distinct(words)), F.size(words)),
            ratio(F.size(F.filter(neighbours, lambda same: same)), F.size(words)),
        )

    words = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, r"\n"), lambda line: line != "")
    found = let(words, of_words)
    return F.concat(
        F.slice(found, 1, 3),
        F.array(
            let(lines, lambda x: ratio(F.size(F.array_distinct(x)), F.size(x))),
            left(r"[^\p{Lu}]+"),
            left(r"[\p{L}\p{N}\s.,;:'\"()-]+"),
            left(r"[^\p{N}]+"),
        ),
        F.slice(found, 4, 1),
    )


def fit(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, fit_rows: int) -> list[float]:
    """Intercept and weights of the document model."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    total = known.count()
    share = int(1_000_000 * min(1.0, fit_rows / max(total, 1)))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share).select(
        F.col("doc_id").alias("_labelled"), F.col("quality").cast("double").alias("label")
    )
    texts = docs.select(F.col(doc_id).alias("_id"), text_of(text).alias("_text"))
    rows = stage(
        texts.join(chosen, F.col("_id") == F.col("_labelled")).select(
            "label", features(F.col("_text")).alias("x")
        ),
        "labelled",
    )
    n, good = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if n == 0:
        return [0.0] * (len(FEATURES) + 1)
    if good in (0, n):
        return [math.log((good + 0.5) / (n - good + 0.5)), *[0.0] * len(FEATURES)]
    model = LogisticRegression(regParam=1e-4, maxIter=100).fit(
        rows.select("label", array_to_vector("x").alias("features"))
    )
    # the fit's sums have no fixed order: what differs in the last digits is cut off
    return [round(float(w), 6) for w in (model.intercept, *model.coefficients.toArray())]


def _logit(p: Column) -> Column:
    safe = F.least(F.greatest(p, F.lit(_EDGE)), F.lit(1 - _EDGE))
    return F.log(safe / (1 - safe))


def _strength(between: float, mean: float) -> float:
    """Prior strength of a Beta with this variance between sites."""
    spread = mean * (1 - mean)
    return min(max(spread / between - 1, 1.0), 1e6) if between > 0 else 1e6


def _between(sites: DataFrame, parent: Column) -> float:
    """Variance of true site rates around ``parent``: observed less sampling variance."""
    rate = F.col("good") / F.col("n")
    noise = parent * (1 - parent) / F.col("n")
    row = sites.agg(F.avg(F.pow(rate - parent, 2) - noise)).first()
    return round(row[0] or 0.0, 12)


def score(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    path: str = "lang",
    fit_rows: int = FIT_ROWS,
    keep_above: float = KEEP_ABOVE,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` with struct column ``quality``: classifier, host, path, posterior, kept.

    ``columns`` are the columns of ``docs`` to return, by default all.
    """
    weights = fit(docs, labels, doc_id, text, fit_rows)
    kept = docs.columns if columns is None else list(columns)
    own = fresh(docs.columns, "_own", "_path", "_host", "quality", "_of_host", "_of_path")

    def evidence(x: Column) -> Column:
        terms = [F.lit(w) * F.element_at(x, i + 1) for i, w in enumerate(weights[1:])]
        return sum(terms, F.lit(weights[0]))

    odds = let(features(text_of(text)), evidence)
    judged = stage(
        docs.select(
            *[F.col(f"`{c}`") for c in kept], odds.alias(own[0]),
            F.col(host).alias(own[4]), F.col(path).alias(own[5]),
        ),
        "judged",
    )
    chance = 1 / (1 + F.exp(-F.col(own[0])))
    units = F.round(chance / UNIT).cast("decimal(20,0)")
    paths = stage(
        judged.groupBy(F.col(own[4]).alias("host"), F.col(own[5]).alias("path"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(units).alias("units"))
        .withColumn("good", F.col("units").cast("double") * UNIT),
        "paths",
    )
    hosts = stage(
        paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("units").alias("units"))
        .withColumn("good", F.col("units").cast("double") * UNIT),
        "hosts",
    )
    n, units = hosts.agg(F.sum("n"), F.sum("units")).first()
    mean = min(max(float(units) * UNIT / n, _EDGE), 1 - _EDGE) if n else 0.5
    host_strength = _strength(_between(hosts, F.lit(mean)), mean)
    host_rate = (F.col("good") + host_strength * mean) / (F.col("n") + host_strength)
    rated = hosts.select(F.col("host").alias("h"), host_rate.alias("host_rate"))
    sites = paths.join(rated, F.col("host").eqNullSafe(F.col("h"))).drop("h")
    path_strength = _strength(_between(sites, F.col("host_rate")), mean)
    sites = stage(
        sites.select(
            F.col("host").alias(own[2]),
            F.col("path").alias(own[1]),
            F.struct("host_rate", "n", "good").alias(own[3]),
        ),
        "sites",
    )
    site = F.col(own[3])
    prior = path_strength * site["host_rate"]
    path_rate = (prior + site["good"]) / (path_strength + site["n"])
    joined = judged.join(
        sites, F.col(own[4]).eqNullSafe(F.col(own[2])) & F.col(own[5]).eqNullSafe(F.col(own[1]))
    )
    others = (prior + site["good"] - chance) / (path_strength + site["n"] - 1)
    posterior = 1 / (1 + F.exp(-(F.col(own[0]) + _logit(others) - _logit(F.lit(mean)))))
    return joined.withColumn(
        own[3],
        F.struct(
            chance.alias("classifier"),
            site["host_rate"].alias("host"),
            path_rate.alias("path"),
            posterior.alias("posterior"),
            (posterior >= keep_above).alias("kept"),
        ),
    ).select(*[F.col(f"`{c}`") for c in kept], F.col(own[3]).alias("quality"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, columns unchanged."""
    [name] = fresh(docs.columns, "quality")
    inner = docs if name == "quality" else docs.withColumnRenamed("quality", name)
    kept = score(inner, labels).where(F.col("quality.kept")).drop("quality")
    return kept if name == "quality" else kept.withColumnRenamed(name, "quality")
