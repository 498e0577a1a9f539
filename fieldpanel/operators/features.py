"""Normalization, encoding, discretization, imputation and splitting."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from fieldpanel.functions.columns import key_text, md5_number, one_row
from fieldpanel.operators.joins import attach
from fieldpanel.operators.ordering import MAX_SINGLE_SORT_ROWS, positions
from fieldpanel.operators.profile import column, distinct_numbers
from fieldpanel.operators.quantiles import values_at_ranks
from fieldpanel.staging import stage

# Category names from the lowest third to the highest.
AMOUNT_LABELS = ("Low", "Medium", "High")
TEMPERATURE_LABELS = ("Cold", "Temperate", "Hot")
THIRDS = (0.33, 0.66)


# --- scaling ---------------------------------------------------------------


def minmax_normalize(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add ``{column: new name}`` scaled to [0, 1]; a constant column becomes 0."""
    stats = one_row(
        df,
        **{f"min_{i}": F.min(c) for i, c in enumerate(columns)},
        **{f"max_{i}": F.max(c) for i, c in enumerate(columns)},
    )
    return df.withColumns(
        {
            out: minmax(F.col(c), stats[f"min_{i}"], stats[f"max_{i}"])
            for i, (c, out) in enumerate(columns.items())
        }
    )


def minmax(value: Column, low: Column, high: Column) -> Column:
    scaled = F.try_divide(value - low, high - low)
    return F.when(value.isNotNull(), F.coalesce(scaled, F.lit(0.0)))


def standard_scale(
    df: DataFrame, columns: Mapping[str, str], fit_on: DataFrame | None = None
) -> DataFrame:
    """Add ``{column: new name}`` with mean 0 and population deviation 1.

    Statistics come from ``fit_on`` (the training rows) when given. A column
    without spread becomes 0.
    """
    source = df if fit_on is None else fit_on
    stats = one_row(
        source,
        **{f"mean_{i}": F.mean(c) for i, c in enumerate(columns)},
        **{f"std_{i}": F.stddev_pop(c) for i, c in enumerate(columns)},
    )
    scaled = {}
    for i, (c, out) in enumerate(columns.items()):
        centred = F.col(c) - stats[f"mean_{i}"]
        std = stats[f"std_{i}"]
        scaled[out] = F.when(std == 0, centred).otherwise(F.try_divide(centred, std))
    return df.withColumns(scaled)


# --- category codes --------------------------------------------------------


def frequency_index(
    df: DataFrame,
    label: str,
    out: str,
    weight: str | None = None,
    max_single_sort_rows: int = MAX_SINGLE_SORT_ROWS,
) -> DataFrame:
    """(label, ``out``): 0 for the most frequent label, ties in text order.

    ``weight`` names a row count column when ``df`` is already aggregated.
    """
    rows = F.count("*") if weight is None else F.sum(weight)
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(rows.alias("_n"))
    counts = stage(counts, "label_counts")
    order = [F.desc("_n"), F.asc(label)]
    return positions(counts, order, out, max_single_sort_rows).select(
        label, F.col(out).cast("double").alias(out)
    )


def ordinal_codes(
    tables: Sequence[DataFrame],
    label: str,
    out: str,
    max_single_sort_rows: int = MAX_SINGLE_SORT_ROWS,
) -> DataFrame:
    """(label, ``out``): 0, 1, 2, ... in text order over the labels of all tables."""
    labels = reduce(DataFrame.unionByName, [t.select(label) for t in tables]).distinct()
    labels = stage(labels.filter(F.col(label).isNotNull()), "labels")
    return positions(labels, [F.asc(label)], out, max_single_sort_rows)


def apply_codes(df: DataFrame, codes: DataFrame, invalid: str = "error") -> DataFrame:
    """Attach codes by label. ``codes`` is (label, code).

    A label without a code, or NULL, fails the job (``error``), drops its row
    (``skip``) or gets the next free code (``keep``).
    """
    label, code = codes.columns
    if invalid == "skip":
        return attach(df, codes, [label], "inner").select(*df.columns, code)
    if invalid not in ("error", "keep"):
        raise ValueError(f"invalid must be error, skip or keep, not {invalid!r}")
    joined = attach(df, codes, [label], "left").select(*df.columns, code)
    kind = dict(codes.dtypes)[code]
    if invalid == "error":
        shown = F.coalesce(F.col(label).cast("string"), F.lit("NULL"))
        fallback = F.raise_error(F.concat(F.lit(f"no code for {label} = "), shown)).cast(kind)
    else:
        n_codes = one_row(codes, n=F.count("*"))["n"]
        fallback = n_codes.cast(kind)
    known = F.when(F.col(code).isNotNull(), F.col(code)).otherwise(fallback)
    return joined.withColumn(code, known)


def string_index(df: DataFrame, label: str, out: str, invalid: str = "error") -> DataFrame:
    """Add the frequency-ordered category index of ``label``."""
    return apply_codes(df, frequency_index(df, label, out), invalid)


def label_encode(
    train: DataFrame, test: DataFrame, label: str, out: str, missing: str = "Unknown"
) -> tuple[DataFrame, DataFrame]:
    """Ordinal codes over the labels of both tables; NULL counts as ``missing``."""
    train, test = [t.withColumn(label, F.coalesce(label, F.lit(missing))) for t in (train, test)]
    codes = ordinal_codes([train, test], label, out)
    return apply_codes(train, codes), apply_codes(test, codes)


def onehot_drop_first(df: DataFrame, label: str, keep: Sequence[str]) -> DataFrame:
    """One-hot slots in long form: (``keep``..., slot, category, value).

    Slots follow text order and the first category has none: its rows come out
    with a NULL slot and value 0.
    """
    codes = ordinal_codes([df], label, "_code")
    coded = apply_codes(df, codes)
    encoded = F.col("_code") > 0
    return coded.select(
        *keep,
        F.when(encoded, F.col("_code") - 1).alias("slot"),
        F.col(label).alias("category"),
        encoded.cast("double").alias("value"),
    )


def max_bins(df: DataFrame, columns: Sequence[str], least: int = 64) -> DataFrame:
    """One row: distinct values of each column, and the tree bin count that fits them."""
    counts = distinct_numbers(df, columns)
    bins = max(least, *[n + 1 for n in counts.values()])
    schema = ", ".join([*[f"`n_{c}` bigint" for c in columns], "max_bins int"])
    return df.sparkSession.createDataFrame([(*[counts[c] for c in columns], bins)], schema)


# --- quantiles and categories ----------------------------------------------


def quantile_cuts(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float] = THIRDS,
    relative_error: float = 0.01,
) -> DataFrame:
    """(column, probability, cut): data values at the given ranks, NULL ignored.

    With a relative error, one pass keeps a fixed-size sketch per column. With 0
    the ranks are exact, found by ``quantiles.values_at_ranks``.
    """
    if relative_error > 0:
        accuracy = round(1 / relative_error)
        wanted = F.array(*[F.lit(float(p)) for p in probabilities])
        rows = F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.percentile_approx(column(c).cast("double"), wanted, accuracy).alias("cuts"),
                )
                for c in columns
            ]
        )
        found = df.agg(rows.alias("rows")).select(F.inline("rows"))
        return found.select(
            "column", F.explode(F.arrays_zip(wanted.alias("probability"), "cuts")).alias("z")
        ).select("column", F.col("z.probability"), F.col("z.cuts").alias("cut"))

    exact = values_at_ranks(
        df, columns, lambda n: [max(math.ceil(p * n), 1) for p in probabilities]
    )
    rows = [
        (c, float(p), cut) for c, (_, cuts) in exact.items() for p, cut in zip(probabilities, cuts)
    ]
    return df.sparkSession.createDataFrame(rows, "column string, probability double, cut double")


def interpolated_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> DataFrame:
    """(column, probability, quantile): exact, linear between the neighbouring ranks."""

    def around(n: int) -> list[int]:
        places = [p * (n - 1) for p in probabilities]
        return [r for at in places for r in (math.floor(at) + 1, math.ceil(at) + 1)]

    rows = []
    for c, (n, ends) in values_at_ranks(df, columns, around).items():
        for p, low, high in zip(probabilities, ends[::2], ends[1::2]):
            part = p * (n - 1) - math.floor(p * (n - 1))
            rows.append((c, float(p), low if low == high else low + (high - low) * part))
    schema = "column string, probability double, quantile double"
    return df.sparkSession.createDataFrame(rows, schema)


def categorize(value: Column, low: Column, high: Column, labels: Sequence[str]) -> Column:
    """Three labels by two cuts, each cut belonging to the band below it; NULL stays NULL."""
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(value <= low, labels[0])
        .when(value <= high, labels[1])
        .otherwise(labels[2])
    )


def discretize(
    df: DataFrame,
    columns: Mapping[str, tuple[str, Sequence[str]]],
    probabilities: tuple[float, float] = THIRDS,
    relative_error: float = 0.01,
) -> DataFrame:
    """Add ``{column: (new name, three labels)}`` by the column's own quantiles."""
    accuracy = round(1 / relative_error)
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    cuts = one_row(
        df,
        **{
            f"cuts_{i}": F.percentile_approx(F.col(c).cast("double"), wanted, accuracy)
            for i, c in enumerate(columns)
        },
    )
    return df.withColumns(
        {
            out: categorize(F.col(c), cuts[f"cuts_{i}"][0], cuts[f"cuts_{i}"][1], labels)
            for i, (c, (out, labels)) in enumerate(columns.items())
        }
    )


# --- missing values --------------------------------------------------------


def mean_impute(
    df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None
) -> DataFrame:
    """Fill NULL and NaN with the mean of the training rows (``fit_on``, or ``df``)."""
    source = df if fit_on is None else fit_on
    present = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns]
    means = one_row(source, **{f"mean_{i}": F.mean(v) for i, v in enumerate(present)})
    return df.withColumns(
        {c: F.coalesce(v, means[f"mean_{i}"]) for i, (c, v) in enumerate(zip(columns, present))}
    )


def label_impute(
    train: DataFrame, test: DataFrame, label: str
) -> tuple[DataFrame, DataFrame]:
    """Fill missing labels with the mean label of the table they are in."""
    return mean_impute(train, [label]), mean_impute(test, [label])


# --- splits ----------------------------------------------------------------


def split_bucket(key: Sequence[str]) -> Column:
    """A number from 0 to 99 that depends on the key columns only."""
    return F.pmod(md5_number(key_text(key), 8), F.lit(100)).cast("int")


def hash_split(
    df: DataFrame, key: Sequence[str], train_percent: int = 80
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by key hash: repeatable whatever the partitioning."""
    in_train = split_bucket(key) < train_percent
    return df.filter(in_train), df.filter(~in_train)


def random_split(
    df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42
) -> list[DataFrame]:
    """Spark's own random split; it depends on the partitioning of ``df``."""
    return df.randomSplit(list(weights), seed)
