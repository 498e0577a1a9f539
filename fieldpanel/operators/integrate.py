"""Joining the yield table with its measure tables into one panel."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from fieldpanel.operators.joins import attach

KEY = ("Country", "Year")
ON_DUPLICATE = ("keep", "mean", "error")


def base_panel(cleaned_yield: DataFrame) -> DataFrame:
    """The cleaned yield table under the panel's column names."""
    return cleaned_yield.select(
        "Country",
        "Year",
        F.col("Item").alias("Crop"),
        F.col("Yield_Value").alias("Yield"),
        F.col("Unit").alias("Yield_Unit"),
    )


def keyed_measure(df: DataFrame, measure: str, out: str, on_duplicate: str = "keep") -> DataFrame:
    """(Country, Year, ``out``) with the chosen treatment of repeated keys.

    ``keep`` lets every copy match, ``mean`` averages the copies, ``error`` fails
    the job on the first repeated key.
    """
    if on_duplicate not in ON_DUPLICATE:
        raise ValueError(f"on_duplicate must be one of {', '.join(ON_DUPLICATE)}")
    named = df.select(*KEY, F.col(measure).alias(out))
    if on_duplicate == "keep":
        return named
    merged = named.groupBy(*KEY).agg(F.mean(out).alias(out), F.count("*").alias("_copies"))
    if on_duplicate == "error":
        repeated = F.concat_ws(" ", F.lit("repeated key in"), F.lit(out), *KEY)
        value = F.when(F.col("_copies") > 1, F.raise_error(repeated)).otherwise(F.col(out))
        merged = merged.withColumn(out, value)
    return merged.drop("_copies")


def integrate(
    panel: DataFrame,
    measures: Mapping[str, tuple[DataFrame, str]],
    on_duplicate: str = "keep",
    distinct: bool = False,
) -> DataFrame:
    """Inner-join measures, ``{panel column: (table, measure column)}``, to the panel.

    All joins share one key and are inner, so the measure tables are joined to
    each other first and written (by ``attach``). The large panel then moves once at
    most, and not at all when the joined measures are small enough to broadcast.

    ``distinct`` gives each joined row once. Joining distinct rows to distinct rows
    cannot produce a copy, so copies are removed from the inputs: a shuffle of the
    narrow tables before rows multiply, rather than of the wide panel after.
    """
    keyed = [
        keyed_measure(table, measure, out, on_duplicate)
        for out, (table, measure) in measures.items()
    ]
    if distinct:
        panel, keyed = panel.distinct(), [table.distinct() for table in keyed]
    joined = attach(panel, reduce(lambda a, b: attach(a, b, KEY), keyed), KEY)
    return joined.select(*panel.columns, *measures)


def integration_trace(
    panel: DataFrame, measures: Mapping[str, tuple[DataFrame, str]]
) -> DataFrame:
    """Row counts at the start and after each join, without running the joins.

    Every table is reduced to its rows per key; the product of these counts is
    the number of joined rows of that key.
    """
    tables = {"start": panel, **{out: table for out, (table, _) in measures.items()}}
    stages = list(tables)
    counted = [
        df.select(*KEY, *[F.lit(1 if s == name else 0).cast("bigint").alias(s) for s in stages])
        for name, df in tables.items()
    ]
    per_key = (
        reduce(DataFrame.unionByName, counted)
        .groupBy(*KEY)
        .agg(*[F.sum(s).alias(s) for s in stages])
    )
    matches = reduce(and_, [F.col(c).isNotNull() for c in KEY])
    product = F.col("start")
    products = [F.coalesce(F.sum(product), F.lit(0)).alias("start")]
    for s in stages[1:]:
        product = product * F.col(s)
        products.append(F.coalesce(F.sum(F.when(matches, product)), F.lit(0)).alias(s))
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("step"), F.lit(s).alias("stage"), F.col(s).alias("row_count"))
            for i, s in enumerate(stages)
        ]
    )
    return per_key.agg(*products).select(F.inline(rows))
