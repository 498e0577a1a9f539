"""Raw tables to the processed panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from fieldpanel.functions.columns import one_row
from fieldpanel.operators import clean, correlate, features, integrate, keys, shape
from fieldpanel.sources import sinks
from fieldpanel.staging import stage

# Panel columns and what is made of them.
MEASURES = {
    "Rainfall": ("rainfall", "average_rain_fall_mm_per_year"),
    "Pesticides": ("pesticides", "Pesticides_Value"),
    "Avg_Temperature": ("temp", "avg_temp"),
}
PANEL = [
    "Country", "Year", "Crop", "Yield", "Yield_Unit", "Rainfall", "Pesticides", "Avg_Temperature",
]
NUMBERS = ["Yield", "Rainfall", "Pesticides", "Avg_Temperature"]
NORMALIZED = {
    "Yield": "Yield_Normalized",
    "Rainfall": "Rainfall_Normalized",
    "Pesticides": "Pesticides_Normalized",
    "Avg_Temperature": "Temperature_Normalized",
}
INDEXED = {"Country": "Country_Index", "Crop": "Crop_Index"}
CATEGORIES = {
    "Yield": ("Yield_Category", features.AMOUNT_LABELS),
    "Rainfall": ("Rainfall_Category", features.AMOUNT_LABELS),
    "Avg_Temperature": ("Temperature_Category", features.TEMPERATURE_LABELS),
}
PROCESSED = [
    *PANEL, *NORMALIZED.values(), *INDEXED.values(), *[name for name, _ in CATEGORIES.values()],
]

CLEANERS = {
    "rainfall": clean.clean_rainfall,
    "pesticides": clean.clean_pesticides,
    "yield": clean.clean_yield,
    "temp": clean.clean_temp,
}


def cleaned_tables(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The four raw tables with trimmed headers, typed values and renamed keys."""
    return {name: cleaner(shape.trim_headers(raw[name])) for name, cleaner in CLEANERS.items()}


def standardized_tables(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The cleaned tables with standard country names."""
    return {name: keys.standardize_keys(df) for name, df in cleaned_tables(raw).items()}


def panel_parts(
    raw: Mapping[str, DataFrame],
) -> tuple[DataFrame, dict[str, tuple[DataFrame, str]]]:
    """The yield side of the panel and the measures to join to it."""
    tables = standardized_tables(raw)
    measures = {out: (tables[name], column) for out, (name, column) in MEASURES.items()}
    return integrate.base_panel(tables["yield"]), measures


def integrated_panel(
    raw: Mapping[str, DataFrame], on_duplicate: str = "keep", distinct: bool = False
) -> DataFrame:
    """The eight-column panel."""
    return integrate.integrate(*panel_parts(raw), on_duplicate=on_duplicate, distinct=distinct)


def processed_panel(
    panel: DataFrame, relative_error: float = 0.01, copies: bool = True
) -> DataFrame:
    """The panel without copies and outliers, normalized, indexed and categorized.

    The distinct panel is written once; ``copies=False`` says it is distinct
    already. Ranges and quantile sketches of the kept rows come from one pass over
    it, and one count by (Country, Crop) serves both category indexes.
    """
    distinct = stage(clean.dedup_rows(panel) if copies else panel, "panel")
    kept = clean.zscore_filter(distinct, NUMBERS)

    wanted = F.array(*[F.lit(p) for p in features.THIRDS])
    accuracy = round(1 / relative_error)
    stats = one_row(
        kept,
        **{f"min_{c}": F.min(c) for c in NUMBERS},
        **{f"max_{c}": F.max(c) for c in NUMBERS},
        **{f"cuts_{c}": F.percentile_approx(c, wanted, accuracy) for c in CATEGORIES},
    )
    out = kept.withColumns(
        {
            name: features.minmax(F.col(c), stats[f"min_{c}"], stats[f"max_{c}"])
            for c, name in NORMALIZED.items()
        }
    ).withColumns(
        {
            name: features.categorize(
                F.col(c), stats[f"cuts_{c}"][0], stats[f"cuts_{c}"][1], labels
            )
            for c, (name, labels) in CATEGORIES.items()
        }
    )
    labels = kept.groupBy(*INDEXED).agg(F.count("*").alias("_rows"))
    labels = stage(labels, "label_counts")
    for label, index in INDEXED.items():
        out = features.apply_codes(
            out, features.frequency_index(labels, label, index, weight="_rows")
        )
    return out.select(*PROCESSED)


def preprocess(
    raw: Mapping[str, DataFrame],
    *,
    on_duplicate: str = "keep",
    relative_error: float = 0.01,
    version: str = "v1.0",
    processing_date: date | None = None,
    id_columns: Sequence[str | Column] = (),
) -> DataFrame:
    """Raw tables (yield, rainfall, pesticides, temp) to the 21-column export."""
    panel = integrated_panel(raw, on_duplicate, distinct=True)
    processed = processed_panel(panel, relative_error, copies=False)
    return shape.add_metadata(
        processed,
        version=version,
        processing_date=processing_date,
        id_columns=id_columns,
        score_columns=NUMBERS,
    )


def correlation_ranking(processed: DataFrame, target: str = "Yield") -> DataFrame:
    """The processed features by their correlation with the target, strongest first."""
    features_of = [c for c in [*NUMBERS, *INDEXED.values()] if c != target]
    return correlate.correlation_ranking(processed, target, features_of)


def preprocess_and_export(
    raw: Mapping[str, DataFrame], root: str, **options: object
) -> dict[str, DataFrame]:
    """The whole preprocessing job: {processed, ranking}, and the export as CSV.

    The processed panel is written once; the export, the ranking and the caller read that.
    """
    processed = stage(preprocess(raw, **options), "processed")
    sinks.write_csv(processed, f"{root.rstrip('/')}/processed/processed_data.csv")
    return {"processed": processed, "ranking": correlation_ranking(processed)}
