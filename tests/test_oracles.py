"""Registered queries against DuckDB on the smallest tables.

All of them run with FIELDPANEL_ALL_QUERIES=1; by default one of each kind does.
"""

from __future__ import annotations

import os
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
USUAL = [
    "csv_roundtrip", "parquet_roundtrip", "cast_safe", "add_metadata", "zscore_filter",
    "integrate_panel", "integration_trace", "standardize_keys", "key_counts", "duplicate_count",
    "describe_quartiles", "column_profile", "categorical_profile", "correlation_ranking",
    "string_index", "quantile_cuts", "mean_impute", "regression_metrics", "preprocess_full",
    "quality_report", "knn_sweep", "fit_scaled_models", "random_split_parts",
    "random_sample_members", "scored_rows", "model_coefficients", "model_elastic_net", "model_ols",
]
NAMES = list(entry.oracle_sql()) if os.environ.get("FIELDPANEL_ALL_QUERIES") else USUAL

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql_twin(spark, duck, name):
    problem = compare(entry.queries()[name](spark, SF_DIR), duck, entry.oracle_sql()[name])
    assert problem is None, problem


def test_entry_returns_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    rows_only = set(entry.QUERIES) - set(entry.oracle_sql())
    assert all(
        n.startswith("model_")
        or n in {"random_sample", "random_split", "feature_importance", "compare_models",
                 "batch_score"}
        for n in rows_only
    )
