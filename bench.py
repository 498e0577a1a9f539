"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the
data and the number of local cores. Query names may be given as arguments.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "integrate_panel",
    "integration_trace",
    "preprocess_full",
    "quality_report",
    "standardize_keys",
    "key_counts",
    "duplicate_count",
    "zscore_filter",
    "minmax_normalize",
    "string_index",
    "discretize",
    "quantile_cuts",
    "describe_quartiles",
    "column_profile",
    "correlation_matrix",
    "correlation_ranking",
    "regression_metrics",
    "knn_sweep",
    "model_linear",
    "model_tree",
    "batch_score",
]


def main() -> None:
    from driver_queries import QUERIES
    from fieldpanel.session import get_spark
    from fieldpanel.staging import clear_staged

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(
        "bench",
        master=f"local[{cpus}]",
        driver_memory="8g",
        log_level="ERROR",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()  # start-up is not a query
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    clear_staged(spark)
    result = {
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
