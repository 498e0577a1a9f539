"""Compare registered queries with their SQL twins in DuckDB.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples of text, columns by name."""
    df = df[sorted(df.columns)].astype(object)
    df = df.where(pd.notna(df), None)
    return sorted(tuple(repr(v) if v is not None else "" for v in r) for r in plain(df))


def plain(df: pd.DataFrame):
    for row in df.itertuples(index=False, name=None):
        yield tuple(v.item() if hasattr(v, "item") else v for v in row)


def kinds(df: pd.DataFrame) -> dict[str, str]:
    return {c: str(df[c].dtype) for c in sorted(df.columns)}


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    got = spark_df.toPandas()
    want = con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"row count {len(got)} != {len(want)}"
    if len(got) == 0:
        return "no rows"
    g, w = canonical(got), canonical(want)
    if g != w:
        bad = [(a, b) for a, b in zip(g, w) if a != b]
        return f"{len(bad)} rows differ, first {bad[0]}; types {kinds(got)} vs {kinds(want)}"
    if kinds(got) != kinds(want):
        diff = {c: (k, kinds(want)[c]) for c, k in kinds(got).items() if k != kinds(want)[c]}
        return None if not diff else f"TYPES {diff}"
    return None


def main() -> int:
    import __spark_entry__ as entry

    from fieldpanel.session import get_spark

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = get_spark(
        "oracle check",
        master="local[8]",
        driver_memory="8g",
        log_level="ERROR",
        **{"spark.sql.shuffle.partitions": 8, "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"},
    )
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = args[1:] or list(queries)
    failures = 0
    for name in names:
        start = time.time()
        try:
            result = queries[name](spark, sf_dir)
            if name in oracles:
                problem = compare(result, con, oracles[name])
                note = "ok" if problem is None else problem
            else:
                problem, rows = None, result.toPandas()
                note = f"rows only: {len(rows)}\n{rows.head(12).to_string()}"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = note = f"{type(error).__name__}: {str(error)[:600]}"
        failures += problem is not None
        print(f"{name:24} {time.time() - start:6.2f}s  {note}", flush=True)
    print(f"{len(names)} queries, {failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(main())
