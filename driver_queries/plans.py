"""Composed plans."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from driver_queries import star
from driver_queries.registry import exact, query, rounded
from fieldpanel.plans import compare, preprocess, reports

NUMBERS = preprocess.NUMBERS

# The whole preprocessing plan in SQL.
_WITHIN = " AND ".join(f'abs(("{c}" - "m_{c}") / "s_{c}") <= 3' for c in NUMBERS)
_STATS = ", ".join(f'avg("{c}") AS "m_{c}", stddev_samp("{c}") AS "s_{c}"' for c in NUMBERS)
_EDGES = ", ".join(
    f'min("{c}") AS "low_{c}", max("{c}") AS "high_{c}", '
    f'quantile_disc("{c}", 0.33) AS "q1_{c}", quantile_disc("{c}", 0.66) AS "q2_{c}"'
    for c in NUMBERS
)
PROCESSED_SQL = f"""{star.PANEL_SQL},
copies AS (SELECT DISTINCT * FROM panel),
stats AS (SELECT {_STATS} FROM copies),
kept AS (SELECT copies.* FROM copies, stats WHERE {_WITHIN}),
edges AS (SELECT {_EDGES} FROM kept),
by_country AS (SELECT "Country", CAST(row_number() OVER (ORDER BY count(*) DESC, "Country") - 1
  AS DOUBLE) AS "Country_Index" FROM kept GROUP BY 1),
by_crop AS (SELECT "Crop", CAST(row_number() OVER (ORDER BY count(*) DESC, "Crop") - 1
  AS DOUBLE) AS "Crop_Index" FROM kept GROUP BY 1)"""


def _scaled(c, out):
    return f'round(("{c}" - "low_{c}") / ("high_{c}" - "low_{c}"), 8) AS "{out}"'


def _category(c, out, labels):
    return f"""CASE WHEN "{c}" <= "q1_{c}" THEN '{labels[0]}'
      WHEN "{c}" <= "q2_{c}" THEN '{labels[1]}' ELSE '{labels[2]}' END AS "{out}" """


_SCALED = ", ".join(_scaled(c, out) for c, out in preprocess.NORMALIZED.items())
_CATEGORIES = ", ".join(_category(c, *made) for c, made in preprocess.CATEGORIES.items())
_ID_TEXT = " || '|' || ".join(
    ['"Country"', '"Year"', '"Crop"', '"Yield_Unit"']
    + [f'CAST(round("{c}" * 100) AS BIGINT)' for c in NUMBERS]
)


@query(
    "preprocess_full",
    f"""WITH {PROCESSED_SQL}
    SELECT "Country", "Year", "Crop", "Yield", "Yield_Unit", "Rainfall", "Pesticides",
      "Avg_Temperature", {_SCALED},
      "Country_Index", "Crop_Index", {_CATEGORIES},
      md5({_ID_TEXT}) AS "ID",
      '2024-01-01' AS "Processing_Date", 'v1.0' AS "Processing_Version",
      100 AS "Data_Quality_Score"
    FROM kept JOIN by_country USING ("Country") JOIN by_crop USING ("Crop"), edges""",
)
def preprocess_full(spark, sf_dir):
    out = preprocess.preprocess(
        star.raw_tables(spark, sf_dir),
        relative_error=0.0001,
        processing_date=date(2024, 1, 1),
        id_columns=[
            "Country", "Year", "Crop", "Yield_Unit",
            *[F.round(F.col(c) * 100).cast("bigint") for c in NUMBERS],
        ],
    )
    out = out.withColumn("Processing_Date", F.col("Processing_Date").cast("string"))
    return rounded(out, 8, *preprocess.NORMALIZED.values())


def _cell(section, column, metric, value, source="panel"):
    return (
        f"SELECT '{section}' AS section, '{column}' AS \"column\", '{metric}' AS metric, "
        f'CAST({value} AS DOUBLE) AS "value" FROM {source}'
    )


def _quality_cells():
    cells = [
        _cell("nulls", c, "nulls", f'count(*) FILTER (WHERE "{c}" IS NULL)')
        for c in preprocess.PANEL
    ]
    for c in NUMBERS:
        cells += [
            _cell("completeness", c, "completeness", f'count("{c}") / count(*)'),
            _cell("summary", c, "count", f'count("{c}")'),
            _cell("summary", c, "mean", f'round(avg("{c}"), 4)'),
            _cell("summary", c, "stddev", f'round(stddev_samp("{c}"), 4)'),
            _cell("range", c, "min", f'min("{c}")'),
            _cell("range", c, "max", f'max("{c}")'),
        ]
    cells += [
        _cell("negatives", c, "negatives", f'count(*) FILTER (WHERE "{c}" < 0)')
        for c in NUMBERS[:3]
    ]
    cells += [
        _cell("coverage", c, "distinct_values", f'count(DISTINCT "{c}")')
        for c in ("Year", "Country", "Crop")
    ]
    cells.append(_cell("coverage", "(all)", "row_count", "count(*)"))
    return " UNION ALL ".join(cells)


@query("quality_report", f"WITH {star.PANEL_SQL} {_quality_cells()}")
def quality_report(spark, sf_dir):
    report = reports.quality_report(preprocess.integrated_panel(star.raw_tables(spark, sf_dir)))
    summed = F.col("metric").isin("mean", "stddev")
    return report.withColumn("value", F.when(summed, exact("value", 4)).otherwise(F.col("value")))


def _profile_cells():
    def cell(section, column, metric, value, text="NULL"):
        return (
            f"SELECT '{section}' AS section, '{column}' AS \"column\", '{metric}' AS metric, "
            f'CAST({value} AS DOUBLE) AS "value", {text} AS text FROM roles'
        )

    cells = [
        cell("size", "(all)", "row_count", "count(*)"),
        cell("size", "(all)", "column_count", "count(DISTINCT 1) * 5"),
        cell("missing", "yield", "missing", "count(*) - count(yield)"),
        cell("missing", "yield", "missing_pct",
             "round((count(*) - count(yield)) * 100.0::DOUBLE / count(*), 4)"),
    ]
    for c in ("year", "yield"):
        cells += [
            cell("numeric", c, "min", f"min({c})"),
            cell("numeric", c, "max", f"max({c})"),
            cell("numeric", c, "mean", f"round(avg({c}), 4)"),
            cell("numeric", c, "stddev", f"round(stddev_samp({c}), 4)"),
        ]
    for c in ("area", "crop", "Unit"):
        cells.append(
            cell("categorical", c, "distinct_values", f'count(DISTINCT "{c}")',
                 f'CASE WHEN count(DISTINCT "{c}") < 10 '
                 f"""THEN string_agg(DISTINCT "{c}", ', ' ORDER BY "{c}") END""")
        )
    return " UNION ALL ".join(cells)


@query(
    "flexible_profile",
    f"""WITH {star.RAW}, roles AS (SELECT "Year" AS year, "Area" AS area, "Item" AS crop,
      "Value" AS yield, "Unit" AS "Unit" FROM raw_yield) {_profile_cells()}""",
)
def flexible_profile(spark, sf_dir):
    """The raw yield table under other column names, profiled by the roles they suggest."""
    raw = star.raw_yield(spark, sf_dir).withColumnsRenamed(
        {"Area": "Country_Name", "Year": "season_year", "Item": "crop_type", "Value": "yield_kg"}
    )
    return rounded(reports.flexible_profile(raw), 4, "value")


def _explore_cells():
    """Column infos, missing values, correlations and descriptions of the modelling table."""
    names = {made: c for c, made in compare.MODEL_NAMES.items()}
    numbers = reports.MODEL_COLUMNS[:4] + reports.MODEL_COLUMNS[6:]

    def cell(report, key, value):
        return f"SELECT '{report}', '{key}', CAST({value} AS DOUBLE) FROM model_panel"

    cells = []
    for i, made in enumerate(reports.MODEL_COLUMNS, 1):
        c = names.get(made, made)
        cells.append(cell("info", made, str(i)) + " LIMIT 1")
        cells.append(cell("missing", made, f'count(*) - count("{c}")'))
    for a in numbers:
        x = f'"{names.get(a, a)}"'
        for b in numbers:
            y = f'"{names.get(b, b)}"'
            cells.append(cell("correlation", f"{a} {b}", f"round(corr({x}, {y}), 6) + 0.0"))
        for metric, value in [
            ("count", f"count({x})"), ("mean", f"avg({x})"), ("stddev", f"stddev_samp({x})"),
            ("min", f"min({x})"), ("max", f"max({x})"),
            *[(f"q{p}", f"quantile_cont({x}, 0.{p})") for p in (25, 50, 75)],
        ]:
            value = f"round(CAST({value} AS DOUBLE), 4) + 0.0"
            cells.append(cell("description", f"{a} {metric}", value))
    return " UNION ALL ".join(f"({c})" for c in cells)


@query(
    "explore",
    f"""WITH {star.MODEL_SQL}, t AS (SELECT DISTINCT "Country" AS "Area", "Crop" AS "Item",
      "Yield" AS y FROM model_panel)
    SELECT 'count_by_area' AS report, "Area" AS key, CAST(count(*) AS DOUBLE) AS "value"
      FROM model_panel JOIN (SELECT DISTINCT "Country" AS "Area" FROM model_panel)
      ON "Country" = "Area" GROUP BY 2
    UNION ALL SELECT 'count_by_item', "Crop", CAST(count(*) AS DOUBLE) FROM model_panel GROUP BY 2
    UNION ALL SELECT 'total_by_item', "Crop", round(sum("Yield"), 7) FROM model_panel GROUP BY 2
    UNION ALL SELECT * FROM (SELECT 'top_areas', "Country", round(sum("Yield"), 7) AS total
      FROM model_panel GROUP BY 2 ORDER BY total DESC, "Country" LIMIT 30)
    UNION ALL SELECT 'distinct', 'Area', CAST(count(DISTINCT "Country") AS DOUBLE) FROM model_panel
    UNION ALL SELECT 'distinct', 'Item', CAST(count(DISTINCT "Crop") AS DOUBLE) FROM model_panel
    UNION ALL {_explore_cells()}""",
)
def explore(spark, sf_dir):
    """One long table from the parts of the exploration of the averaged modelling table."""
    from driver_queries.modelling import model_base

    found = reports.explore(model_base(spark, sf_dir).withColumn("_c0", F.lit(None).cast("int")))

    def part(name, df, key, value, digits=7):
        return df.select(
            F.lit(name).alias("report"), F.col(key).alias("key"), exact(F.col(value), digits)
            .alias("value")
        )

    pieces = [
        part("count_by_area", found["count_by_area"], "Area", "row_count"),
        part("count_by_item", found["count_by_item"], "Item", "row_count"),
        part("total_by_item", found["total_by_item"], "Item", "total"),
        part("top_areas", found["top_areas"], "Area", "total"),
        part("info", found["info"], "column", "ordinal"),
        part("missing", found["missing"], "column", "nulls"),
        part("distinct", found["distinct"], "column", "distinct_values"),
        part(
            "correlation",
            found["correlation"].withColumn("pair", F.concat_ws(" ", "col_i", "col_j")),
            "pair",
            "corr",
            6,
        ),
        part(
            "description",
            found["description"]
            .unpivot("column", found["description"].columns[1:], "metric", "found")
            .withColumn("cell", F.concat_ws(" ", "column", "metric")),
            "cell",
            "found",
            4,
        ),
    ]
    out = pieces[0]
    for piece in pieces[1:]:
        out = out.unionByName(piece)
    return out
