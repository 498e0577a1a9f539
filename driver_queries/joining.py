"""Panel integration."""

from __future__ import annotations

from driver_queries import star
from driver_queries.registry import query
from fieldpanel.operators import integrate
from fieldpanel.plans import preprocess


def _joined(spark, sf_dir, *names):
    panel, measures = preprocess.panel_parts(star.raw_tables(spark, sf_dir))
    return integrate.integrate(panel, {name: measures[name] for name in names})


@query(
    "join_rainfall",
    f"""WITH {star.STANDARD}
    SELECT y."Country", y."Year", "Item" AS "Crop", "Yield_Value" AS "Yield",
           "Unit" AS "Yield_Unit", average_rain_fall_mm_per_year AS "Rainfall"
    FROM std_yield y JOIN std_rainfall r ON y."Country" = r."Country" AND y."Year" = r."Year" """,
)
def join_rainfall(spark, sf_dir):
    return _joined(spark, sf_dir, "Rainfall")


@query(
    "join_pesticides",
    f"""WITH {star.STANDARD}
    SELECT y."Country", y."Year", "Item" AS "Crop", "Yield_Value" AS "Yield",
           "Unit" AS "Yield_Unit", average_rain_fall_mm_per_year AS "Rainfall",
           "Pesticides_Value" AS "Pesticides"
    FROM std_yield y JOIN std_rainfall r ON y."Country" = r."Country" AND y."Year" = r."Year"
    JOIN std_pesticides p ON y."Country" = p."Country" AND y."Year" = p."Year" """,
)
def join_pesticides(spark, sf_dir):
    return _joined(spark, sf_dir, "Rainfall", "Pesticides")


@query(
    "integrate_panel",
    f"""WITH {star.PANEL_SQL}
    SELECT * FROM panel""",
)
def integrate_panel(spark, sf_dir):
    return _joined(spark, sf_dir, "Rainfall", "Pesticides", "Avg_Temperature")


@query(
    "integration_trace",
    f"""WITH {star.PANEL_SQL},
    with_rain AS (
      SELECT y."Country", y."Year" FROM std_yield y
      JOIN std_rainfall r ON y."Country" = r."Country" AND y."Year" = r."Year"),
    with_pesticides AS (
      SELECT w."Country" FROM with_rain w
      JOIN std_pesticides p ON w."Country" = p."Country" AND w."Year" = p."Year")
    SELECT 0 AS step, 'start' AS stage, count(*) AS row_count FROM std_yield
    UNION ALL SELECT 1, 'Rainfall', count(*) FROM with_rain
    UNION ALL SELECT 2, 'Pesticides', count(*) FROM with_pesticides
    UNION ALL SELECT 3, 'Avg_Temperature', count(*) FROM panel""",
)
def integration_trace(spark, sf_dir):
    panel, measures = preprocess.panel_parts(star.raw_tables(spark, sf_dir))
    return integrate.integration_trace(panel, measures)
