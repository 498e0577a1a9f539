"""The linear models in SQL: normal equations by elimination, penalties by coordinate descent."""

from __future__ import annotations

from driver_queries import star

MEASURES = ("Year", "Rainfall", "Pesticides", "Avg_Temperature")
# Panel column -> feature name of the modelling table.
FEATURE_NAMES = {
    "Year": "Year",
    "Rainfall": "average_rain_fall_mm_per_year",
    "Pesticides": "pesticides_tonnes",
    "Avg_Temperature": "avg_temp",
}
SIDED = f"""{star.MODEL_SQL},
sided AS (
  SELECT *, "Yield" AS y,
         CAST('0x' || substr(md5(row_key), 1, 8) AS BIGINT) % 100 < 80 AS in_train
  FROM (SELECT *, "Country" || '|' || "Year" || '|' || "Crop" AS row_key FROM model_panel))"""


def _design(scaled: bool) -> str:
    """Features in long form: centred numbers, and a 1 per label that the training rows have."""
    center = ", ".join(
        f'avg("{c}") AS m{i}, stddev_pop("{c}") AS s{i}' for i, c in enumerate(MEASURES)
    )
    unit = "/ s{i}" if scaled else ""
    numbers = " UNION ALL ".join(
        f"SELECT row_key, in_train, y, '{FEATURE_NAMES[c]}' AS f, "
        f"(\"{c}\" - m{i}) {unit.format(i=i)} AS x FROM sided, center"
        for i, c in enumerate(MEASURES)
    )
    first = "WHERE place > 1" if scaled else ""
    slots = " UNION ALL ".join(
        f"""SELECT row_key, in_train, y, '{name}Vec_' || label AS f, 1.0 AS x
        FROM sided JOIN (SELECT DISTINCT "{c}" AS label,
                         dense_rank() OVER (ORDER BY "{c}") AS place FROM sided WHERE in_train) l
          ON "{c}" = label {first}"""
        for c, name in (("Country", "Area"), ("Crop", "Item"))
    )
    return f"""center AS (SELECT {center} FROM sided WHERE in_train),
cells AS MATERIALIZED ({numbers} UNION ALL {slots}),
whole AS (SELECT count(*) AS n, avg(y) AS my, stddev_pop(y) AS sy FROM sided WHERE in_train),
stats AS MATERIALIZED (
  SELECT f, row_number() OVER (ORDER BY f) AS i, sum(x) / any_value(n) AS m,
         CASE WHEN count(*) = any_value(n) THEN stddev_pop(x)
              ELSE sqrt(sum(x * x) / any_value(n) - power(sum(x) / any_value(n), 2)) END AS s,
         sum(x * (y - my)) / any_value(n) AS c
  FROM cells, whole WHERE in_train GROUP BY f),
pairs AS (
  SELECT a.f AS f, b.f AS g, sum(a.x * b.x) AS xx
  FROM cells a JOIN cells b USING (row_key) WHERE a.in_train GROUP BY 1, 2),
matrix AS MATERIALIZED (
  SELECT p.i, q.i AS j, (coalesce(xx, 0) / n - p.m * q.m) / (p.s * q.s) AS v
  FROM stats p CROSS JOIN stats q CROSS JOIN whole
  LEFT JOIN pairs ON pairs.f = p.f AND pairs.g = q.f)"""


def _fitted(l1: str, l2: str, per_label: bool, standardize: bool, sweeps: int) -> str:
    """(f, w): the coefficients."""
    u = "1.0" if standardize else "1 / s"
    label = "/ sy" if per_label else ""
    rows = f"""
rows_ AS (
  SELECT matrix.i, any_value(c / s) AS b, any_value({u}) AS u,
         list(v + CASE WHEN j = matrix.i THEN {l2} {label} * power({u}, 2) ELSE 0 END ORDER BY j)
           AS r
  FROM matrix JOIN stats ON stats.i = matrix.i CROSS JOIN whole GROUP BY matrix.i),
system AS (
  SELECT list(r || [b] ORDER BY i) AS m0, list(r ORDER BY i) AS a, list(b ORDER BY i) AS b,
         list({l1} * u ORDER BY i) AS l1, count(*) AS p FROM rows_)"""
    if l1 == "0":
        solved = """
solved AS (
  SELECT list_transform(list_reduce(range(1, p + 1), lambda m, k:
      list_transform(m, lambda r, i: CASE WHEN i = k
        THEN list_transform(r, lambda v: v / r[k])
        ELSE list_transform(r, lambda v, j: v - r[k] * m[k][j] / m[k][k]) END), m0),
    lambda r: r[p + 1]) AS g
  FROM system)"""
    else:
        reach = "(b[1 + k % p] - list_dot_product(a[1 + k % p], w) + a[1 + k % p][1 + k % p] * w[1 + k % p])"
        solved = f"""
solved AS (
  SELECT list_reduce(range(0, p * {sweeps}), lambda w, k:
      list_transform(w, lambda v, i: CASE WHEN i <> 1 + k % p THEN v
        ELSE sign({reach}) * greatest(abs({reach}) - l1[i], 0) / a[i][i] END),
    list_transform(b, lambda v: CAST(0 AS DOUBLE))) AS g
  FROM system)"""
    return rows + "," + solved + """,
fitted AS (SELECT f, g[i] / s AS w, m FROM stats, solved)"""


def coefficients_sql(penalty: tuple, scaled: bool, sweeps: int = 0) -> str:
    return f"""WITH {SIDED}, {_design(scaled)}, {_fitted(*penalty, sweeps)}"""


def predictions_sql(penalty: tuple, scaled: bool, sweeps: int = 0) -> str:
    """``predicted``: the label y and the prediction p of every held-out row."""
    return f"""{coefficients_sql(penalty, scaled, sweeps)},
predicted AS (
  SELECT row_key, any_value(y) AS y,
         any_value(my) - any_value(offset_) + sum(x * coalesce(w, 0)) AS p
  FROM cells LEFT JOIN fitted USING (f) CROSS JOIN whole
  CROSS JOIN (SELECT sum(m * w) AS offset_ FROM fitted)
  WHERE NOT in_train GROUP BY row_key)"""


def metrics_sql(name: str, penalty: tuple, scaled: bool, sweeps: int = 0) -> str:
    """Held-out metrics of the model with this penalty."""
    return f"""{predictions_sql(penalty, scaled, sweeps)}
SELECT '{name}' AS model,
       round(1 - sum(power(y - p, 2)) / (var_pop(y) * count(*)), 4) + 0.0 AS r2,
       round(avg(abs(y - p)), 4) AS mae, round(sqrt(avg(power(y - p, 2))), 4) AS rmse
FROM predicted"""
