"""Registered query of the conversation repair operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldpanel.llm import conversation_repair as repairing
from fieldpanel.llm.common import documents
from fieldpanel.llm.registry import query

EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damaged(rows: DataFrame) -> DataFrame:
    """The conversations with every 20th turn or so dropped, emptied, cut, repeated or renamed."""
    number, turn, role, text = (
        F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")
    )
    what = F.crc32(F.concat(number, F.lit(":"), turn)) % 20
    text = F.when(F.col("what") == 1, "").when(
        F.col("what") == 2, F.translate(text, ".!?", "")
    ).otherwise(text)
    times = F.when(F.col("what") == 3, 2).otherwise(1)
    return rows.withColumn("what", what).where("what != 0").select(
        "conv_id", "turn",
        F.when(F.col("what") == 4, "user").otherwise(role).alias("role"),
        text.alias("text"),
        F.explode(F.sequence(F.lit(1), times)).alias("copy"),
    ).drop("copy")


def _plus(entry: str, cost: int, edits: str) -> str:
    """A DP entry, nine digits of cost and the audit, after further edits."""
    return (f"CASE WHEN {entry} IS NOT NULL THEN lpad(CAST(CAST(left({entry}, 9) AS INT) + {cost}"
            f" AS VARCHAR), 9, '0') || substr({entry}, 10) || '{edits}' END")


def _edited(position: int, sources: dict[str, list[int]]) -> str:
    """Least entry of a position after one row: deleted, kept or renamed."""
    options = [_plus(f"st[{position}]", 4, "D")]
    for fault, more in (("-", 0), ("t", 3)):
        for initial, froms in sources.items():
            for at in froms:
                options.append(f"CASE WHEN row_ = '{initial}{fault}' THEN "
                               f"{_plus(f'st[{at}]', more, 'K')} END")
                if initial in "ua":
                    options.append(f"CASE WHEN right(row_, 1) = '{fault}' THEN "
                                   f"{_plus(f'st[{at}]', more + 3, 'R')} END")
    return f"least({', '.join(options)})" if len(options) > 1 else options[0]


_BASE = ", ".join(
    _edited(i, s) for i, s in ((1, {}), (2, {"s": [1]}), (3, {"u": [1, 2, 4]}), (4, {"a": [3]}))
)


def _closed(base: str) -> str:
    """Entries after rows may have been inserted behind the row."""
    user = ", ".join(_plus(f"{base}[{i}]", 3, "I") for i in (1, 2, 4))
    assistant = ", ".join([_plus(f"{base}[3]", 3, "I"),
                           *[_plus(f"{base}[{i}]", 6, "II") for i in (1, 2)]])
    return (f"[{base}[1], {base}[2], least({base}[3], {user}), least({base}[4], {assistant})]")


_STEP = f"list_transform([[{_BASE}]], lambda b: {_closed('b')})[1]"
_FIRST = "['000000000', CAST(NULL AS VARCHAR), '000000003I', '000000006II']"
_TRIM = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

REPAIR_SQL = f"""
WITH crc AS (
  SELECT list(list_reduce(range(8), lambda c, k:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)),
plain AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')
           AS name
  FROM conversations),
marked AS (
  SELECT plain.*, xor(list_reduce(
      list_transform(string_split(name, ''), lambda ch: CAST(ord(ch) AS BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS what
  FROM plain, crc),
harmed AS (
  SELECT conv_id, turn, CASE what WHEN 4 THEN 'user' ELSE role END AS role,
         CASE what WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE what WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM marked WHERE what <> 0),
rows_ AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id
                               ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS n,
         right(rtrim(text, {_TRIM}), 1) AS ending, left(role, 1) AS initial
  FROM harmed),
seen AS (
  SELECT *, CASE WHEN ending = '' THEN 'b'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'd'
                 WHEN ending NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial AS pair
  FROM rows_),
found AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
         count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
         list_reduce(list(initial || fault ORDER BY n), lambda st, row_: {_STEP}, {_FIRST}) AS st
  FROM seen GROUP BY conv_id),
best AS (SELECT *, least(st[1], st[4]) AS entry FROM found),
steps AS (
  SELECT conv_id, unnest(string_split(substr(entry, 10), '')) AS edit,
         unnest(range(length(entry) - 9)) AS step
  FROM best WHERE length(entry) > 9),
placed AS (
  SELECT *, sum(CAST(edit <> 'I' AS INT)) OVER (PARTITION BY conv_id ORDER BY step) AS n
  FROM steps),
kept AS (
  SELECT p.conv_id, step, edit, role, initial, CASE edit WHEN 'I' THEN '' ELSE text END AS text,
         row_number() OVER (PARTITION BY p.conv_id ORDER BY step) AS k,
         first_value(edit || initial) OVER (PARTITION BY p.conv_id ORDER BY step) AS opening
  FROM placed p LEFT JOIN seen s
    ON p.conv_id IS NOT DISTINCT FROM s.conv_id AND p.n = s.n AND edit <> 'I'
  WHERE edit <> 'D'),
whole AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role
      WHEN (k - CAST(coalesce(opening, '') = 'Ks' AS INT)) % 2 = 1 THEN 'user'
      ELSE 'assistant' END || ':' || text, chr(10) ORDER BY step) AS text
  FROM kept GROUP BY conv_id)
SELECT o.conv_id, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in COUNTS[:5])},
       CAST(coalesce(CAST(left(entry, 9) AS INT), 0) AS BIGINT) AS cost,
       coalesce(substr(entry, 10), '') AS audit, sha256(coalesce(w.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id
LEFT JOIN whole w ON o.conv_id IS NOT DISTINCT FROM w.conv_id"""


@query("op13_conversation_repair", REPAIR_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation with its faults after damage and its cheapest repair."""
    rows = documents(spark, sf_dir, "conversations")
    return of_all(rows.select("conv_id").distinct(), repairing.repair(damaged(rows)).summary())


def of_all(originals: DataFrame, found: DataFrame) -> DataFrame:
    """One row per original conversation; those without rows have zeros."""
    found = found.withColumnRenamed("conv_id", "of").withColumn("any", F.lit(True))
    joined = originals.join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    zero = {c: F.when(F.col("any"), F.col(c)).otherwise(0).cast("bigint") for c in COUNTS}
    return joined.select(
        "conv_id", *[v.alias(c) for c, v in zero.items()],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"),
    )
