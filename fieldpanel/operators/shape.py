"""Column naming, selection, casts, roles and metadata."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from fieldpanel.functions.columns import key_text

# Names a blank CSV header gets from the readers in use.
STRAY_INDEX_COLUMNS = ("Unnamed: 0", "_c0")

# The roles of a modelling table and the name parts that mark them.
ROLE_PATTERNS: dict[str, tuple[str, ...]] = {
    "year": ("year", "season_year"),
    "rainfall": ("rain", "rainfall", "precipitation", "rain_fall", "average_rain_fall"),
    "pesticide": ("pesticide", "pesticides", "pesticides_tonnes"),
    "temperature": ("temp", "temperature", "avg_temp", "average_temp"),
    "area": ("area", "country", "region"),
    "crop": ("crop", "item", "crop_type"),
    "yield": ("yield", "production", "hg/ha_yield", "yield_kg"),
}


def trim_headers(df: DataFrame) -> DataFrame:
    """Strip blanks around column names."""
    names = [c.strip() for c in df.columns]
    folded = [n.lower() for n in names]
    clashes = sorted({n for n, f in zip(names, folded) if folded.count(f) > 1})
    if clashes:
        raise ValueError(f"column names collide after trimming: {', '.join(clashes)}")
    return df.toDF(*names)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by map; names the table lacks are ignored."""
    return df.withColumnsRenamed(dict(names))


def project(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Select exactly ``{new name: source column or expression}``."""
    return df.select(
        *[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
    )


def drop_if_exists(df: DataFrame, columns: Sequence[str] = STRAY_INDEX_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def cast_columns(df: DataFrame, types: Mapping[str, str], safe: bool = False) -> DataFrame:
    """Cast in place. ``safe`` turns unreadable values into NULL instead of failing."""
    casts = {
        c: F.col(c).try_cast(t) if safe else F.col(c).cast(t) for c, t in types.items()
    }
    return df.withColumns(casts)


def identify_columns(
    columns: Sequence[str], patterns: Mapping[str, Sequence[str]] = ROLE_PATTERNS
) -> dict[str, str]:
    """Match role -> column by name, each column in at most one role.

    An exact name beats a prefix, a prefix beats a part elsewhere in the name;
    then the longer pattern, the shorter name and the earlier column win.
    """
    candidates = []
    for at, column in enumerate(columns):
        name = column.strip().lower()
        for role, parts in patterns.items():
            for part in parts:
                if part in name:
                    rank = 0 if name == part else 1 if name.startswith(part) else 2
                    candidates.append((rank, -len(part), len(name), at, role, column))
    roles: dict[str, str] = {}
    for *_, role, column in sorted(candidates):
        if role not in roles and column not in roles.values():
            roles[role] = column
    return {role: roles[role] for role in patterns if role in roles}


def prepare_columns(
    df: DataFrame, roles: Mapping[str, str] | None = None, n_extra: int | None = None
) -> DataFrame:
    """Role columns under their role names, then the other columns, or ``n_extra`` of them.

    A table with no recognizable column is returned as it is.
    """
    roles = identify_columns(df.columns) if roles is None else roles
    if not roles:
        return df
    used = set(roles.values())
    taken = {role.lower() for role in roles}
    extras = [c for c in df.columns if c not in used and c.lower() not in taken][:n_extra]
    return df.select(
        *[F.col(f"`{c}`").alias(role) for role, c in roles.items()],
        *[F.col(f"`{c}`") for c in extras],
    )


def inspect(df: DataFrame, order: Sequence[str] = (), n: int = 5) -> DataFrame:
    """One row per column: its place, name, type, and the table's row count.

    With ``order``, ``sample`` has the column's values, as text, in the first ``n`` rows of that
    order: a top-n per task and a merge, so no more than ``n`` rows leave a task.
    """
    sample = [F.lit(None).cast("array<string>")] * len(df.columns)
    if order:
        first = df.orderBy(*order).limit(n).collect()
        cells = [[None if row[c] is None else row[c] for row in first] for c in df.columns]
        kinds = [field.dataType for field in df.schema.fields]
        sample = [
            F.array(*[F.lit(v).cast(kind) for v in values]).cast("array<string>")
            for values, kind in zip(cells, kinds)
        ]
    described = F.array(
        *[
            F.struct(
                F.lit(i).alias("ordinal"), F.lit(c).alias("column"), F.lit(t).alias("dtype"),
                values.alias("sample"),
            )
            for i, ((c, t), values) in enumerate(zip(df.dtypes, sample), 1)
        ]
    )
    found = df.agg(F.count("*").alias("row_count")).select(F.inline(described), F.col("row_count"))
    return found if order else found.drop("sample")


def completeness_score(columns: Sequence[str]) -> Column:
    """Percent of the columns that hold a value, as a whole number."""
    present = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    return F.round(present * 100.0 / len(columns)).cast("int")


def add_metadata(
    df: DataFrame,
    version: str = "v1.0",
    processing_date: date | None = None,
    id_columns: Sequence[str | Column] = (),
    score_columns: Sequence[str] = (),
) -> DataFrame:
    """Add ID, Processing_Date, Processing_Version and Data_Quality_Score.

    Without ``id_columns`` the ID is unique but not contiguous, and repeatable
    when ``df`` scans written files. With them it is the MD5 of those columns as 32
    hexadecimal digits: the same in every run, and wide enough for any table.
    """
    if id_columns:
        row_id = F.md5(key_text(id_columns).cast("binary"))
    else:
        row_id = F.monotonically_increasing_id()
    day = F.current_date() if processing_date is None else F.lit(processing_date)
    return df.withColumns(
        {
            "ID": row_id,
            "Processing_Date": day,
            "Processing_Version": F.lit(version),
            "Data_Quality_Score": completeness_score(list(score_columns) or df.columns),
        }
    )
