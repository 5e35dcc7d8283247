"""Projection and schema-repair operators for ragged incident inputs.

All decisions here read only the schema (driver-side metadata); the data
work is a single ``select`` per call so Catalyst can collapse them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import INCIDENT_DATE_FORMATS, parse_date
from ..functions.text import squeeze_ws, strip_point_zero

# Column alias map for incident files, in precedence order
# (source name -> canonical name; the first present source wins).
INCIDENT_ALIASES = (
    ("player_name", "Player_Name"),
    ("player", "Player_Name"),
    ("team_abbrev", "Team"),
    ("team_code", "Team"),
    ("injury", "Injury_Type"),
    ("injurytype", "Injury_Type"),
    ("notes", "Notes"),
    ("date", "Date"),
    ("year", "Year"),
)

# Columns every incident table must carry (added as typed NULL).
REQUIRED_INCIDENT_COLUMNS = ("Player_Name", "Team", "Date", "Injury_Type", "Notes")


def check_unambiguous(df: DataFrame) -> None:
    """Raise if two columns differ only by case (Spark resolves names case-insensitively)."""
    seen: dict[str, str] = {}
    for c in df.columns:
        k = c.lower()
        if k in seen:
            raise ValueError(f"columns {seen[k]!r} and {c!r} differ only by case; "
                             "rename one before processing")
        seen[k] = c


def drop_if_present(df: DataFrame, *cols: str) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.drop(*present) if present else df


def rename_if(df: DataFrame, src: str, dst: str) -> DataFrame:
    """Rename ``src`` to ``dst`` when ``src`` exists and ``dst`` does not."""
    if src in df.columns and dst not in df.columns:
        return df.withColumnRenamed(src, dst)
    return df


def apply_aliases(df: DataFrame, aliases: Iterable[tuple[str, str]] = INCIDENT_ALIASES) -> DataFrame:
    """Apply an ordered alias list in one projection.

    Each (src, dst) renames only if ``src`` is a current column and ``dst`` is not
    yet one, so the first matching alias for a target wins and others stay as-is.
    """
    check_unambiguous(df)
    names = list(df.columns)
    for src, dst in aliases:
        if src in names and dst not in names:
            names[names.index(src)] = dst
    if names == list(df.columns):
        return df
    return df.select(*[F.col(f"`{o}`").alias(n) for o, n in zip(df.columns, names)])


def ensure_columns(df: DataFrame, required: Mapping[str, T.DataType] | Sequence[str]) -> DataFrame:
    """Add each missing required column as a typed NULL (strings by default)."""
    if not isinstance(required, Mapping):
        required = {c: T.StringType() for c in required}
    missing = [(c, t) for c, t in required.items() if c not in df.columns]
    if not missing:
        return df
    return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in missing])


def trim_all(df: DataFrame) -> DataFrame:
    """Trim spaces on every column; every column becomes a string."""
    return df.select(*[F.trim(F.col(f"`{c}`").cast("string")).alias(c) for c in df.columns])


def derive_if_missing(df: DataFrame, name: str, expr: Column, else_expr: Column | None = None) -> DataFrame:
    """Add ``name`` from ``expr`` when absent; otherwise optionally rewrite it with ``else_expr``."""
    if name not in df.columns:
        return df.withColumn(name, expr)
    if else_expr is not None:
        return df.withColumn(name, else_expr)
    return df


def normalize_incidents(df: DataFrame, date_formats: Sequence[str] = INCIDENT_DATE_FORMATS) -> DataFrame:
    """Standardise a ragged incident table.

    trim every column -> alias map -> required columns -> multi-format date ->
    Year (from Date if absent, else scrub a trailing '.0') -> whitespace and case repair.
    """
    df = trim_all(df)
    df = apply_aliases(df)
    df = ensure_columns(df, REQUIRED_INCIDENT_COLUMNS)
    df = df.withColumn("Date", parse_date("Date", date_formats))
    df = derive_if_missing(df, "Year", F.year("Date").cast("string"), strip_point_zero("Year"))
    return (df.withColumn("Player_Name", squeeze_ws("Player_Name"))
              .withColumn("Team", F.upper("Team"))
              .withColumn("Injury_Type", squeeze_ws("Injury_Type")))


def in_year(df: DataFrame, year: int, col: str = "Year") -> DataFrame:
    """Rows whose year column equals ``year`` (string or numeric column)."""
    dtype = df.schema[col].dataType
    value = F.lit(str(year)) if isinstance(dtype, T.StringType) else F.lit(year)
    return df.filter(F.col(col) == value)


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: (position, column_name, data_type, row_count, non_null), in one pass."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count(F.col(f"`{f.name}`")).alias(f"_nn{i}") for i, f in enumerate(fields)]
    counts = df.agg(*aggs)
    if not fields:
        return counts.select(F.lit(None).cast("int").alias("position"))
    def q(s: str) -> str:
        return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    stack = ", ".join(f"{i + 1}, {q(f.name)}, {q(f.dataType.simpleString())}, _nn{i}"
                      for i, f in enumerate(fields))
    return counts.selectExpr(
        f"stack({len(fields)}, {stack}) AS (position, column_name, data_type, non_null)", "_rows AS row_count"
    ).select(F.col("position").cast("int").alias("position"), "column_name", "data_type", "row_count", "non_null")
