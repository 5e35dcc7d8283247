"""Several small tables from one pass over a large one.

Each row gives one tagged row per table it belongs to; an aggregate by (tag, value), partial in every map task,
reduces them before anything moves. What is left has a row per distinct value, whatever the input's size, so it is
written once and every table is a filter of it. No row is copied whole: a tagged row holds its value alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLE, VALUE = "_table", "_value"


def _as_text(value: Column, kind: T.DataType) -> Column:
    """Text that differs exactly where values do (as an aggregate tells them apart), and casts back."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        value = value + F.lit(0.0).cast(kind)  # -0.0 is 0.0
    return value.cast("string")


def can_tag(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StringType, T.IntegralType, T.DecimalType, T.FractionalType, T.BooleanType, T.DateType))


def _tagged(df: DataFrame, rows: Sequence[tuple[Column | None, Column]]) -> DataFrame:
    """The structs of ``rows`` (condition, struct) whose condition holds, one row each."""
    all_of = F.array(*[row if cond is None else F.when(cond, row) for cond, row in rows])
    return df.select(F.explode(all_of).alias("_r")).filter("_r IS NOT NULL").select("_r.*")


def frequencies(df: DataFrame, tables: Mapping[str, tuple[Column | str, Column | None]]) -> DataFrame:
    """(_table, _value, n): how often each value of each named expression occurs, NULL included, among the rows
    of its condition (None: all rows). Values are text."""
    columns = {name: F.col(f"`{c}`") if isinstance(c, str) else c for name, (c, _) in tables.items()}
    kinds = df.select(*[c.alias(f"_{i}") for i, c in enumerate(columns.values())]).schema
    rows = [(cond, F.struct(F.lit(name).alias(TABLE), _as_text(columns[name], kinds[i].dataType).alias(VALUE)))
            for i, (name, (_, cond)) in enumerate(tables.items())]
    return _tagged(df, rows).groupBy(TABLE, VALUE).agg(F.count(F.lit(1)).alias("n"))


def members(df: DataFrame, tables: Mapping[str, Sequence[str]]) -> DataFrame:
    """(_table, _m0, _m1, ...): the distinct members, as text, of several column lists."""
    width = max(len(cols) for cols in tables.values())
    rows = []
    for name, cols in tables.items():
        parts = [_as_text(F.col(f"`{c}`"), df.schema[c].dataType) for c in cols] + [F.lit(None).cast("string")] * (width - len(cols))
        rows.append((None, F.struct(F.lit(name).alias(TABLE), *[p.alias(f"_m{i}") for i, p in enumerate(parts)])))
    return _tagged(df, rows).distinct()


def counts_of(freqs: DataFrame, table: str, col: str, kind: str = "string") -> DataFrame:
    """(``col``, n) of one table of ``frequencies``."""
    return freqs.filter(F.col(TABLE) == table).select(F.col(VALUE).cast(kind).alias(col), "n")


def members_of(found: DataFrame, table: str, cols: Mapping[str, str]) -> DataFrame:
    """One table of ``members``; ``cols``: its columns and their types."""
    return found.filter(F.col(TABLE) == table).select(*[F.col(f"_m{i}").cast(k).alias(c) for i, (c, k) in enumerate(cols.items())])
