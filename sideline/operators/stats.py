"""Counting, distribution and dedup operators.

Every aggregate here has a map-side partial step, so a hot label or key is reduced
inside each map task before the shuffle. All are hash aggregates except keep-first
dedup over text columns (``dedup_first``), which Spark sorts. Totals
for shares come from a scalar subquery over the (small) count table, never
from a single-partition window or a driver round trip.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .onepass import TABLE, VALUE, can_tag, frequencies

_FIXED_WIDTH = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def freq(df: DataFrame, col: str, dropna: bool = True, order: str = "count",
         limit: int | None = None, count_col: str = "n") -> DataFrame:
    """Frequency table (label, n).

    ``dropna`` excludes NULL labels (else NULL is one group). ``order='count'``
    sorts by count desc then label asc (a total order, so top-k is deterministic);
    ``order='key'`` sorts by label asc.
    """
    src = df.filter(F.col(col).isNotNull()) if dropna else df
    return ordered_freq(src.groupBy(col).agg(F.count(F.lit(1)).alias(count_col)), col, dropna, order, limit, count_col)


def ordered_freq(out: DataFrame, col: str, dropna: bool = True, order: str | None = "count",
                 limit: int | None = None, count_col: str = "n") -> DataFrame:
    """A frequency table in the order of ``freq``."""
    if dropna:
        out = out.filter(F.col(col).isNotNull())
    if order == "count":
        out = out.orderBy(F.col(count_col).desc(), F.col(col).asc_nulls_first())
    elif order == "key":
        out = out.orderBy(F.col(col).asc_nulls_first())
    elif order is not None:
        raise ValueError(f"unknown order {order!r}")
    if limit is not None:
        out = out.limit(limit)
    return out


def as_percent(share: Column | str, decimals: int = 2) -> Column:
    """share x 100 rounded half-to-even the way numpy rounds floats:
    multiply by 10**decimals, round to the nearest even integer, divide back."""
    s = F.col(share) if isinstance(share, str) else share
    f = float(10 ** decimals)
    return F.rint(s * 100.0 * f) / f


def share_of_counts(counts: DataFrame, count_col: str = "n", share_col: str = "share",
                    pct_col: str | None = "pct") -> DataFrame:
    """Add share = n / sum(n) (and its percent) to a count table."""
    total = counts.select(F.sum(count_col)).scalar()
    out = counts.withColumn(share_col, F.col(count_col).cast("double") / total.cast("double"))
    if pct_col:
        out = out.withColumn(pct_col, as_percent(share_col))
    return out


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def stack_label_sums(sums: DataFrame, labels: Sequence[str], by: str, count_col: str = "n",
                     share_col: str | None = "share") -> DataFrame:
    """Turn one row of per-label sums (columns ``_s0.._sk``, in ``labels`` order) into
    (label, n[, share]) rows; labels with no rows are left out.

    The total is the sum of the row's columns, so shares need no second pass or
    subquery: the label set is closed, so the row is bounded by it.
    """
    sums = sums.select(*[F.coalesce(F.col(f"_s{i}"), F.lit(0)).cast("long").alias(f"_s{i}")
                         for i in range(len(labels))])
    total = None
    for i in range(len(labels)):
        total = F.col(f"_s{i}") if total is None else total + F.col(f"_s{i}")
    sums = sums.withColumn("_t", total.cast("double"))
    if share_col:
        parts = ", ".join(f"{_sql_str(lab)}, _s{i}, CAST(_s{i} AS DOUBLE) / NULLIF(_t, 0)"
                          for i, lab in enumerate(labels))
        out = sums.selectExpr(f"stack({len(labels)}, {parts}) AS (`{by}`, `{count_col}`, `{share_col}`)")
    else:
        parts = ", ".join(f"{_sql_str(lab)}, _s{i}" for i, lab in enumerate(labels))
        out = sums.selectExpr(f"stack({len(labels)}, {parts}) AS (`{by}`, `{count_col}`)")
    return out.filter(F.col(count_col) > 0)


def closed(df: DataFrame, by: str, labels: Sequence[str]) -> DataFrame:
    """``df``, in which a label outside the closed set is an error (per-label sums would
    silently leave it out of counts and shares). NULL labels pass and are not counted."""
    stray = F.raise_error(F.concat(F.lit("label outside the closed set: "), F.col(by))).cast("string")
    return df.withColumn(by, F.when(F.col(by).isNull() | F.col(by).isin(list(labels)), F.col(by)).otherwise(stray))


def closed_label_mixes(df: DataFrame, by: str, labels: Sequence[str], weights: dict[str, Column]) -> DataFrame:
    """Totals of several weightings of a closed-label column in one aggregate row, turned into
    one row per label: (label, n and share of each weighting as ``n_<name>``, ``share_<name>``).

    One pass gives every mix, and each is a projection of the result. The row is bounded by the
    label set.
    """
    sums = [F.sum(F.when(F.col(by) == F.lit(lab), w)).alias(f"_{name}{i}")
            for name, w in weights.items() for i, lab in enumerate(labels)]
    row = closed(df, by, labels).agg(*sums)
    at = lambda name, i: f"coalesce(_{name}{i}, 0L)"
    totals = {name: "(" + " + ".join(at(name, i) for i in range(len(labels))) + ")" for name in weights}
    parts = [", ".join([_sql_str(lab)] + [x for name in weights for x in (
        at(name, i), f"coalesce(CAST({at(name, i)} AS DOUBLE) / NULLIF(CAST({totals[name]} AS DOUBLE), 0), 0D)")])
        for i, lab in enumerate(labels)]
    names = [f"`{by}`"] + [x for name in weights for x in (f"`n_{name}`", f"`share_{name}`")]
    return row.selectExpr(f"stack({len(labels)}, {', '.join(parts)}) AS ({', '.join(names)})")


def closed_label_shares(df: DataFrame, by: str, labels: Sequence[str], weight: str | None = None,
                        count_col: str = "n", share_col: str = "share") -> DataFrame:
    """(label, n, share) for a column whose values come from a closed label set
    (e.g. a rule table's labels), in one global aggregate with per-label sums."""
    w = F.col(weight) if weight else F.lit(1)
    sums = closed(df, by, labels).agg(*[F.sum(F.when(F.col(by) == F.lit(lab), w).otherwise(F.lit(0))).alias(f"_s{i}")
                                        for i, lab in enumerate(labels)])
    return stack_label_sums(sums, labels, by, count_col, share_col)


def share(df: DataFrame, col: str, dropna: bool = True, count_col: str = "n",
          share_col: str = "share", pct_col: str | None = "pct") -> DataFrame:
    """(label, n, share, pct) with rows ordered by share desc, label asc."""
    counts = freq(df, col, dropna=dropna, order=None, count_col=count_col)
    return (share_of_counts(counts, count_col, share_col, pct_col)
            .orderBy(F.col(share_col).desc(), F.col(col).asc_nulls_first()))


def compare_profiles(a: DataFrame, b: DataFrame, on: str, value: str, name_a: str, name_b: str) -> DataFrame:
    """Full alignment of two label->value tables; a label missing on one side gets 0.0.

    Written as union + group-by (one shuffle of two small tables) instead of a
    full outer join.
    """
    left = a.select(F.col(on), F.col(value).cast("double").alias(name_a), F.lit(0.0).alias(name_b))
    right = b.select(F.col(on), F.lit(0.0).alias(name_a), F.col(value).cast("double").alias(name_b))
    return (left.unionByName(right).groupBy(on)
            .agg(F.sum(name_a).alias(name_a), F.sum(name_b).alias(name_b))
            .orderBy(F.col(name_a).desc(), F.col(on).asc_nulls_first()))


def with_delta(cmp: DataFrame, minuend: str, subtrahend: str, on: str, name: str = "delta") -> DataFrame:
    """delta = minuend - subtrahend, sorted by delta desc, label asc."""
    return (cmp.withColumn(name, F.col(minuend) - F.col(subtrahend))
               .orderBy(F.col(name).desc(), F.col(on).asc_nulls_first()))


def by_month(df: DataFrame, date_col: str, month_col: str = "month", count_col: str = "n") -> DataFrame:
    """Counts per calendar month of non-NULL dates; month = first day of month.
    Months without rows are absent."""
    return (df.filter(F.col(date_col).isNotNull())
              .groupBy(F.trunc(F.col(date_col), "month").alias(month_col))
              .agg(F.count(F.lit(1)).alias(count_col))
              .orderBy(month_col))


def dedup_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key combination (NULL keys form one group): the first row
    by ``order_by`` ascending (NULLs first), ties broken by the remaining columns.

    Implemented as ``min(struct(order..., rest...))`` per key rather than
    ``row_number()`` over a key window: the aggregate is computed partially
    in every map task, so a key holding a third of all rows is reduced to one
    row per task before the shuffle instead of being sorted in one task.
    A single fixed-width value column uses ``min`` with a NULL check instead
    (a hash aggregate rather than a sort-based one).
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    order = [c for c in (order_by or []) if c not in keys]
    tail = [c for c in rest if c not in order]
    fields = order + tail
    if len(fields) == 1 and isinstance(df.schema[fields[0]].dataType, _FIXED_WIDTH):
        # One fixed-width value: min() with NULL first runs as a hash aggregate.
        v = F.col(fields[0])
        first = F.when(F.count_if(v.isNull()) > 0, F.lit(None).cast(df.schema[fields[0]].dataType)) \
                 .otherwise(F.min(v))
        picked = df.groupBy(*keys).agg(first.alias(fields[0]))
        return picked.select(*df.columns)
    picked = (df.groupBy(*keys)
                .agg(F.min(F.struct(*[F.col(c).alias(f"_f{i}") for i, c in enumerate(fields)])).alias("_first")))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_first._f{fields.index(c)}").alias(c)
                           for c in df.columns])


def count_summary(df: DataFrame, distinct_cols: Sequence[str]) -> DataFrame:
    """One row: rows, and the exact distinct count (NULLs excluded) of each column.

    Counted in two levels, by (column, value) and then by column (``onepass.frequencies``), so that no row is copied
    for each counted column; columns of other than plain types are counted by Spark's own distinct aggregate.
    """
    if not distinct_cols or not all(can_tag(df.schema[c].dataType) for c in distinct_cols):
        return df.agg(F.count(F.lit(1)).alias("rows"),
                      *[F.countDistinct(c).alias(f"unique_{c.lower()}") for c in distinct_cols])
    return summary_of(frequencies(df, {c: (c, None) for c in distinct_cols}), distinct_cols)


def summary_of(freqs: DataFrame, distinct_cols: Sequence[str]) -> DataFrame:
    """``count_summary`` from the frequencies of the columns."""
    rows = F.coalesce(F.sum(F.when(F.col(TABLE) == distinct_cols[0], F.col("n"))), F.lit(0)).cast("long")
    return freqs.agg(rows.alias("rows"), *[F.count_if((F.col(TABLE) == c) & F.col(VALUE).isNotNull()).alias(f"unique_{c.lower()}")
                                           for c in distinct_cols])


def sorted_distinct(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(F.col(col).asc_nulls_first())


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows under a total order (``order_by`` then the remaining columns,
    NULLs first): a top-k, so only k rows per partition reach the final merge."""
    keys = list(order_by or [])
    keys += [c for c in df.columns if c not in keys]
    return df.orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in keys]).limit(n)
