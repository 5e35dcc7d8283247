"""Join operators: lookups, key restriction, semi joins and the pre-incident interval join.

Join strategy (broadcast / shuffle-hash / sort-merge) is left to Catalyst and
AQE, which measure the sides at runtime; no side is force-broadcast because
none has a size bound that holds at every scale. AQE's skew-join handling
splits hot partitions of inner, left-outer and left-semi joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import last_token
from .stats import closed, dedup_first, stack_label_sums

#: Days up to which a window is counted by one row per incident and day.
LONG_WINDOW = 14


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def lookup(df: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left",
           dedup: bool = False) -> DataFrame:
    """Equi-join a table to a lookup table on same-named key(s).

    ``dedup=True`` keeps one lookup row per key first, so several rows per key
    cannot multiply the left side.
    """
    keys = _keys(on)
    if dedup:
        dim = dedup_first(dim, keys)
    return df.join(dim, keys, how)


def semi(df: DataFrame, keys_df: DataFrame, left_on: str | Sequence[str],
         right_on: str | Sequence[str] | None = None) -> DataFrame:
    """Rows of ``df`` whose key appears in ``keys_df`` (SQL EXISTS). NULL keys never match.

    The key side is deduplicated first: the distinct is aggregated partially in
    every map task, so a key repeated on a third of the key rows is shuffled as
    a handful of rows, and its hash partitioning is reused by the join.
    """
    lk = _keys(left_on)
    rk = _keys(right_on) if right_on is not None else lk
    if len(lk) != len(rk):
        raise ValueError("left_on and right_on must have the same length")
    right = keys_df.select(*[F.col(r).alias(f"_rk{i}") for i, r in enumerate(rk)]).distinct()
    cond = None
    for i, l in enumerate(lk):
        c = df[l] == right[f"_rk{i}"]
        cond = c if cond is None else cond & c
    return df.join(right, cond, "left_semi")


def restrict_to(df: DataFrame, left_key: str, keys_df: DataFrame, right_key: str,
                keep_as: str | None = None) -> DataFrame:
    """Inner join against a distinct key list, written as a semi join.

    Same rows and columns as ``df JOIN keys.distinct() ON df.left_key = keys.right_key``:
    each left row matches at most one distinct key, and the right key column
    (equal to the left key on every output row) is re-added as ``keep_as``.
    """
    out = semi(df, keys_df, left_key, right_key)
    name = keep_as or right_key
    if name != left_key:
        out = out.withColumn(name, F.col(left_key))
    return out


def last_name_semi(df: DataFrame, name_col: str, people: DataFrame, people_name_col: str) -> DataFrame:
    """Approximate person match: ``df.name_col`` equals the last token of a person's name.

    Namesakes over-match by design (same behaviour as matching on last names).
    """
    return semi(df, last_names(people, people_name_col), name_col, "_last")


def last_names(people: DataFrame, name_col: str) -> DataFrame:
    """Distinct last tokens (``_last``) of the names; NULL and empty names have none."""
    return (people.filter(F.col(name_col).isNotNull() & (F.col(name_col) != ""))
                  .select(last_token(name_col).alias("_last")).distinct())


def _window_days(incidents: DataFrame, incident_day: str, days: int) -> DataFrame:
    """Explode each incident into the ``days`` calendar days of its window [d-days, d-1]."""
    return (incidents
            .withColumn("window_start", F.date_sub(F.col(incident_day), days))
            .withColumn("window_end", F.date_sub(F.col(incident_day), 1))
            .withColumn("_win_day", F.explode(F.sequence("window_start", "window_end"))))


def pre_incident(activity: DataFrame, incidents: DataFrame, on: str | Sequence[str],
                 activity_date: str, incident_date: str, days: int = 7,
                 bucket_days: int = 1) -> DataFrame:
    """Interval join: activity in the ``days`` days before each incident, same key(s).

    Predicate (day grain): ``incident_date - days <= activity_date < incident_date``;
    the incident day itself is excluded. One output row per (activity, incident)
    pair, so an activity row before two incidents appears twice. ``window_start``
    and ``window_end`` (= incident_date - 1) are carried.

    Plan: each incident is exploded into the ``bucket_days``-wide day buckets its
    window touches and the join is an equi-join on (key, bucket). With the
    default ``bucket_days=1`` the buckets are the window days themselves and no
    residual predicate is needed. Keying on the day as well spreads a hot key
    (one person with a third of all activity) over its days; a hot (key, day) is
    split further by AQE's skew-join handling. For long windows a wider bucket
    bounds the explosion to ``days / bucket_days + 1`` rows per incident, and
    the exact window predicate is re-checked on the candidate pairs.
    Activity and incident columns other than the keys must not share names.
    """
    keys = _keys(on)
    clash = (set(activity.columns) & set(incidents.columns)) - set(keys)
    if clash:
        raise ValueError(f"activity and incidents share non-key columns {sorted(clash)}; rename first")
    if bucket_days < 1:
        raise ValueError("bucket_days must be >= 1")
    if days < 1:
        return (activity.join(incidents, keys, "inner").limit(0)
                .withColumn("window_start", F.lit(None).cast("date"))
                .withColumn("window_end", F.lit(None).cast("date")))
    inc = incidents.withColumn(incident_date, F.to_date(incident_date))
    inc = inc.filter(F.col(incident_date).isNotNull())
    inc = (inc.withColumn("window_start", F.date_sub(F.col(incident_date), days))
              .withColumn("window_end", F.date_sub(F.col(incident_date), 1)))
    if bucket_days == 1:
        inc = inc.withColumn("_bucket", F.explode(F.sequence("window_start", "window_end")))
        act_bucket = F.to_date(activity_date)
    else:
        inc = inc.withColumn("_bucket", F.explode(F.sequence(_bucket_of("window_start", bucket_days),
                                                             _bucket_of("window_end", bucket_days))))
        act_bucket = _bucket_of(F.to_date(activity_date), bucket_days)
    # Incident keys are renamed so both sides can come from one table (no self-join ambiguity).
    inc = inc.select(*[F.col(k).alias(f"_ik{i}") for i, k in enumerate(keys)],
                     *[c for c in incidents.columns if c not in keys],
                     "window_start", "window_end", "_bucket")
    act = (activity.withColumn(activity_date, F.to_date(activity_date))
                   .withColumn("_abucket", act_bucket))
    cond = [F.col(k) == F.col(f"_ik{i}") for i, k in enumerate(keys)]
    cond.append(F.col("_abucket") == F.col("_bucket"))
    if bucket_days > 1:
        cond.append(F.col(activity_date) >= F.col("window_start"))
        cond.append(F.col(activity_date) <= F.col("window_end"))
    joined = act.join(inc, cond, "inner")
    return joined.select(*activity.columns,
                         *[c for c in incidents.columns if c not in keys],
                         "window_start", "window_end")


def _bucket_of(day, width: int):
    d = F.col(day) if isinstance(day, str) else day
    return F.floor(F.datediff(d, F.lit("1970-01-01").cast("date")) / F.lit(width)).cast("long")


def _day_counts(activity: DataFrame, keys: list[str], activity_date: str, by: str,
                labels: Sequence[str] | None) -> DataFrame:
    """Activity pre-aggregated per (key, day): long form (key, _day, by, _n), or with a
    closed label set, wide form (key, _day, _n0.._nk) hash-partitioned by (key, day)."""
    base = activity.select(*keys, F.to_date(activity_date).alias("_day"), by)
    if labels is None:
        return (base.filter(F.col(by).isNotNull())
                    .groupBy(*keys, "_day", by).agg(F.count(F.lit(1)).alias("_n")))
    return closed(base, by, labels).groupBy(*keys, "_day").agg(
        *[F.count_if(F.col(by) == F.lit(lab)).alias(f"_n{i}") for i, lab in enumerate(labels)])


def _window_cover(incidents: DataFrame, keys: list[str], incident_date: str, days: int) -> DataFrame:
    """(key, _day, _m): how many incidents' windows cover each day."""
    inc = incidents.select(*keys, F.to_date(incident_date).alias("_inc_day"))
    inc = inc.filter(F.col("_inc_day").isNotNull())
    return (_window_days(inc, "_inc_day", days)
            .groupBy(*keys, F.col("_win_day").alias("_day")).agg(F.count(F.lit(1)).alias("_m")))


def _covered(day_counts: DataFrame, incidents: DataFrame, keys: list[str], incident_date: str, days: int) -> DataFrame:
    """``day_counts`` with ``_m``, how many incidents' windows cover the day (0: none), from two rows per
    incident whatever the length of the window.

    A window [d-days, d-1] covers a day if it ends on that day or later and does not end before it begins: so
    ``_m`` is the sum, over the same and later days of the person, of +1 where a window ends and -1 on the day before one
    begins. Activity days and these edges, both aggregated before they move, are sorted once per person; a
    person has at most as many rows as there are days (and labels).
    """
    inc = incidents.select(*keys, F.to_date(incident_date).alias("_inc_day"))
    edge = lambda before, w: F.struct(F.date_sub("_inc_day", before).alias("_day"), F.lit(w).cast("long").alias("_w"))
    edges = (inc.na.drop().select(*keys, F.explode(F.array(edge(1, 1), edge(days + 1, -1))).alias("_e"))
                .groupBy(*keys, F.col("_e._day").alias("_day")).agg(F.sum("_e._w").alias("_w")))
    both = day_counts.withColumn("_is_day", F.lit(True)).unionByName(edges, allowMissingColumns=True)
    later = Window.partitionBy(*keys).orderBy(F.col("_day").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return (both.na.drop(subset=keys + ["_day"]).withColumn("_m", F.coalesce(F.sum("_w").over(later), F.lit(0)).cast("long"))
                .filter("_is_day").drop("_w", "_is_day"))


def _label_totals(df: DataFrame, by: str, labels: Sequence[str] | None, count_col: str,
                  weight: str | None = None, share_col: str | None = None) -> DataFrame:
    """Per-label totals of day counts (optionally weighted by a cover count). With a
    closed label set the totals are one aggregate row, and shares come from it
    directly (``share_col``)."""
    w = F.col(weight) if weight else F.lit(1)
    if labels is None:
        return df.groupBy(by).agg(F.sum(F.col("_n") * w).alias(count_col))
    totals = df.agg(*[F.sum(F.col(f"_n{i}") * w).alias(f"_s{i}") for i in range(len(labels))])
    return stack_label_sums(totals, labels, by, count_col, share_col)


def pre_incident_counts(activity: DataFrame, incidents: DataFrame, on: str | Sequence[str],
                        activity_date: str, incident_date: str, by: str, days: int = 7,
                        count_col: str = "n", labels: Sequence[str] | None = None,
                        share_col: str | None = None) -> DataFrame:
    """Pair counts of ``pre_incident`` grouped by the activity column ``by`` (NULL
    labels excluded), without materialising the pairs.

    count(by) over pairs = sum over (key, day) of
    [activity rows with that label on that day] x [incidents whose window covers that day].
    Both sides are pre-aggregated (map-side partial aggregation) before the
    shuffle, so the join sees at most one row per (key, day[, label]). Windows of more than
    ``LONG_WINDOW`` days are not written out by day: their edges are summed (``_covered``), so no
    row count grows with ``days``.

    With ``labels`` (the closed label set of a rule table) the activity side is
    aggregated by (key, day) with one count per label: its hash partitioning
    then already satisfies the join, saving a second shuffle of that side.
    A label outside ``labels`` (a rule table's labels + default) is an error;
    ``share_col`` also adds each label's share of all pairs.
    """
    keys = _keys(on)
    if days < 1:
        return activity.select(by).limit(0).withColumn(count_col, F.lit(0).cast("long"))
    labels = list(dict.fromkeys(labels)) if labels is not None else None
    day_counts = _day_counts(activity, keys, activity_date, by, labels)
    if days > LONG_WINDOW:
        pairs = _covered(semi(day_counts, incidents, keys), incidents, keys, incident_date, days).filter("_m > 0")
    else:
        pairs = day_counts.join(_window_cover(incidents, keys, incident_date, days), [*keys, "_day"], "inner")
    return _label_totals(pairs, by, labels, count_col, "_m", share_col if labels is not None else None)


def overall_and_window_counts(activity: DataFrame, incidents: DataFrame, on: str | Sequence[str],
                              activity_date: str, incident_date: str, by: str, days: int = 7) -> DataFrame:
    """(person and day counts) of the activity of people with an incident: key(s), ``_day``, ``by``,
    ``_n`` (rows) and ``_m`` (how many incidents' windows cover the day; 0: none). NULL labels excluded.

    ``sum(_n)`` per label is the mix over all their activity, ``sum(_n * _m)`` the mix over the
    pre-incident window pairs: both from one pass over activity, which is pre-aggregated to
    (key, day, label) before any shuffle of raw rows.
    """
    keys = _keys(on)
    day_counts = semi(_day_counts(activity, keys, activity_date, by, None), incidents, keys)
    if days < 1:
        return day_counts.withColumn("_m", F.lit(0).cast("long"))
    if days > LONG_WINDOW:
        return _covered(day_counts, incidents, keys, incident_date, days)
    cover = _window_cover(incidents, keys, incident_date, days)
    return (day_counts.join(cover, [*keys, "_day"], "left")
            .withColumn("_m", F.coalesce("_m", F.lit(0).cast("long"))))
