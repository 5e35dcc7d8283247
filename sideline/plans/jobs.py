"""Composite batch jobs. Each returns DataFrames; only the ``*_job`` runners write.

Inputs are DataFrames with the column names used by incident files
(Player_Name, Team, Date, Notes, Injury_Type, ...) and activity files
(gameId, playerNameI, playerName, description, actionType, subType, ...).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import INCIDENT_DATE_FORMATS, between_dates, parse_date
from ..functions.rules import (INJURY_TYPE, PLAY_TYPE_REPORT, PLAY_TYPE_WINDOW, REGION_REPORT,
                               SEVERITY, classify, has_label)
from ..functions.text import initial_last, last_token, text_of, title_text, to_number_or_null
from ..operators.joins import (last_names, lookup, overall_and_window_counts, pre_incident,
                               pre_incident_counts, restrict_to)
from ..operators.repair import (derive_if_missing, drop_if_present, ensure_columns, in_year,
                                normalize_incidents, rename_if)
from ..operators.onepass import counts_of, frequencies
from ..operators.star import build_star, classify_incidents, star_members
from ..operators.stats import (as_percent, by_month, closed_label_mixes, count_summary, dedup_first, freq, ordered_freq, preview,
                               share_of_counts, sorted_distinct, summary_of, with_delta)
from ..session import staged
from ..sources.readers import read_clean_or_raw, read_csv, read_items, read_parquet, require_columns
from ..sources.sinks import StarPaths, write_csv, write_parquet

# Activity columns kept in the analysis-ready table.
ACTIVITY_COLUMNS = ("gameId", "playerNameI", "teamId", "teamTricode", "period", "clock",
                    "actionType", "description", "shotResult", "pointsTotal")

# Default analysis season bounds (inclusive).
SEASON_START, SEASON_END = "2018-10-01", "2019-05-01"


# --------------------------------------------------------------------------- J1 / J2
def clean_incidents(raw: DataFrame, null_text: str | None = None,
                    date_formats: Sequence[str] = INCIDENT_DATE_FORMATS,
                    order_by: Sequence[str] | None = None) -> DataFrame:
    """Clean a raw incident table.

    drop Acquired; Relinquished -> Player_Name; strip + title-case Player_Name,
    Team, Notes; parse Date (bad -> NULL); Year from Date; drop rows without
    Player_Name or Team; keep the first row per (Player_Name, Date) by
    ``order_by`` (default: the remaining columns); Injury_Type from the notes
    unless the input already carries one.

    ``null_text='nan'`` renders missing text as 'Nan' before the NULL filter,
    reproducing a pandas ``astype(str)`` pipeline; the default keeps NULL.
    """
    df = drop_if_present(raw, "Acquired")
    df = rename_if(df, "Relinquished", "Player_Name")
    require_columns(df, ["Player_Name", "Team", "Notes", "Date"])
    if null_text is None:  # title case is NULL only where the raw text is: test that, before the work
        df = df.na.drop(how="any", subset=["Player_Name", "Team"])
    cols = {c: F.col(f"`{c}`") for c in df.columns}
    for c in ("Player_Name", "Team", "Notes"):
        cols[c] = title_text(c, null_text)
    cols["Date"] = parse_date("Date", date_formats)
    df = df.select(*[v.alias(k) for k, v in cols.items()])
    # the year is the same for all rows of a date: added last, so that a filter on it reaches the rows before the aggregate
    df = dedup_first(df.drop("Year") if "Year" in raw.columns else df, ["Player_Name", "Date"],
                     [c for c in order_by if c != "Year"] if order_by else None)
    df = df.withColumn("Year", F.year("Date").cast("int"))
    return derive_if_missing(df, "Injury_Type", classify(F.lower("Notes"), INJURY_TYPE))


def summary_frequencies(clean: DataFrame) -> DataFrame:
    """All counts of the sanity tables from one pass (``onepass.frequencies``)."""
    return frequencies(clean, {c: (c, None) for c in ("Player_Name", "Team", "Year", "Injury_Type")})


def clean_summary(clean: DataFrame, k: int = 10, counts: DataFrame | None = None) -> dict[str, DataFrame]:
    """Post-clean sanity tables. ``counts``: the kept result of ``summary_frequencies``, of which all but the preview
    are then made; without it each table reads ``clean``."""
    out = {"preview": preview(clean, 5, ["Player_Name", "Date"])}
    if counts is not None:
        of = lambda c, **kw: ordered_freq(counts_of(counts, c, c, clean.schema[c].dataType.simpleString()), c, **kw)
        return out | {
            "counts": summary_of(counts, ["Player_Name", "Team"]),
            "years": of("Year", dropna=False, order="key").select("Year"),
            "top_players": of("Player_Name", limit=k),
            "top_teams": of("Team", limit=k),
            "per_year": of("Year", order="key"),
            "injury_types": of("Injury_Type"),
        }
    return out | {
        "counts": count_summary(clean, ["Player_Name", "Team"]),
        "years": sorted_distinct(clean, "Year"),
        "top_players": freq(clean, "Player_Name", limit=k),
        "top_teams": freq(clean, "Team", limit=k),
        "per_year": freq(clean, "Year", order="key"),
        "injury_types": freq(clean, "Injury_Type"),
    }


def clean_job(spark: SparkSession, raw_path: str, out_path: str, multi_line: bool = True, **kw) -> None:
    """Notes may hold line breaks (``multi_line=False`` where they do not: large files are then split);
    ``kw`` go to ``clean_incidents``."""
    write_csv(clean_incidents(read_csv(spark, raw_path, multi_line=multi_line), **kw), out_path)


def clean_summary_job(spark: SparkSession, clean_path: str, out_prefix: str, k: int = 10,
                      multi_line: bool = True) -> dict[str, str]:
    """J2 over a cleaned incident file: every summary table written as Parquet. The file is parsed once for all counts
    and once for the preview."""
    clean = read_csv(spark, clean_path, multi_line=multi_line)
    base = out_prefix.rstrip("/")
    out = {}
    with staged(summary_frequencies(clean), "summary_counts") as counts:  # a row per distinct value
        for name, df in clean_summary(clean, k, counts).items():
            out[name] = f"{base}/{name}"
            write_parquet(df, out[name])
    return out


# --------------------------------------------------------------------------- J3
def star_tables(raw: DataFrame, year: int = 2018) -> dict[str, DataFrame]:
    """Normalise, classify and model a raw incident table into the five star tables."""
    return build_star(classify_incidents(normalize_incidents(raw)), year)


def star_job(spark: SparkSession, raw_path: str, prefix: str, year: int = 2018, multi_line: bool = True) -> StarPaths:
    """Read raw incident CSV(s) as text, build and write the star schema.

    The classified input is written once to the shared checkpoint folder and read twice: for the
    members of all dimensions, which are then written from that small table, and for the fact.
    """
    raw = read_csv(spark, raw_path, multi_line=multi_line)
    paths = StarPaths(prefix)
    with staged(classify_incidents(normalize_incidents(raw)), "star_input") as classified:
        with staged(star_members(classified, year), "star_members") as found:  # a row per distinct member
            tables = build_star(classified, year, found)
            for name in ("dim_player", "dim_team", "dim_injury", "dim_date"):
                write_parquet(tables[name], paths[name])
        write_parquet(tables["fact_injury"], paths.fact_injury, partitions=["Team", "Year"])
    return paths


# --------------------------------------------------------------------------- J4
def windowed_incidents(incidents: DataFrame, start: str = SEASON_START, end: str = SEASON_END,
                       name_col: str = "player_name", date_col: str = "date") -> DataFrame:
    """Incidents with 'F. Last' names inside the closed date range [start, end]."""
    d = parse_date(date_col, INCIDENT_DATE_FORMATS)
    return (ensure_columns(incidents, ["Injury_Type", "Notes"]).select(initial_last(name_col).alias("playerNameFormatted"),
                             "Team", "Notes", "Injury_Type", d.alias("date"))
                     .filter(between_dates("date", start, end)))


def analysis_ready(incidents: DataFrame, activity: DataFrame, game_dates: DataFrame,
                   start: str = SEASON_START, end: str = SEASON_END,
                   dedup_games: bool = True) -> tuple[DataFrame, DataFrame]:
    """(windowed incidents, activity of those players with its game date).

    Activity is restricted to players present in the windowed incidents
    (semi join, 'F. Last' match) and left-joined to one game date per game
    (``dedup_games=False`` keeps every game-date row and can multiply events).
    """
    inc = windowed_incidents(incidents, start, end)
    act = activity.select(*ACTIVITY_COLUMNS)
    act = restrict_to(act, "playerNameI", inc, "playerNameFormatted")
    games = game_dates.select(F.col("GAMEID").alias("gameId"),
                              parse_date("gameDate", INCIDENT_DATE_FORMATS).alias("gameDate"))
    final = lookup(act, games, "gameId", "left", dedup=dedup_games)
    return inc, final


def analysis_ready_job(spark: SparkSession, incidents_path: str, activity_path: str,
                       game_dates_path: str, out_prefix: str, source: str = "csv", multi_line: bool = True, **kw) -> None:
    """J4 runner. ``source='csv'`` reads CSV extracts (text columns; incidents with ``multi_line``);
    ``source='items'`` reads the item-table exports directly (``read_items``)."""
    if source == "csv":
        read = lambda p, **kw: read_csv(spark, p, **kw)
    elif source == "items":
        read = lambda p, **kw: read_items(spark, p)
    else:
        raise ValueError(f"unknown source {source!r}")
    inc, final = analysis_ready(read(incidents_path, multi_line=multi_line), read(activity_path), read(game_dates_path), **kw)
    base = out_prefix.rstrip("/")
    write_parquet(inc, f"{base}/injuries_windowed")
    write_parquet(final, f"{base}/analysis_ready")


# --------------------------------------------------------------------------- J5 / J6
def severe_incidents(incidents: DataFrame) -> DataFrame:
    """Incidents with a player and date whose severity (Injury_Type + Notes) is HIGH."""
    inc = ensure_columns(incidents, ["Injury_Type", "Notes"])
    if not isinstance(inc.schema["injuryDate"].dataType, T.DateType):
        inc = inc.withColumn("injuryDate", parse_date("injuryDate", INCIDENT_DATE_FORMATS))
    return (inc.na.drop(subset=["playerNameFormatted", "injuryDate"])
               .filter(has_label(text_of("Injury_Type", "Notes"), SEVERITY, "HIGH"))
               .withColumn("severity", F.lit("HIGH")))


def play_events(activity: DataFrame) -> DataFrame:
    """Activity with a player and a game date, labelled by play type (description + actionType).
    Dates may be text; rows with unreadable ones are left out. Absent text columns count as empty."""
    act = ensure_columns(activity, ["description", "actionType"])
    if not isinstance(act.schema["gameDate"].dataType, T.DateType):
        act = act.withColumn("gameDate", parse_date("gameDate", INCIDENT_DATE_FORMATS))
    return (act.na.drop(subset=["playerNameFormatted", "gameDate"])
                    .withColumn("play_type", classify(text_of("description", "actionType"), PLAY_TYPE_WINDOW)))


def window_profile(incidents: DataFrame, activity: DataFrame, on: str, incident_date: str,
                   activity_date: str, label: str, days: int = 7,
                   labels: Sequence[str] | None = None) -> DataFrame:
    """(label, n, share, pct) over the (activity, incident) pairs of the pre-incident window.
    ``labels``: the closed label set, when known (saves a shuffle and the total's subquery)."""
    if labels is not None:
        shares = pre_incident_counts(activity, incidents, on, activity_date, incident_date, label, days,
                                     labels=labels, share_col="share")
        shares = shares.withColumn("pct", as_percent("share"))
    else:
        counts = pre_incident_counts(activity, incidents, on, activity_date, incident_date, label, days)
        shares = share_of_counts(counts)
    return shares.orderBy(F.col("share").desc(), F.col(label))


def window_vs_overall(incidents: DataFrame, activity: DataFrame, on: str, incident_date: str,
                      activity_date: str, label: str, days: int = 7,
                      overall_name: str = "Season", window_name: str = "Week_Before_Injury",
                      labels: Sequence[str] | None = None) -> DataFrame:
    """Label mix of all activity of the people with incidents vs their pre-incident mix,
    delta = window - overall, sorted by delta desc."""
    mixes = window_mixes(incidents, activity, on, incident_date, activity_date, label, days, labels)
    return mixes_delta(mixes, label, overall_name, window_name)


def window_mixes(incidents: DataFrame, activity: DataFrame, on: str, incident_date: str,
                 activity_date: str, label: str, days: int = 7,
                 labels: Sequence[str] | None = None) -> DataFrame:
    """label, n_overall, share_overall, n_window, share_window, in one pass over activity. With a
    closed label set (``labels``) shares come from one aggregate row; else the totals are a scalar
    subquery over the label counts, whose exchange is reused."""
    counted = overall_and_window_counts(activity, incidents, on, activity_date, incident_date, label, days)
    weights = {"overall": F.col("_n"), "window": F.col("_n") * F.col("_m")}
    if labels is not None:
        return closed_label_mixes(counted, label, labels, weights)
    counts = counted.groupBy(label).agg(*[F.sum(w).alias(f"n_{k}") for k, w in weights.items()])
    totals = counts.select(F.struct(*[F.sum(f"n_{k}").cast("double").alias(k) for k in weights])).scalar()
    share = lambda k: F.coalesce(F.try_divide(F.col(f"n_{k}").cast("double"), totals[k]), F.lit(0.0))
    return counts.select(label, *[c for k in weights for c in (f"n_{k}", share(k).alias(f"share_{k}"))])


def mixes_delta(mixes: DataFrame, label: str, overall_name: str = "Season",
                window_name: str = "Week_Before_Injury") -> DataFrame:
    """(label, overall share, window share, delta) of ``window_mixes``, sorted by delta desc. Pairs are
    activity of the same people, so no label has window rows only."""
    cmp = mixes.filter("n_overall > 0").select(label, F.col("share_overall").alias(overall_name),
                                               F.col("share_window").alias(window_name))
    return with_delta(cmp, window_name, overall_name, label)


def mixes_profile(mixes: DataFrame, label: str, which: str = "window") -> DataFrame:
    """(label, n, share, pct) of one of the mixes, sorted by share desc."""
    p = mixes.filter(F.col(f"n_{which}") > 0).select(label, F.col(f"n_{which}").alias("n"),
                                                     F.col(f"share_{which}").alias("share"))
    return p.withColumn("pct", as_percent("share")).orderBy(F.col("share").desc(), F.col(label))


def _injury_dated(incidents: DataFrame) -> DataFrame:
    return incidents if "injuryDate" in incidents.columns else incidents.withColumnRenamed("date", "injuryDate")


def pre_incident_profile(incidents: DataFrame, activity: DataFrame, days: int = 7) -> DataFrame:
    """Play-type mix (play_type, n, share, pct) of activity in the ``days`` before each severe incident.

    ``incidents`` is the windowed-incident table (``date`` or ``injuryDate``);
    ``activity`` the analysis-ready table.
    """
    sev = severe_incidents(_injury_dated(incidents)).select("playerNameFormatted", "injuryDate")
    ev = play_events(activity).select("playerNameFormatted", "gameDate", "play_type")
    return window_profile(sev, ev, "playerNameFormatted", "injuryDate", "gameDate", "play_type", days,
                          PLAY_TYPE_WINDOW.labels)


def pre_incident_events(incidents: DataFrame, activity: DataFrame, days: int = 7) -> DataFrame:
    """The (event, severe incident) pairs themselves."""
    sev = severe_incidents(_injury_dated(incidents)).select("playerNameFormatted", "injuryDate")
    return pre_incident(play_events(activity), sev, "playerNameFormatted", "gameDate", "injuryDate", days)


def season_mixes(incidents: DataFrame, activity: DataFrame, days: int = 7) -> DataFrame:
    """Season-long and pre-incident play counts and shares of severe-incident players (``window_mixes``)."""
    sev = severe_incidents(_injury_dated(incidents)).select("playerNameFormatted", "injuryDate")
    ev = play_events(activity).select("playerNameFormatted", "gameDate", "play_type")
    return window_mixes(sev, ev, "playerNameFormatted", "injuryDate", "gameDate", "play_type", days,
                        PLAY_TYPE_WINDOW.labels)


def season_vs_window(incidents: DataFrame, activity: DataFrame, days: int = 7) -> DataFrame:
    """Season-long play mix of severe-incident players vs their pre-incident mix, with delta."""
    return mixes_delta(season_mixes(incidents, activity, days), "play_type")


# --------------------------------------------------------------------------- J7
def year_incidents(incidents: DataFrame, year: int = 2018) -> DataFrame:
    """The year's incidents with their severity (from the notes) and region. Absent text columns count as empty."""
    inc = ensure_columns(incidents, ["Injury_Type", "Notes"])
    inc = in_year(inc.withColumn("Year", to_number_or_null("Year")), year)
    if "Date" in inc.columns and not isinstance(inc.schema["Date"].dataType, T.DateType):
        inc = inc.withColumn("Date", parse_date("Date", INCIDENT_DATE_FORMATS))
    inc = inc.withColumn("severity", classify(F.lower("Notes"), SEVERITY))
    return inc.withColumn("region", classify(text_of("Injury_Type", "Notes"), REGION_REPORT))


def report_frequencies(incidents: DataFrame, year: int = 2018) -> DataFrame:
    """What the report tables count, and the last names of the severe group, from one pass over the incidents
    (``onepass.frequencies``)."""
    inc = year_incidents(incidents, year)
    severe = F.col("severity") == "HIGH"
    named = severe & F.col("Player_Name").isNotNull() & (F.col("Player_Name") != "")
    tables = {"severity": ("severity", None), "top_regions": ("region", None), "severe_by_region": ("region", severe),
              "severe_by_month": (F.trunc(F.col("Date"), "month"), severe), "severe_last_names": (last_token("Player_Name"), named)}
    if "Team" in inc.columns:
        tables["severe_by_team"] = ("Team", severe)
    return frequencies(inc, tables)


def report_mixes(incidents: DataFrame, activity: DataFrame, year: int = 2018, counts: DataFrame | None = None) -> DataFrame:
    """play_type, n_league, share_league, n_group, share_group: the play mix of everyone, and of players whose
    last name is that of a player with a severe incident, in one pass over activity.

    Activity is counted per (player, play type); the distinct last names are joined to those counts
    as a flag, and one aggregate row holds both mixes. ``counts``: the kept result of ``report_frequencies``, which
    has the last names.
    """
    require_columns(activity, ["playerName"])
    act = ensure_columns(activity, ["description", "actionType", "subType"])
    ev = (act.filter(F.col("playerName").isNotNull())
             .withColumn("play_type", classify(text_of("description", "actionType", "subType"), PLAY_TYPE_REPORT)))
    per_player = ev.groupBy("playerName", "play_type").agg(F.count(F.lit(1)).alias("_n"))
    if counts is None:
        last = last_names(year_incidents(incidents, year).filter(F.col("severity") == "HIGH"), "Player_Name")
    else:
        last = counts_of(counts, "severe_last_names", "_last")
    names = last.select(F.col("_last").alias("playerName"), F.lit(True).alias("_severe"))
    return closed_label_mixes(per_player.join(names, "playerName", "left"), "play_type", PLAY_TYPE_REPORT.labels,
                              {"league": F.col("_n"), "group": F.when(F.col("_severe"), F.col("_n"))})


def yearly_report(incidents: DataFrame, activity: DataFrame, year: int = 2018, k: int = 10,
                  mixes: DataFrame | None = None, counts: DataFrame | None = None) -> dict[str, DataFrame]:
    """Severity / region report for one year and league vs severe-group play mix. ``mixes`` and ``counts``: the kept
    results of ``report_mixes`` and ``report_frequencies``; without them each table reads what it needs when it is used."""
    if counts is not None:
        of = lambda t, col, **kw: ordered_freq(counts_of(counts, t, col), col, **kw)
        out = {
            "severity": of("severity", "severity", dropna=False),
            "top_regions": of("top_regions", "region", limit=k),
            "severe_by_region": of("severe_by_region", "region"),
            "severe_by_month": ordered_freq(counts_of(counts, "severe_by_month", "month", "date"), "month", order="key"),
        }
        if "Team" in incidents.columns:
            out["severe_by_team"] = of("severe_by_team", "Team", limit=k)
    else:
        inc = year_incidents(incidents, year)
        severe = inc.filter(F.col("severity") == "HIGH")
        out = {
            "severity": freq(inc, "severity", dropna=False),
            "top_regions": freq(inc, "region", limit=k),
            "severe_by_region": freq(severe, "region"),
            "severe_by_month": by_month(severe, "Date"),
        }
        if "Team" in severe.columns:
            out["severe_by_team"] = freq(severe, "Team", limit=k)
    mixes = report_mixes(incidents, activity, year, counts) if mixes is None else mixes
    out["league"] = mixes_profile(mixes, "play_type", "league").drop("pct")
    out["severe_group"] = mixes_profile(mixes, "play_type", "group").drop("pct")
    out["league_vs_group"] = (mixes.filter("n_league > 0")
                              .select("play_type", F.col("share_league").alias("League"),
                                      F.col("share_group").alias("Severe_Group"))
                              .orderBy(F.col("League").desc(), "play_type"))
    return out


# --------------------------------------------------------------------------- runners
def window_analysis_job(spark: SparkSession, incidents_path: str, activity_path: str, out_prefix: str,
                        days: int = 7) -> None:
    """J5 + J6 over the Parquet outputs of the analysis-ready job, from one pass over activity."""
    inc = read_parquet(spark, incidents_path)
    act = read_parquet(spark, activity_path)
    base = out_prefix.rstrip("/")
    with staged(season_mixes(inc, act, days), "window_mixes") as mixes:  # a row per play type
        write_parquet(mixes_profile(mixes, "play_type"), f"{base}/pre_incident_profile")
        write_parquet(mixes_delta(mixes, "play_type"), f"{base}/season_vs_window")


def report_job(spark: SparkSession, clean_path: str, raw_path: str, activity_path: str,
               out_prefix: str, year: int = 2018, multi_line: bool = True) -> dict[str, str]:
    """Every report table written as Parquet under ``out_prefix``.

    The incidents (cleaned file, else the raw file cleaned on the fly) are read once, for the staged counts of
    five tables and the severe group's last names (a row per distinct value); activity is read once, for the staged
    play mixes (a row per play type).
    """
    act = require_columns(read_csv(spark, activity_path), ["playerName"])
    base = out_prefix.rstrip("/")
    out = {}
    inc = read_clean_or_raw(spark, clean_path, raw_path, multi_line=multi_line)
    with staged(report_frequencies(inc, year), "report_counts") as counts:
        with staged(report_mixes(inc, act, year, counts), "report_mixes") as mixes:
            for name, df in yearly_report(inc, act, year, mixes=mixes, counts=counts).items():
                out[name] = f"{base}/{name}"
                write_parquet(df, out[name])
    return out
