"""Registered queries over the test tables and their DuckDB SQL twins.

Each Spark query takes (spark, sf_dir) and returns a DataFrame; each SQL twin
runs on the same tables registered as views. Column names match one-to-one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import INCIDENT_DATE_FORMATS, parse_date
from ..functions.rules import (CATEGORY, INJURY_TYPE, PLAY_TYPE_REPORT, PLAY_TYPE_WINDOW,
                               REGION_ETL, REGION_REPORT, SEVERITY, SEVERITY_ETL, classify,
                               has_label, with_labels)
from ..functions.text import initial_last, last_token, text_of
from ..operators.joins import last_name_semi, lookup, pre_incident
from ..operators.repair import normalize_incidents, table_profile
from ..operators.star import FACT_COLUMNS, classify_incidents, dim_injury, star_input
from ..operators.stats import by_month, freq, share
from ..session import ensure_checkpoint_dir
from ..sources.readers import (decimals_to_double, read_clean_or_raw, read_csv, read_items, read_parquet,
                               require_columns, require_path)
from ..sources.sinks import write_csv, write_parquet
from ..streaming.daily import run_daily
from . import jobs
from . import sample_views as sv
from .sql_oracle import (sql_classify, sql_date_any, sql_initial_last, sql_last_token, sql_pct,
                         sql_text_of, sql_title)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

DAYS = 7
YEAR = sv.SAMPLE_YEAR
SEASON = sv.SAMPLE_SEASON


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn
    return deco


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return sv._table(spark, sf_dir, name)


def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for round-trip queries."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/sideline-io/{name}-{uuid.uuid4().hex}"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ============================================================== events: interval join
def _events_sides(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    act = ev.select("user_id", "event_id", F.to_date("ts").alias("activity_date"), "event_type")
    inc = (ev.filter(F.col("event_type") == "error")
             .select("user_id", F.col("event_id").alias("incident_id"), F.to_date("ts").alias("incident_date")))
    return inc, act


_EV_CTES = (
    "a AS (SELECT user_id, event_id, CAST(ts AS DATE) AS activity_date, event_type FROM events)",
    "i AS (SELECT user_id, event_id AS incident_id, CAST(ts AS DATE) AS incident_date "
    "FROM events WHERE event_type = 'error')",
    f"""pairs AS (SELECT a.user_id, a.event_id, a.activity_date, a.event_type, i.incident_id, i.incident_date,
                 i.incident_date - {DAYS} AS window_start, i.incident_date - 1 AS window_end
          FROM a JOIN i ON a.user_id = i.user_id
           AND a.activity_date >= i.incident_date - {DAYS} AND a.activity_date < i.incident_date)""",
    "wc AS (SELECT event_type, count(*) AS n FROM pairs GROUP BY event_type)",
    "ws AS (SELECT event_type, n, CAST(n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE) AS share FROM wc)",
)


@register("pre_incident_pairs", _with(*_EV_CTES[:3]) + "SELECT * FROM pairs")
def q_pre_incident_pairs(spark, sf_dir):
    inc, act = _events_sides(spark, sf_dir)
    return pre_incident(act, inc, "user_id", "activity_date", "incident_date", DAYS)


@register("pre_incident_share", _with(*_EV_CTES) + f"SELECT event_type, n, share, {sql_pct('share')} AS pct FROM ws")
def q_pre_incident_share(spark, sf_dir):
    inc, act = _events_sides(spark, sf_dir)
    return jobs.window_profile(inc, act, "user_id", "incident_date", "activity_date", "event_type", DAYS)


@register("pre_vs_all_delta", _with(
    *_EV_CTES,
    "oc AS (SELECT event_type, count(*) AS n FROM a WHERE user_id IN (SELECT user_id FROM i) GROUP BY event_type)",
    "os AS (SELECT event_type, CAST(n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE) AS share FROM oc)") + """
SELECT coalesce(os.event_type, ws.event_type) AS event_type,
       coalesce(os.share, 0.0) AS Season, coalesce(ws.share, 0.0) AS Week_Before_Injury,
       coalesce(ws.share, 0.0) - coalesce(os.share, 0.0) AS delta
FROM os FULL OUTER JOIN ws ON os.event_type = ws.event_type""")
def q_pre_vs_all_delta(spark, sf_dir):
    inc, act = _events_sides(spark, sf_dir)
    return jobs.window_vs_overall(inc, act, "user_id", "incident_date", "activity_date", "event_type", DAYS)


_EV_YEAR = tuple(c.replace(f"i.incident_date - {DAYS}", "i.incident_date - 365") for c in _EV_CTES)


@register("pre_incident_share_365d", _with(*_EV_YEAR) + f"SELECT event_type, n, share, {sql_pct('share')} AS pct FROM ws")
def q_pre_incident_share_365d(spark, sf_dir):
    """A window of a year, counted from its edges."""
    inc, act = _events_sides(spark, sf_dir)
    return jobs.window_profile(inc, act, "user_id", "incident_date", "activity_date", "event_type", 365)


@register("pre_vs_all_delta_365d", SQL["pre_vs_all_delta"].replace(f"i.incident_date - {DAYS}", "i.incident_date - 365"))
def q_pre_vs_all_delta_365d(spark, sf_dir):
    inc, act = _events_sides(spark, sf_dir)
    return jobs.window_vs_overall(inc, act, "user_id", "incident_date", "activity_date", "event_type", 365)


LONG_DAYS, LONG_BUCKET = 30, 7


@register("pre_incident_pairs_30d", _with(
    _EV_CTES[0], _EV_CTES[1],
    f"""pairs AS (SELECT a.user_id, a.event_id, a.activity_date, a.event_type, i.incident_id, i.incident_date,
                 i.incident_date - {LONG_DAYS} AS window_start, i.incident_date - 1 AS window_end
          FROM a JOIN i ON a.user_id = i.user_id
           AND a.activity_date >= i.incident_date - {LONG_DAYS} AND a.activity_date < i.incident_date)""")
          + "SELECT * FROM pairs")
def q_pre_incident_pairs_30d(spark, sf_dir):
    """Long window through the bucketed plan (7-day buckets, exact re-check)."""
    inc, act = _events_sides(spark, sf_dir)
    return pre_incident(act, inc, "user_id", "activity_date", "incident_date", LONG_DAYS,
                        bucket_days=LONG_BUCKET)


@register("event_type_share", f"""
SELECT event_type, n, share, {sql_pct('share')} AS pct FROM (
  SELECT event_type, n, CAST(n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE) AS share
  FROM (SELECT event_type, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY event_type))""")
def q_event_type_share(spark, sf_dir):
    """G8/G9 generic share (total from a scalar subquery) over the whole events table."""
    return share(_t(spark, sf_dir, "events"), "event_type")


@register("events_by_month", """
SELECT CAST(date_trunc('month', CAST(ts AS DATE)) AS DATE) AS month, count(*) AS n
FROM events WHERE ts IS NOT NULL GROUP BY 1""")
def q_events_by_month(spark, sf_dir):
    return by_month(_t(spark, sf_dir, "events").select(F.to_date("ts").alias("day")), "day")


# ============================================================== incidents x activity: J5 / J6
def _j5_inputs(spark, sf_dir):
    inc = sv.incidents(spark, sf_dir).select(initial_last("Player_Name").alias("playerNameFormatted"),
                                             F.col("Date").alias("injuryDate"), "Injury_Type", "Notes")
    act = sv.activity(spark, sf_dir).select("gameId", "period", "playerNameFormatted", "gameDate",
                                            "description", "actionType")
    return inc, act


_J5_CTES = (
    sv.INCIDENTS_SQL,
    sv.ACTIVITY_SQL,
    f"""sev AS (SELECT {sql_initial_last('Player_Name')} AS playerNameFormatted, Date AS injuryDate
         FROM inc WHERE {sql_classify(sql_text_of('Injury_Type', 'Notes'), SEVERITY)} = 'HIGH'
           AND {sql_initial_last('Player_Name')} IS NOT NULL AND Date IS NOT NULL)""",
    f"""ev AS (SELECT gameId, period, playerNameFormatted, gameDate, description, actionType,
               {sql_classify(sql_text_of('description', 'actionType'), PLAY_TYPE_WINDOW)} AS play_type
         FROM act WHERE playerNameFormatted IS NOT NULL AND gameDate IS NOT NULL)""",
    f"""pairs AS (SELECT ev.*, sev.injuryDate, sev.injuryDate - {DAYS} AS window_start,
                         sev.injuryDate - 1 AS window_end
         FROM ev JOIN sev ON ev.playerNameFormatted = sev.playerNameFormatted
          AND ev.gameDate >= sev.injuryDate - {DAYS} AND ev.gameDate < sev.injuryDate)""",
    "wc AS (SELECT play_type, count(*) AS n FROM pairs GROUP BY play_type)",
    "ws AS (SELECT play_type, n, CAST(n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE) AS share FROM wc)",
)


@register("pre_incident_orders", _with(*_J5_CTES[:5]) + "SELECT * FROM pairs")
def q_pre_incident_orders(spark, sf_dir):
    inc, act = _j5_inputs(spark, sf_dir)
    return jobs.pre_incident_events(inc, act, DAYS)


@register("pre_incident_profile", _with(*_J5_CTES) + f"SELECT play_type, n, share, {sql_pct('share')} AS pct FROM ws")
def q_pre_incident_profile(spark, sf_dir):
    inc, act = _j5_inputs(spark, sf_dir)
    return jobs.pre_incident_profile(inc, act, DAYS)


@register("season_vs_window", _with(
    *_J5_CTES,
    """oc AS (SELECT play_type, count(*) AS n FROM ev
              WHERE playerNameFormatted IN (SELECT playerNameFormatted FROM sev) GROUP BY play_type)""",
    "os AS (SELECT play_type, CAST(n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE) AS share FROM oc)") + """
SELECT coalesce(os.play_type, ws.play_type) AS play_type,
       coalesce(os.share, 0.0) AS Season, coalesce(ws.share, 0.0) AS Week_Before_Injury,
       coalesce(ws.share, 0.0) - coalesce(os.share, 0.0) AS delta
FROM os FULL OUTER JOIN ws ON os.play_type = ws.play_type""")
def q_season_vs_window(spark, sf_dir):
    inc, act = _j5_inputs(spark, sf_dir)
    return jobs.season_vs_window(inc, act, DAYS)


@register("season_vs_window_365d", SQL["season_vs_window"].replace(f"- {DAYS}", "- 365"))
def q_season_vs_window_365d(spark, sf_dir):
    """Closed labels over a window of a year, counted from its edges."""
    inc, act = _j5_inputs(spark, sf_dir)
    return jobs.season_vs_window(inc, act, 365)


# ============================================================== rule classifiers
def _label_query(name, rs, text_cols, source="inc"):
    if source == "inc":
        key_sql, keys = "incident_id", ["incident_id"]
        cte = sv.INCIDENTS_SQL
    else:
        key_sql, keys = "gameId, period", ["gameId", "period"]
        cte = sv.ACTIVITY_SQL
    text_sql = (f"lower({text_cols[0]})" if len(text_cols) == 1 else sql_text_of(*text_cols))
    sql = _with(cte) + f"SELECT {key_sql}, {sql_classify(text_sql, rs)} AS label FROM {source}"

    def q(spark, sf_dir):
        df = sv.incidents(spark, sf_dir) if source == "inc" else sv.activity(spark, sf_dir)
        text = F.lower(text_cols[0]) if len(text_cols) == 1 else text_of(*text_cols)
        return df.select(*keys, classify(text, rs).alias("label"))

    register(name, sql)(q)


_label_query("severity_etl", SEVERITY_ETL, ["Injury_Type", "Notes"])
_label_query("severity_text", SEVERITY, ["Injury_Type", "Notes"])
_label_query("severity_notes", SEVERITY, ["Notes"])
_label_query("region_etl", REGION_ETL, ["Injury_Type", "Notes"])
_label_query("region_report", REGION_REPORT, ["Injury_Type", "Notes"])
_label_query("category", CATEGORY, ["Injury_Type", "Notes"])
_label_query("injury_type", INJURY_TYPE, ["Notes"])
_label_query("play_type_window", PLAY_TYPE_WINDOW, ["description", "actionType"], source="act")
_label_query("play_type_report", PLAY_TYPE_REPORT, ["description", "actionType", "subType"], source="act")


@register("document_labels", "SELECT doc_id, "
          + sql_classify("lower(text)", SEVERITY, unicode_words=True) + " AS severity, "
          + sql_classify("lower(text)", REGION_REPORT, unicode_words=True) + " AS region "
          + "FROM documents")
def q_document_labels(spark, sf_dir):
    """Rule classifiers over whole free-text documents (long texts, four languages)."""
    d = _t(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("_t"))
    return with_labels(d, "_t", severity=SEVERITY, region=REGION_REPORT).select("doc_id", "severity", "region")


# ============================================================== J1 clean + J2 summary (D1 D8 D9 C3 G13 E7; G1 G2 G5 G6 G3 G11)
_CLEAN_CTES = (
    sv.INCIDENTS_SQL,
    sv.RAW_INCIDENTS_SQL,
    f"""t AS (SELECT CAST(try_strptime(Date, '%Y-%m-%d') AS DATE) AS Date, {sql_title('Team')} AS Team,
                 {sql_title('Relinquished')} AS Player_Name, {sql_title('Notes')} AS Notes FROM raw)""",
    """t2 AS (SELECT *, CAST(year(Date) AS INTEGER) AS Year FROM t
              WHERE Player_Name IS NOT NULL AND Team IS NOT NULL)""",
    """d AS (SELECT Date, Team, Player_Name, Notes, Year FROM (
              SELECT *, row_number() OVER (PARTITION BY Player_Name, Date
                     ORDER BY Team ASC NULLS FIRST, Notes ASC NULLS FIRST, Year ASC NULLS FIRST) AS rn
              FROM t2) WHERE rn = 1)""",
    f"clean AS (SELECT *, {sql_classify('lower(Notes)', INJURY_TYPE)} AS Injury_Type FROM d)",
)


def _clean(spark, sf_dir):
    return jobs.clean_incidents(sv.raw_incidents(spark, sf_dir))


@register("clean_incidents", _with(*_CLEAN_CTES) + "SELECT * FROM clean")
def q_clean_incidents(spark, sf_dir):
    return _clean(spark, sf_dir)


@register("clean_summary_counts", _with(*_CLEAN_CTES) + """
SELECT count(*) AS rows, count(DISTINCT Player_Name) AS unique_player_name, count(DISTINCT Team) AS unique_team
FROM clean""")
def q_clean_summary_counts(spark, sf_dir):
    return jobs.clean_summary(_clean(spark, sf_dir))["counts"]


@register("top10_players", _with(*_CLEAN_CTES) + """
SELECT Player_Name, count(*) AS n FROM clean WHERE Player_Name IS NOT NULL
GROUP BY Player_Name ORDER BY n DESC, Player_Name ASC LIMIT 10""")
def q_top10_players(spark, sf_dir):
    return jobs.clean_summary(_clean(spark, sf_dir))["top_players"]


@register("top10_teams", _with(*_CLEAN_CTES) + """
SELECT Team, count(*) AS n FROM clean WHERE Team IS NOT NULL
GROUP BY Team ORDER BY n DESC, Team ASC LIMIT 10""")
def q_top10_teams(spark, sf_dir):
    return jobs.clean_summary(_clean(spark, sf_dir))["top_teams"]


@register("per_year", _with(*_CLEAN_CTES) + "SELECT Year, count(*) AS n FROM clean WHERE Year IS NOT NULL GROUP BY Year")
def q_per_year(spark, sf_dir):
    return jobs.clean_summary(_clean(spark, sf_dir))["per_year"]


@register("years", _with(*_CLEAN_CTES) + "SELECT DISTINCT Year FROM clean")
def q_years(spark, sf_dir):
    return jobs.clean_summary(_clean(spark, sf_dir))["years"]


@register("injury_type_freq", _with(*_CLEAN_CTES) + """
SELECT Injury_Type, count(*) AS n FROM clean WHERE Injury_Type IS NOT NULL GROUP BY Injury_Type""")
def q_injury_type_freq(spark, sf_dir):
    return jobs.clean_summary(_clean(spark, sf_dir))["injury_types"]


@register("clean_preview", _with(*_CLEAN_CTES) + """
SELECT * FROM clean ORDER BY Player_Name ASC NULLS FIRST, Date ASC NULLS FIRST, Team ASC NULLS FIRST,
  Notes ASC NULLS FIRST, Year ASC NULLS FIRST, Injury_Type ASC NULLS FIRST LIMIT 5""")
def q_clean_preview(spark, sf_dir):
    return jobs.clean_summary(_clean(spark, sf_dir))["preview"]


@register("freq_with_null", _with(sv.INCIDENTS_SQL) + "SELECT Injury_Type, count(*) AS n FROM inc GROUP BY Injury_Type")
def q_freq_with_null(spark, sf_dir):
    return freq(sv.incidents(spark, sf_dir), "Injury_Type", dropna=False)


# ============================================================== J7 yearly report
_REPORT_CTES = _CLEAN_CTES + (
    sv.ACTIVITY_SQL,
    f"""y AS (SELECT *, {sql_classify('lower(Notes)', SEVERITY)} AS severity,
                {sql_classify(sql_text_of('Injury_Type', 'Notes'), REGION_REPORT)} AS region
         FROM clean WHERE TRY_CAST(Year AS DOUBLE) = {YEAR})""",
    "severe AS (SELECT * FROM y WHERE severity = 'HIGH')",
    f"""evr AS (SELECT *, {sql_classify(sql_text_of('description', 'actionType', 'subType'), PLAY_TYPE_REPORT)}
                AS play_type FROM act WHERE playerName IS NOT NULL)""",
    "lc AS (SELECT play_type, count(*) AS n FROM evr GROUP BY play_type)",
    "ls AS (SELECT play_type, n, CAST(n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE) AS share FROM lc)",
    f"""gc AS (SELECT play_type, count(*) AS n FROM evr WHERE playerName IN (
              SELECT {sql_last_token('Player_Name')} FROM severe
              WHERE Player_Name IS NOT NULL AND Player_Name <> '') GROUP BY play_type)""",
    "gs AS (SELECT play_type, n, CAST(n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE) AS share FROM gc)",
)


def _report(spark, sf_dir):
    return jobs.yearly_report(_clean(spark, sf_dir), sv.activity(spark, sf_dir), YEAR)


@register("report_severity", _with(*_REPORT_CTES) + "SELECT severity, count(*) AS n FROM y GROUP BY severity")
def q_report_severity(spark, sf_dir):
    return _report(spark, sf_dir)["severity"]


@register("report_top_regions", _with(*_REPORT_CTES) + """
SELECT region, count(*) AS n FROM y WHERE region IS NOT NULL GROUP BY region ORDER BY n DESC, region LIMIT 10""")
def q_report_top_regions(spark, sf_dir):
    return _report(spark, sf_dir)["top_regions"]


@register("report_severe_by_region", _with(*_REPORT_CTES) + """
SELECT region, count(*) AS n FROM severe WHERE region IS NOT NULL GROUP BY region""")
def q_report_severe_by_region(spark, sf_dir):
    return _report(spark, sf_dir)["severe_by_region"]


@register("report_severe_by_team", _with(*_REPORT_CTES) + """
SELECT Team, count(*) AS n FROM severe WHERE Team IS NOT NULL GROUP BY Team ORDER BY n DESC, Team LIMIT 10""")
def q_report_severe_by_team(spark, sf_dir):
    return _report(spark, sf_dir)["severe_by_team"]


@register("by_month", _with(*_REPORT_CTES) + """
SELECT CAST(date_trunc('month', Date) AS DATE) AS month, count(*) AS n FROM severe
WHERE Date IS NOT NULL GROUP BY 1""")
def q_by_month(spark, sf_dir):
    return _report(spark, sf_dir)["severe_by_month"]


@register("report_league", _with(*_REPORT_CTES) + "SELECT play_type, n, share FROM ls")
def q_report_league(spark, sf_dir):
    return _report(spark, sf_dir)["league"]


@register("report_severe_group", _with(*_REPORT_CTES) + "SELECT play_type, n, share FROM gs")
def q_report_severe_group(spark, sf_dir):
    return _report(spark, sf_dir)["severe_group"]


@register("league_vs_group", _with(*_REPORT_CTES) + """
SELECT coalesce(ls.play_type, gs.play_type) AS play_type,
       coalesce(ls.share, 0.0) AS League, coalesce(gs.share, 0.0) AS Severe_Group
FROM ls FULL OUTER JOIN gs ON ls.play_type = gs.play_type""")
def q_league_vs_group(spark, sf_dir):
    return _report(spark, sf_dir)["league_vs_group"]


# ============================================================== J3 star schema
_STAR_CTES = (
    sv.INCIDENTS_SQL,
    sv.RAGGED_INCIDENTS_SQL,
    f"""norm AS (SELECT regexp_replace(trim(player_name), '\\s+', ' ', 'g') AS Player_Name,
                   upper(trim(team_code)) AS Team,
                   regexp_replace(trim(injury), '\\s+', ' ', 'g') AS Injury_Type,
                   trim(notes) AS Notes,
                   {sql_date_any('trim(date)')} AS Date
            FROM ragged)""",
    f"""cls AS (SELECT *, CAST(year(Date) AS VARCHAR) AS Year,
                  {sql_classify(sql_text_of('Injury_Type', 'Notes'), REGION_ETL)} AS injury_region,
                  {sql_classify(sql_text_of('Injury_Type', 'Notes'), SEVERITY_ETL)} AS injury_severity,
                  {sql_classify(sql_text_of('Injury_Type', 'Notes'), CATEGORY)} AS injury_category
            FROM norm)""",
    f"s AS (SELECT * FROM cls WHERE Year = '{YEAR}' AND Date IS NOT NULL)",
)


def _star(spark, sf_dir):
    return jobs.star_tables(sv.ragged_incidents(spark, sf_dir), YEAR)


@register("dim_player", _with(*_STAR_CTES) + """
SELECT sha256(upper(Player_Name)) AS player_key, Player_Name FROM (SELECT DISTINCT Player_Name FROM s)""")
def q_dim_player(spark, sf_dir):
    return _star(spark, sf_dir)["dim_player"]


@register("dim_team", _with(*_STAR_CTES) + "SELECT sha256(Team) AS team_key, Team FROM (SELECT DISTINCT Team FROM s)")
def q_dim_team(spark, sf_dir):
    return _star(spark, sf_dir)["dim_team"]


@register("dim_injury", _with(*_STAR_CTES) + """
SELECT sha256(concat_ws('|', injury_category, injury_region, injury_severity)) AS injury_key,
       injury_category, injury_region, injury_severity
FROM (SELECT DISTINCT coalesce(injury_category, 'OTHER') AS injury_category,
                      coalesce(injury_region, 'OTHER') AS injury_region,
                      coalesce(injury_severity, 'UNKNOWN') AS injury_severity FROM s)""")
def q_dim_injury(spark, sf_dir):
    return _star(spark, sf_dir)["dim_injury"]


@register("dim_date", _with(*_STAR_CTES) + """
SELECT CAST(year(Date) * 10000 + month(Date) * 100 + day(Date) AS INTEGER) AS date_key, Date,
       CAST(year(Date) AS INTEGER) AS year, CAST(month(Date) AS INTEGER) AS month,
       CAST(dayofweek(Date) + 1 AS INTEGER) AS day_of_week
FROM (SELECT DISTINCT Date FROM s)""")
def q_dim_date(spark, sf_dir):
    return _star(spark, sf_dir)["dim_date"]


@register("fact_injury", _with(*_STAR_CTES, """k AS (
  SELECT *, sha256(upper(Player_Name)) AS player_key, sha256(Team) AS team_key,
         sha256(concat_ws('|', injury_category, injury_region, injury_severity)) AS injury_key,
         CAST(year(Date) * 10000 + month(Date) * 100 + day(Date) AS INTEGER) AS date_key
  FROM s)""") + """
SELECT sha256(concat_ws('|', player_key, team_key, injury_key, CAST(date_key AS VARCHAR), coalesce(Notes, '')))
         AS fact_injury_key,
       player_key, team_key, injury_key, date_key, Player_Name, Team, injury_category, injury_region,
       injury_severity, Injury_Type, Notes, CAST(""" + str(YEAR) + """ AS INTEGER) AS Year
FROM k""")
def q_fact_injury(spark, sf_dir):
    return _star(spark, sf_dir)["fact_injury"]


@register("alias_repair", _with(sv.INCIDENTS_SQL, sv.RAGGED_INCIDENTS_SQL) + f"""
SELECT regexp_replace(trim(player_name), '\\s+', ' ', 'g') AS Player_Name, upper(trim(team_code)) AS Team,
       trim(notes) AS Notes, {sql_date_any('trim(date)')} AS Date,
       regexp_replace(trim(year), '\\.0$', '') AS Year, CAST(NULL AS VARCHAR) AS Injury_Type
FROM ragged""")
def q_alias_repair(spark, sf_dir):
    raw = sv.ragged_incidents(spark, sf_dir, with_year=True).drop("injury")
    return normalize_incidents(raw)


@register("parse_dates", _with(sv.INCIDENTS_SQL, """p AS (
  SELECT incident_id, CASE WHEN incident_id % 11 = 0 THEN 'n/a'
                           WHEN incident_id % 3 = 0 THEN strftime(Date, '%Y-%m-%d')
                           WHEN incident_id % 3 = 1 THEN strftime(Date, '%m/%d/%Y')
                           ELSE strftime(Date, '%d/%m/%Y') END AS date_text FROM inc)""")
          + f"SELECT incident_id, date_text, {sql_date_any('date_text')} AS Date FROM p")
def q_parse_dates(spark, sf_dir):
    i = sv.incidents(spark, sf_dir)
    k = F.col("incident_id")
    txt = (F.when(k % 11 == 0, F.lit("n/a"))
            .when(k % 3 == 0, F.date_format("Date", "yyyy-MM-dd"))
            .when(k % 3 == 1, F.date_format("Date", "MM/dd/yyyy"))
            .otherwise(F.date_format("Date", "dd/MM/yyyy")))
    p = i.select("incident_id", txt.alias("date_text"))
    return p.withColumn("Date", parse_date("date_text", INCIDENT_DATE_FORMATS))


# ============================================================== names
@register("std_name", _with(sv.INCIDENTS_SQL) + f"""
SELECT incident_id, {sql_initial_last('Player_Name')} AS playerNameFormatted,
       {sql_last_token('Player_Name')} AS last_name FROM inc""")
def q_std_name(spark, sf_dir):
    i = sv.incidents(spark, sf_dir)
    return i.select("incident_id", initial_last("Player_Name").alias("playerNameFormatted"),
                    last_token("Player_Name").alias("last_name"))


@register("last_name_match", _with(sv.INCIDENTS_SQL, sv.ACTIVITY_SQL) + f"""
SELECT gameId, period, playerName FROM act WHERE playerName IN (
  SELECT {sql_last_token('Player_Name')} FROM inc
  WHERE {sql_classify('lower(Notes)', SEVERITY)} = 'HIGH' AND Player_Name IS NOT NULL AND Player_Name <> '')""")
def q_last_name_match(spark, sf_dir):
    i = sv.incidents(spark, sf_dir)
    severe = i.filter(has_label(F.lower("Notes"), SEVERITY, "HIGH"))
    act = sv.activity(spark, sf_dir).select("gameId", "period", "playerName")
    return last_name_semi(act, "playerName", severe, "Player_Name")


# ============================================================== J4 analysis-ready
_J4_CTES = (
    sv.INCIDENTS_SQL,
    sv.ACTIVITY_SQL,
    sv.GAME_DATES_SQL,
    f"""winc AS (SELECT {sql_initial_last('Player_Name')} AS playerNameFormatted, Team, Notes, Injury_Type,
                   Date AS date FROM inc WHERE Date BETWEEN DATE '{SEASON[0]}' AND DATE '{SEASON[1]}')""",
    """g AS (SELECT gameId, gameDate FROM (
              SELECT GAMEID AS gameId, CAST(try_strptime(gameDate, '%Y-%m-%d') AS DATE) AS gameDate,
                     row_number() OVER (PARTITION BY GAMEID
                        ORDER BY CAST(try_strptime(gameDate, '%Y-%m-%d') AS DATE) ASC NULLS FIRST) AS rn
              FROM games) WHERE rn = 1)""",
)


def _j4(spark, sf_dir):
    return jobs.analysis_ready(sv.item_incidents(spark, sf_dir), sv.activity(spark, sf_dir),
                               sv.game_dates(spark, sf_dir), *SEASON)


@register("injuries_windowed", _with(*_J4_CTES) + "SELECT * FROM winc")
def q_injuries_windowed(spark, sf_dir):
    return _j4(spark, sf_dir)[0]


@register("analysis_ready", _with(*_J4_CTES) + """
SELECT a.gameId, a.playerNameI, a.teamId, a.teamTricode, a.period, a.clock, a.actionType, a.description,
       a.shotResult, a.pointsTotal, a.playerNameI AS playerNameFormatted, g.gameDate
FROM act a LEFT JOIN g ON a.gameId = g.gameId
WHERE a.playerNameI IN (SELECT playerNameFormatted FROM winc)""")
def q_analysis_ready(spark, sf_dir):
    return _j4(spark, sf_dir)[1]


# ============================================================== sources / sinks
@register("table_profile", """
SELECT 1 AS position, 'c_custkey' AS column_name, 'bigint' AS data_type, count(*) AS row_count, count(c_custkey) AS non_null FROM customer
UNION ALL SELECT 2, 'c_name', 'string', count(*), count(c_name) FROM customer
UNION ALL SELECT 3, 'c_nationkey', 'int', count(*), count(c_nationkey) FROM customer
UNION ALL SELECT 4, 'c_acctbal', 'double', count(*), count(c_acctbal) FROM customer
UNION ALL SELECT 5, 'c_mktsegment', 'string', count(*), count(c_mktsegment) FROM customer""")
def q_table_profile(spark, sf_dir):
    return table_profile(_t(spark, sf_dir, "customer"))


@register("incident_profile", _with(sv.INCIDENTS_SQL) + """
SELECT 1 AS position, 'incident_id' AS column_name, 'bigint' AS data_type, count(*) AS row_count, count(incident_id) AS non_null FROM inc
UNION ALL SELECT 2, 'Player_Name', 'string', count(*), count(Player_Name) FROM inc
UNION ALL SELECT 3, 'Team', 'string', count(*), count(Team) FROM inc
UNION ALL SELECT 4, 'Date', 'date', count(*), count(Date) FROM inc
UNION ALL SELECT 5, 'Injury_Type', 'string', count(*), count(Injury_Type) FROM inc
UNION ALL SELECT 6, 'Notes', 'string', count(*), count(Notes) FROM inc""")
def q_incident_profile(spark, sf_dir):
    return table_profile(sv.incidents(spark, sf_dir))


@register("decimal_to_double", """
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS o_totalprice, o_orderpriority FROM orders""")
def q_decimal_to_double(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(12,2)"),
                                           "o_orderpriority")
    return decimals_to_double(o)


@register("csv_roundtrip", "SELECT * FROM supplier")
def q_csv_roundtrip(spark, sf_dir):
    src = _t(spark, sf_dir, "supplier")
    path = _scratch(spark, "csv")
    write_csv(src, path)
    return read_csv(spark, path, schema="s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE")


@register("csv_text_roundtrip", """
SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation""")
def q_csv_text_roundtrip(spark, sf_dir):
    path = _scratch(spark, "csv-text")
    write_csv(_t(spark, sf_dir, "nation"), path)
    return read_csv(spark, path)


def _write_ragged(spark, sf_dir, path):
    """Customers in three groups of CSV files: usual order, reversed with a column more, one column less."""
    c = _t(spark, sf_dir, "customer")
    part = lambda i: c.filter(F.col("c_custkey") % 3 == i)
    write_csv(part(0), f"{path}/a")
    write_csv(part(1).withColumn("c_note", F.concat(F.lit("note "), F.col("c_name"))).select("c_note", *reversed(c.columns)), f"{path}/b")
    write_csv(part(2).select("c_name", "c_custkey", "c_mktsegment", "c_nationkey"), f"{path}/c")
    return f"{path}/*"


_RAGGED_SQL = """
SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 3 < 2 THEN c_acctbal END AS c_acctbal, c_mktsegment,
       CASE WHEN c_custkey % 3 = 1 THEN 'note ' || c_name END AS c_note
FROM customer"""


@register("csv_ragged_files", _RAGGED_SQL)
def q_csv_ragged_files(spark, sf_dir):
    """Files of several headers read by name under a schema."""
    path = _write_ragged(spark, sf_dir, _scratch(spark, "csv-ragged"))
    return read_csv(spark, path, required=["c_custkey", "c_name"], schema="c_custkey BIGINT, c_name STRING, c_nationkey INT, "
                    "c_acctbal DOUBLE, c_mktsegment STRING, c_note STRING")


@register("csv_ragged_inferred", _RAGGED_SQL.replace("SELECT c_custkey,", "SELECT CAST(c_custkey AS INTEGER) AS c_custkey,"))
def q_csv_ragged_inferred(spark, sf_dir):
    """The same files, types inferred over all of them."""
    return read_csv(spark, _write_ragged(spark, sf_dir, _scratch(spark, "csv-inferred")), infer=True)


@register("parquet_partition_roundtrip", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS yr FROM orders""")
def q_parquet_partition_roundtrip(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority",
                                           F.year("o_orderdate").cast("int").alias("yr"))
    path = _scratch(spark, "parquet-part")
    write_parquet(o, path, partitions=["o_orderpriority", "yr"])
    back = read_parquet(spark, path)
    return back.select("o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderpriority").cast("string"),
                       F.col("yr").cast("int"))


@register("items_json", """
SELECT CAST(s_suppkey AS DOUBLE) AS s_suppkey, s_name, CAST(s_nationkey AS DOUBLE) AS s_nationkey, s_acctbal,
       CAST('0.00000000000' || s_suppkey AS DOUBLE) AS tiny, CAST(s_suppkey || 'E30' AS DOUBLE) AS huge,
       CAST('0.12345678901' || lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS DOUBLE) AS digits,
       '[{"S":"' || s_name || '"},{"N":"' || s_nationkey || '"}]' AS list, '["a","' || s_name || '"]' AS names,
       s_suppkey % 2 = 0 AS even
FROM supplier""")
def q_items_json(spark, sf_dir):
    """Typed items: numbers of any size, a list, a set and a boolean."""
    s = _t(spark, sf_dir, "supplier")
    key, tag = F.col("s_suppkey").cast("string"), lambda v, t: F.struct(v.alias(t))
    element = lambda **kw: F.struct(*[kw.get(t, F.lit(None).cast("string")).alias(t) for t in ("S", "N")])
    item = F.struct(
        tag(key, "N").alias("s_suppkey"), tag(F.col("s_name"), "S").alias("s_name"),
        tag(F.col("s_nationkey").cast("string"), "N").alias("s_nationkey"),
        tag(F.col("s_acctbal").cast("string"), "N").alias("s_acctbal"),
        tag(F.concat(F.lit("0.00000000000"), key), "N").alias("tiny"),
        tag(F.concat(key, F.lit("E30")), "N").alias("huge"),
        tag(F.concat(F.lit("0.12345678901"), F.lpad(key, 5, "0")), "N").alias("digits"),
        tag(F.array(element(S=F.col("s_name")), element(N=F.col("s_nationkey").cast("string"))), "L").alias("list"),
        tag(F.array(F.lit("a"), F.col("s_name")), "SS").alias("names"),
        tag(F.col("s_suppkey") % 2 == 0, "BOOL").alias("even"),
    ).alias("Item")
    path = _scratch(spark, "items")
    s.select(item).write.mode("overwrite").json(path)
    return read_items(spark, path).select("s_suppkey", "s_name", "s_nationkey", "s_acctbal", "tiny", "huge", "digits",
                                          "list", "names", "even")


@register("csv_free_text_roundtrip", "SELECT doc_id, text, source FROM documents")
def q_csv_free_text_roundtrip(spark, sf_dir):
    """Whole free texts (quotes, commas, line breaks, outer blanks) through a CSV file and back."""
    path = _scratch(spark, "csv-free")
    write_csv(_t(spark, sf_dir, "documents").select("doc_id", "text", "source"), path)
    return read_csv(spark, path, schema="doc_id BIGINT, text STRING, source STRING", multi_line=True)


@register("clean_or_raw", _with(*_CLEAN_CTES) + "SELECT * FROM clean")
def q_clean_or_raw(spark, sf_dir):
    """No cleaned file: the raw file, cleaned."""
    path = _scratch(spark, "raw")
    write_csv(sv.raw_incidents(spark, sf_dir), path)
    return read_clean_or_raw(spark, f"{path}-cleaned", path)


@register("parquet_modes", "SELECT * FROM supplier UNION ALL SELECT * FROM supplier")
def q_parquet_modes(spark, sf_dir):
    """An un-partitioned write, replaced, then appended to."""
    s, path = _t(spark, sf_dir, "supplier"), _scratch(spark, "parquet-modes")
    write_parquet(s.limit(1), path)
    write_parquet(s, path, mode="overwrite")
    write_parquet(s, path, mode="append")
    return read_parquet(spark, path)


@register("required_input", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM customer")
def q_required_input(spark, sf_dir):
    """A file that must be there, with columns that must be there."""
    path = _scratch(spark, "required")
    write_csv(_t(spark, sf_dir, "customer"), path)
    return require_columns(require_path(spark, path), ["c_custkey", "c_name"]).select("c_custkey", "c_name")


@register("star_job_fact", SQL["fact_injury"])
def q_star_job_fact(spark, sf_dir):
    """The star job from a raw file to tables under an output prefix; the fact read back from its folders."""
    path = _scratch(spark, "star")
    write_csv(sv.ragged_incidents(spark, sf_dir), f"{path}/raw")
    paths = jobs.star_job(spark, f"{path}/raw", f"{path}/out/", YEAR)
    fact = read_parquet(spark, paths.fact_injury)
    return fact.select(*FACT_COLUMNS, F.col("Year").cast("int")).withColumn("Team", F.col("Team").cast("string"))


@register("injury_lookup", _with(*_STAR_CTES, """dim AS (
  SELECT DISTINCT injury_category, injury_region, injury_severity FROM s)""") + """
SELECT s.Player_Name, s.Team, s.Date, sha256(concat_ws('|', dim.injury_category, dim.injury_region, dim.injury_severity)) AS injury_key
FROM s LEFT JOIN dim ON s.injury_category = dim.injury_category AND s.injury_region = dim.injury_region
                    AND s.injury_severity = dim.injury_severity""")
def q_injury_lookup(spark, sf_dir):
    """Left lookup on three keys."""
    df = star_input(classify_incidents(normalize_incidents(sv.ragged_incidents(spark, sf_dir))), YEAR)
    found = lookup(df, dim_injury(df), ["injury_category", "injury_region", "injury_severity"])
    return found.select("Player_Name", "Team", "Date", "injury_key")


@register("report_absent_columns", _with(*_REPORT_CTES[:-4], f"""evn AS (
  SELECT {sql_classify("lower(coalesce(description, ''))", PLAY_TYPE_REPORT)} AS play_type
  FROM act WHERE playerName IS NOT NULL)""", "nc AS (SELECT play_type, count(*) AS n FROM evn GROUP BY play_type)") + """
SELECT play_type, n, CAST(n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE) AS share FROM nc""")
def q_report_absent_columns(spark, sf_dir):
    """The report over activity that lacks two of its text columns, and incidents without Injury_Type."""
    act = sv.activity(spark, sf_dir).drop("actionType", "subType")
    return jobs.yearly_report(_clean(spark, sf_dir).drop("Injury_Type"), act, YEAR)["league"]


@register("clean_incidents_timestamp", _with(*_CLEAN_CTES) + "SELECT * FROM clean")
def q_clean_incidents_timestamp(spark, sf_dir):
    """Dates that arrive as TIMESTAMP."""
    raw = sv.raw_incidents(spark, sf_dir)
    return jobs.clean_incidents(raw.withColumn("Date", F.to_timestamp(F.concat("Date", F.lit(" 13:14:15")))))


@register("clean_incidents_us_dates", _with(*_CLEAN_CTES) + "SELECT * FROM clean")
def q_clean_incidents_us_dates(spark, sf_dir):
    """Dates written month first."""
    raw = sv.raw_incidents(spark, sf_dir)
    return jobs.clean_incidents(raw.withColumn("Date", F.date_format(F.to_date("Date"), "MM/dd/yyyy")))


@register("pre_incident_profile_bad_dates", _with(
    *_J5_CTES[:3],
    f"""ev AS (SELECT playerNameFormatted, gameDate,
               {sql_classify(sql_text_of('description', 'actionType'), PLAY_TYPE_WINDOW)} AS play_type
         FROM act WHERE playerNameFormatted IS NOT NULL AND CAST(gameId AS BIGINT) % 5 <> 0)""",
    f"""pairs AS (SELECT ev.* FROM ev JOIN sev ON ev.playerNameFormatted = sev.playerNameFormatted
          AND ev.gameDate >= sev.injuryDate - {DAYS} AND ev.gameDate < sev.injuryDate)""",
    *_J5_CTES[5:]) + f"SELECT play_type, n, share, {sql_pct('share')} AS pct FROM ws")
def q_pre_incident_profile_bad_dates(spark, sf_dir):
    """Game dates as text, a fifth of the games with an unreadable one."""
    inc, act = _j5_inputs(spark, sf_dir)
    bad = F.col("gameId").cast("bigint") % 5 == 0
    act = act.withColumn("gameDate", F.when(bad, "n/a").otherwise(F.date_format("gameDate", "MM/dd/yyyy")))
    return jobs.pre_incident_profile(inc, act, DAYS)


@register("analysis_ready_incremental", SQL["analysis_ready"])
def q_analysis_ready_incremental(spark, sf_dir):
    """Two daily runs; incidents, game dates and half of the activity arrive with the second, whose files have their
    columns in another order and one more."""
    base = _scratch(spark, "daily")
    act = sv.activity(spark, sf_dir).select(*jobs.ACTIVITY_COLUMNS)
    inc, games = sv.item_incidents(spark, sf_dir), sv.game_dates(spark, sf_dir)
    early = F.col("gameId").cast("bigint") % 2 == 0
    write_csv(act.filter(early), f"{base}/in/day1")
    run_daily(spark, f"{base}/in/*", inc.filter("crc32(player_name) % 3 = 0"),
              games.filter("crc32(GAMEID) % 2 = 0"), f"{base}/out", None, *SEASON)
    write_csv(act.filter(~early).select(F.col("clock").alias("wall_clock"), *reversed(act.columns)), f"{base}/in/day2")
    return run_daily(spark, f"{base}/in/*", inc, games, f"{base}/out", None, *SEASON)
