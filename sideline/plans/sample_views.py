"""Incident- and activity-shaped views derived from the TPC-H-style test tables.

The test tables carry no injury or play vocabulary, so note and play texts
are drawn, by key, from small fixed phrase tables; everything else (people,
groups, dates, keys, row counts) comes from the tables themselves, and every
view grows with them. The same recipe is written once in Spark here and once
as SQL (``*_SQL``) for the DuckDB oracle.

incidents: one per order     person = customer, group = nation, day = order date
activity:  one per line item  person = customer, game = order, day = ship date
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Incident note phrases (NULL included), picked by o_orderkey % 31 + 1. Every label
# of the incident rule tables occurs.
NOTE_PHRASES = (
    "torn ACL in right knee",
    "partial tear of left hamstring",
    "grade 2 sprain of left ankle",
    "surgical procedure on nose",
    "fractured metacarpal",
    "lumbar soreness",
    "adductor strain",
    "broken collarbone",
    "concussion, broken nose",
    "back and hip contusion",
    "dislocation of finger",
    "breakdown in conditioning",
    "left foot",
    "rest",
    None,
    "stiff neck",
    "sore elbow",
    "right wrist sprain",
    "bruised chest",
    "hip pointer",
    "quad contusion",
    "tight calf",
    "separated shoulder",
    "surgery on thumb",
    "inflammation in toe",
    "achilles rupture",
    "bruise on forearm",
    "rotator cuff repair",
    "skull fracture",
    "groin strain",
    "sternum bruise",
)
# Injury type texts, picked by o_orderkey % 7 + 1.
TYPE_PHRASES = (None, "Fracture", None, "Grade 2", None, "Strain", None)

# Play rows (description, actionType, subType), picked by
# (l_orderkey * 7 + l_linenumber) % 11 + 1.
PLAY_DESCRIPTIONS = (
    "James 1' Driving Dunk (2 PTS)",
    "Paul 4' Driving Layup",
    "Paul drive to the rim",
    "MISS Curry 26' 3PT Jump Shot",
    "Durant 15' pullup",
    "Durant 15' Jump Shot",
    "Adams REBOUND (Off:1 Def:2)",
    "Gobert BLOCK (1 BLK)",
    "Green P.FOUL (P1.T1)",
    "Harden shot",
    None,
)
PLAY_ACTION_TYPES = ("Made Shot", "Made Shot", "Other", "Missed Shot", "Made Shot", "Made Shot",
                     "Rebound", None, "Foul", "Made Shot", None)
PLAY_SUB_TYPES = ("Driving Dunk Shot", "Driving Layup Shot", None, "Jump Shot", "Pullup", "Jump Shot",
                  "Unknown", None, "Personal", "Layup Shot", None)

# The sample season and report year (the test orders span 1995-2001).
SAMPLE_YEAR = 1998
SAMPLE_SEASON = ("1998-10-01", "1999-05-01")


def _arr(values) -> Column:
    return F.array(*[F.lit(v).cast("string") for v in values])


def _pick(values, index: Column) -> Column:
    return F.element_at(_arr(values), (index % len(values) + 1).cast("int"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """incident_id, Player_Name, Team, Date (DATE), Injury_Type, Notes."""
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    return j.select(
        F.col("o_orderkey").alias("incident_id"),
        F.concat_ws(" ", "c_mktsegment", "c_name").alias("Player_Name"),
        F.col("n_name").alias("Team"),
        F.to_date("o_orderdate").alias("Date"),
        _pick(TYPE_PHRASES, F.col("o_orderkey")).alias("Injury_Type"),
        _pick(NOTE_PHRASES, F.col("o_orderkey")).alias("Notes"),
    )


def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transaction-file shape: Date (text), Team, Acquired, Relinquished, Notes.
    Every 13th order is an 'acquired' row (no relinquished player)."""
    i = incidents(spark, sf_dir)
    acquired = (F.col("incident_id") % 13) == 0
    return i.select(
        F.date_format("Date", "yyyy-MM-dd").alias("Date"),
        "Team",
        F.when(acquired, F.col("Player_Name")).alias("Acquired"),
        F.when(~acquired, F.col("Player_Name")).alias("Relinquished"),
        "Notes",
    )


def ragged_incidents(spark: SparkSession, sf_dir: str, with_year: bool = False) -> DataFrame:
    """Ragged shape for the star ETL: lower-case aliased names, mixed date formats,
    doubled spaces and lower-case teams on some rows."""
    i = incidents(spark, sf_dir)
    k = F.col("incident_id")
    fmt = (F.when(k % 3 == 0, F.date_format("Date", "yyyy-MM-dd"))
            .when(k % 3 == 1, F.date_format("Date", "MM/dd/yyyy"))
            .otherwise(F.date_format("Date", "dd/MM/yyyy")))
    cols = [
        F.when(k % 5 == 0, F.regexp_replace("Player_Name", " ", "  ")).otherwise(F.col("Player_Name"))
         .alias("player_name"),
        F.when(k % 2 == 0, F.lower("Team")).otherwise(F.col("Team")).alias("team_code"),
        F.col("Injury_Type").alias("injury"),
        F.col("Notes").alias("notes"),
        fmt.alias("date"),
    ]
    if with_year:
        cols.append(F.concat(F.year("Date").cast("string"), F.lit(".0")).alias("year"))
    return i.select(*cols)


def item_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item-table shape used by the analysis-ready pipeline: player_name, Team, Notes, Injury_Type, date."""
    i = incidents(spark, sf_dir)
    return i.select(F.col("Player_Name").alias("player_name"), "Team", "Notes", "Injury_Type",
                    F.date_format("Date", "yyyy-MM-dd").alias("date"))


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Play-by-play shape, one row per line item."""
    l = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                 "l_quantity", "l_returnflag", "l_shipdate")
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    j = l.join(o, l.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
    idx = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    initial = F.concat(F.substring("c_mktsegment", 1, 1), F.lit(". "), F.col("c_name"))
    return j.select(
        F.col("l_orderkey").cast("string").alias("gameId"),
        initial.alias("playerNameI"),
        F.col("c_name").alias("playerName"),
        initial.alias("playerNameFormatted"),
        F.col("c_nationkey").cast("string").alias("teamId"),
        F.substring("c_mktsegment", 1, 3).alias("teamTricode"),
        F.col("l_linenumber").cast("string").alias("period"),
        F.concat((F.col("l_partkey") % 12).cast("string"), F.lit(":00")).alias("clock"),
        _pick(PLAY_ACTION_TYPES, idx).alias("actionType"),
        _pick(PLAY_SUB_TYPES, idx).alias("subType"),
        _pick(PLAY_DESCRIPTIONS, idx).alias("description"),
        F.col("l_returnflag").alias("shotResult"),
        F.col("l_quantity").cast("int").cast("string").alias("pointsTotal"),
        F.to_date("l_shipdate").alias("gameDate"),
    )


def game_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GAMEID, gameDate (text); several rows per game (one per line item)."""
    l = _table(spark, sf_dir, "lineitem")
    return l.select(F.col("l_orderkey").cast("string").alias("GAMEID"),
                    F.date_format("l_shipdate", "yyyy-MM-dd").alias("gameDate"))


# ----------------------------------------------------------------------------- SQL twins
def sql_list(values) -> str:
    def lit(v):
        return "NULL" if v is None else "'" + v.replace("'", "''") + "'"
    return "CAST([" + ", ".join(lit(v) for v in values) + "] AS VARCHAR[])"


def sql_pick(values, index_sql: str) -> str:
    return f"list_extract({sql_list(values)}, CAST(({index_sql}) % {len(values)} + 1 AS INTEGER))"


INCIDENTS_SQL = f"""inc AS (
  SELECT o.o_orderkey AS incident_id,
         concat_ws(' ', c.c_mktsegment, c.c_name) AS Player_Name,
         n.n_name AS Team,
         CAST(o.o_orderdate AS DATE) AS Date,
         {sql_pick(TYPE_PHRASES, 'o.o_orderkey')} AS Injury_Type,
         {sql_pick(NOTE_PHRASES, 'o.o_orderkey')} AS Notes
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

RAW_INCIDENTS_SQL = """raw AS (
  SELECT strftime(Date, '%Y-%m-%d') AS Date, Team,
         CASE WHEN incident_id % 13 = 0 THEN Player_Name END AS Acquired,
         CASE WHEN incident_id % 13 <> 0 THEN Player_Name END AS Relinquished,
         Notes
  FROM inc)"""

RAGGED_INCIDENTS_SQL = """ragged AS (
  SELECT CASE WHEN incident_id % 5 = 0 THEN replace(Player_Name, ' ', '  ') ELSE Player_Name END AS player_name,
         CASE WHEN incident_id % 2 = 0 THEN lower(Team) ELSE Team END AS team_code,
         Injury_Type AS injury, Notes AS notes,
         CASE incident_id % 3 WHEN 0 THEN strftime(Date, '%Y-%m-%d')
                              WHEN 1 THEN strftime(Date, '%m/%d/%Y')
                              ELSE strftime(Date, '%d/%m/%Y') END AS date,
         CAST(year(Date) AS VARCHAR) || '.0' AS year
  FROM inc)"""

ACTIVITY_SQL = f"""act AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS gameId,
         substr(c.c_mktsegment, 1, 1) || '. ' || c.c_name AS playerNameI,
         c.c_name AS playerName,
         substr(c.c_mktsegment, 1, 1) || '. ' || c.c_name AS playerNameFormatted,
         CAST(c.c_nationkey AS VARCHAR) AS teamId,
         substr(c.c_mktsegment, 1, 3) AS teamTricode,
         CAST(l.l_linenumber AS VARCHAR) AS period,
         CAST(l.l_partkey % 12 AS VARCHAR) || ':00' AS clock,
         {sql_pick(PLAY_ACTION_TYPES, 'l.l_orderkey * 7 + l.l_linenumber')} AS actionType,
         {sql_pick(PLAY_SUB_TYPES, 'l.l_orderkey * 7 + l.l_linenumber')} AS subType,
         {sql_pick(PLAY_DESCRIPTIONS, 'l.l_orderkey * 7 + l.l_linenumber')} AS description,
         l.l_returnflag AS shotResult,
         CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) AS pointsTotal,
         CAST(l.l_shipdate AS DATE) AS gameDate
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  JOIN customer c ON o.o_custkey = c.c_custkey)"""

GAME_DATES_SQL = """games AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS GAMEID, strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS gameDate
  FROM lineitem)"""
