"""Hash-keyed star schema over classified incidents.

Every dimension key is a pure function of the fact row (SHA-256 of the
member text, or the YYYYMMDD day key), so the fact computes its keys in-row
instead of joining back to four dimensions: the same keys, no join shuffles
(the tests compare them with a join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import date_key
from ..functions.keys import hash_key, sha256_hex
from ..functions.rules import CATEGORY, REGION_ETL, SEVERITY_ETL, classify
from ..functions.text import text_of
from .onepass import members, members_of

# Defaults of the injury dimension attributes.
INJURY_DEFAULTS = {"injury_category": "OTHER", "injury_region": "OTHER", "injury_severity": "UNKNOWN"}

# Columns of the fact table, in order.
FACT_COLUMNS = ("fact_injury_key", "player_key", "team_key", "injury_key", "date_key",
                "Player_Name", "Team", "injury_category", "injury_region", "injury_severity",
                "Injury_Type", "Notes")


def classify_incidents(df: DataFrame) -> DataFrame:
    """Add injury_region, injury_severity, injury_category from lower(Injury_Type + ' ' + Notes).

    The text is projected once as its own column so the rule chains share it.
    """
    out = df.withColumn("_text", text_of("Injury_Type", "Notes"))
    out = out.select("*",
                     classify("_text", REGION_ETL).alias("injury_region"),
                     classify("_text", SEVERITY_ETL).alias("injury_severity"),
                     classify("_text", CATEGORY).alias("injury_category"))
    return out.drop("_text")


def player_key(name: str | Column = "Player_Name") -> Column:
    return sha256_hex(F.upper(F.col(name) if isinstance(name, str) else name))


def team_key(team: str | Column = "Team") -> Column:
    return sha256_hex(team)


def injury_key() -> Column:
    return hash_key("injury_category", "injury_region", "injury_severity")


def star_input(df: DataFrame, year: int = 2018) -> DataFrame:
    """Rows of the given year (by the Year column) that have a date."""
    return df.filter((F.col("Year") == F.lit(str(year))) & F.col("Date").isNotNull())


def dim_player(df: DataFrame) -> DataFrame:
    """Distinct names (case-sensitive members) with key sha256(upper(name))."""
    return df.select("Player_Name").dropDuplicates().select(player_key().alias("player_key"), "Player_Name")


def dim_team(df: DataFrame) -> DataFrame:
    return df.select("Team").dropDuplicates().select(team_key().alias("team_key"), "Team")


def dim_injury(df: DataFrame) -> DataFrame:
    d = (df.select(*INJURY_DEFAULTS).na.fill(INJURY_DEFAULTS).dropDuplicates())
    return d.select(injury_key().alias("injury_key"), *INJURY_DEFAULTS)


def dim_date(df: DataFrame, col: str = "Date") -> DataFrame:
    d = df.select(col).dropDuplicates()
    return d.select(date_key(col).alias("date_key"), F.col(col).alias("Date"),
                    F.year(col).cast("int").alias("year"), F.month(col).cast("int").alias("month"),
                    F.dayofweek(col).cast("int").alias("day_of_week"))


def _fact_key() -> Column:
    return hash_key("player_key", "team_key", "injury_key", F.col("date_key").cast("string"),
                    F.coalesce(F.col("Notes"), F.lit("")))


def fact_injury(df: DataFrame) -> DataFrame:
    """Fact rows (not deduplicated) with keys computed in-row."""
    keyed = df.select("*", player_key().alias("player_key"), team_key().alias("team_key"),
                      injury_key().alias("injury_key"), date_key("Date").alias("date_key"))
    return keyed.select(_fact_key().alias("fact_injury_key"), *FACT_COLUMNS[1:])


# Columns and types of the members of each dimension.
DIM_MEMBERS = {"dim_player": {"Player_Name": "string"}, "dim_team": {"Team": "string"},
               "dim_injury": dict.fromkeys(INJURY_DEFAULTS, "string"), "dim_date": {"Date": "date"}}


def star_members(classified: DataFrame, year: int = 2018) -> DataFrame:
    """The distinct members of all four dimensions, from one pass over the year's rows (``onepass.members``)."""
    return members(star_input(classified, year), {t: list(cols) for t, cols in DIM_MEMBERS.items()})


def build_star(classified: DataFrame, year: int = 2018, found: DataFrame | None = None) -> dict[str, DataFrame]:
    """The five star-schema tables for one year; the fact carries a literal Year. ``found``: the kept result
    of ``star_members``, which the dimensions are then made from; without it each reads ``classified``."""
    df = star_input(classified, year)
    of = lambda t: df if found is None else members_of(found, t, DIM_MEMBERS[t])
    return {
        "dim_player": dim_player(of("dim_player")),
        "dim_team": dim_team(of("dim_team")),
        "dim_injury": dim_injury(of("dim_injury")),
        "dim_date": dim_date(of("dim_date")),
        "fact_injury": fact_injury(df).withColumn("Year", F.lit(year).cast("int")),
    }
