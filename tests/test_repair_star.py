import datetime as dt

import pytest
from pyspark.sql import functions as F

from sideline.operators.repair import (apply_aliases, ensure_columns, normalize_incidents, table_profile,
                                       trim_all)
from sideline.operators.joins import lookup
from sideline.operators.star import (build_star, classify_incidents, dim_player, fact_injury, star_input)
from sideline.plans import sample_views as sv
from conftest import SF_SMALL


def test_aliases_first_wins(spark):
    df = spark.createDataFrame([("a", "b")], "player_name string, player string")
    out = apply_aliases(df)
    assert out.columns == ["Player_Name", "player"]
    assert out.first().Player_Name == "a"


def test_ambiguous_case_raises(spark):
    df = spark.createDataFrame([("a", "b")], "date string, Notes string").withColumnRenamed("Notes", "DATE")
    with pytest.raises(ValueError):
        apply_aliases(df)


def test_ensure_and_trim(spark):
    df = spark.createDataFrame([("  x ", 2018.0)], "Team string, Year double")
    out = ensure_columns(trim_all(df), ["Team", "Notes"])
    r = out.first()
    assert (r.Team, r.Year, r.Notes) == ("x", "2018.0", None)
    assert dict(out.dtypes)["Notes"] == "string"


def test_normalize_incidents(spark):
    df = spark.createDataFrame([(" A  b ", "lal", "13/10/2018", "2018.0", "torn acl")],
                               "player string, team_code string, date string, year string, notes string")
    r = normalize_incidents(df).first()
    assert (r.Player_Name, r.Team, r.Date, r.Year, r.Injury_Type, r.Notes) == \
        ("A b", "LAL", dt.date(2018, 10, 13), "2018", None, "torn acl")


def test_table_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    got = [tuple(r) for r in table_profile(df).orderBy("position").collect()]
    assert got == [(1, "a", "int", 2, 2), (2, "b", "string", 2, 1)]


def incidents_fixture(spark):
    rows = [("A b", "T1", "2018-03-01", "torn acl"), ("a B", "T1", "2018-03-02", None),
            (None, "T2", "2018-03-03", "sprain"), ("C d", None, "2018-03-03", "rest"),
            ("C d", None, "2018-03-03", "rest"), ("E f", "T3", "2017-01-01", "x"), ("G h", "T3", "junk", "x")]
    return spark.createDataFrame(rows, "Player_Name string, Team string, Date string, Notes string")


def test_dim_player_members_and_keys(spark):
    df = star_input(classify_incidents(normalize_incidents(incidents_fixture(spark))), 2018)
    dp = dim_player(df).collect()
    names = sorted((r.Player_Name or "") for r in dp)
    assert names == ["", "A b", "C d", "a B"]
    keys = {r.Player_Name: r.player_key for r in dp}
    assert keys["A b"] == keys["a B"] and keys[None] is None


def test_fact_in_row_keys_equal_join_keys(spark):
    for df in (star_input(classify_incidents(normalize_incidents(incidents_fixture(spark))), 2018),
               star_input(classify_incidents(normalize_incidents(sv.ragged_incidents(spark, SF_SMALL))), 1998)):
        fact = fact_injury(df)
        t = build_star(df, 2018 if df.filter("Year = '2018'").count() else 1998)
        attributes = ["injury_category", "injury_region", "injury_severity"]
        # each key, looked up in its dimension (three attributes for injuries), equals the key computed in the row
        for dim, on, key in (("dim_player", ["Player_Name"], "player_key"), ("dim_team", ["Team"], "team_key"),
                             ("dim_injury", attributes, "injury_key")):
            member = t[dim].select(*on, F.col(key).alias("looked_up"))
            rows = lookup(fact, member, on)
            assert rows.count() == fact.count() > 0
            known = rows.dropna(subset=on)
            assert known.filter(f"looked_up <=> {key}").count() == known.count()


def test_fact_keeps_duplicates_and_year(spark):
    t = build_star(classify_incidents(normalize_incidents(incidents_fixture(spark))), 2018)
    fact = t["fact_injury"]
    assert fact.count() == 5
    assert fact.filter(F.col("Year") != 2018).count() == 0
    dd = t["dim_date"].collect()
    assert {r.date_key for r in dd} == {20180301, 20180302, 20180303}
