import json
import os

import pytest
from pyspark.sql import functions as F

from sideline.plans import jobs
from sideline.plans import sample_views as sv
from sideline.sources.readers import (read_clean_or_raw, read_csv, read_items, require_columns,
                                      require_path)
from sideline.sources.sinks import StarPaths, write_csv, write_parquet
from conftest import SF_SMALL


def test_csv_roundtrip_text(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    write_csv(df, f"{tmp_dir}/c")
    back = read_csv(spark, f"{tmp_dir}/c")
    assert dict(back.dtypes) == {"k": "string", "v": "string"}
    assert sorted((r.k, r.v) for r in back.collect() if r.v) == [("1", "a")]


def test_partitioned_parquet_null_and_pruning(spark, tmp_dir):
    df = spark.createDataFrame([("A", 2018, 1), (None, 2018, 2), ("B", 2018, 3)], "Team string, Year int, v int")
    path = f"{tmp_dir}/fact"
    write_parquet(df, path, partitions=["Team", "Year"])
    assert any("__HIVE_DEFAULT_PARTITION__" in d for d in os.listdir(path))
    back = spark.read.parquet(path)
    assert back.filter(F.col("Team").isNull()).first().v == 2
    plan = back.filter(F.col("Team") == "A")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Team" in plan


def test_read_items_typed_and_plain(spark, tmp_dir):
    typed = [{"Item": {"player_name": {"S": "A b"}, "score": {"N": "1.5"}}},
             {"Item": {"player_name": {"S": "C d"}, "Notes": {"S": "x"}}}]
    os.makedirs(f"{tmp_dir}/t")
    with open(f"{tmp_dir}/t/part.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in typed))
    df = read_items(spark, f"{tmp_dir}/t")
    assert dict(df.dtypes) == {"Notes": "string", "player_name": "string", "score": "double"}
    assert sorted((r.player_name, r.score, r.Notes) for r in df.collect()) == [("A b", 1.5, None), ("C d", None, "x")]
    os.makedirs(f"{tmp_dir}/p")
    with open(f"{tmp_dir}/p/part.json", "w") as f:
        f.write('{"a": 1, "b": "x"}\n{"a": 2}\n')
    assert read_items(spark, f"{tmp_dir}/p").count() == 2


def test_contracts(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        require_path(spark, f"{tmp_dir}/missing.csv")
    with pytest.raises(KeyError, match="playerName"):
        require_columns(spark.createDataFrame([(1,)], "x int"), ["playerName"])


def test_read_clean_or_raw(spark, tmp_dir):
    raw = spark.createDataFrame([("2018-01-02", "lal", None, "a b", "torn acl")],
                                "Date string, Team string, Acquired string, Relinquished string, Notes string")
    write_csv(raw, f"{tmp_dir}/raw")
    got = read_clean_or_raw(spark, f"{tmp_dir}/clean", f"{tmp_dir}/raw").first()
    assert (got.Player_Name, got.Team, got.Injury_Type, got.Year) == ("A B", "Lal", "Torn", 2018)
    write_csv(jobs.clean_incidents(raw), f"{tmp_dir}/clean")
    assert read_clean_or_raw(spark, f"{tmp_dir}/clean", f"{tmp_dir}/none").count() == 1


def test_clean_incidents_null_text(spark):
    raw = spark.createDataFrame([("2018-01-02", "lal", "x y", None, "rest"), ("2018-01-02", "lal", None, "p q", "rest")],
                                "Date string, Team string, Acquired string, Relinquished string, Notes string")
    assert jobs.clean_incidents(raw).count() == 1
    kept = jobs.clean_incidents(raw, null_text="nan").collect()
    assert sorted(r.Player_Name for r in kept) == ["Nan", "P Q"]


def test_star_job_writes_five_tables(spark, tmp_dir):
    src = f"{tmp_dir}/raw"
    write_csv(sv.ragged_incidents(spark, SF_SMALL), src)
    paths = jobs.star_job(spark, src, f"{tmp_dir}/out/", year=1998)
    counts = {t: spark.read.parquet(paths[t]).count() for t in
              ("dim_player", "dim_team", "dim_injury", "dim_date", "fact_injury")}
    expected = jobs.star_tables(sv.ragged_incidents(spark, SF_SMALL), 1998)
    assert counts == {t: df.count() for t, df in expected.items()}
    assert paths.base == StarPaths(f"{tmp_dir}/out").base


def test_analysis_ready_preserves_rows_with_duplicate_game_dates(spark):
    inc = sv.item_incidents(spark, SF_SMALL)
    act = sv.activity(spark, SF_SMALL)
    games = sv.game_dates(spark, SF_SMALL)
    season = ("1995-01-01", "2001-12-31")
    _, final = jobs.analysis_ready(inc, act, games, *season)
    kept = jobs.restrict_to(act.select(*jobs.ACTIVITY_COLUMNS), "playerNameI",
                            jobs.windowed_incidents(inc, *season), "playerNameFormatted")
    assert final.count() == kept.count()
    _, multiplied = jobs.analysis_ready(inc, act, games, *season, dedup_games=False)
    assert multiplied.count() > final.count()


def test_yearly_report_keys_and_empty_year(spark):
    clean = jobs.clean_incidents(sv.raw_incidents(spark, SF_SMALL))
    rep = jobs.yearly_report(clean, sv.activity(spark, SF_SMALL), 1998)
    assert set(rep) >= {"severity", "top_regions", "severe_by_region", "severe_by_month", "severe_by_team",
                        "league", "severe_group", "league_vs_group"}
    assert rep["top_regions"].count() <= 10
    empty = jobs.yearly_report(clean, sv.activity(spark, SF_SMALL), 1900)
    assert empty["severe_by_month"].count() == 0 and empty["severe_group"].count() == 0
    assert empty["league_vs_group"].filter("Severe_Group <> 0").count() == 0


def test_pre_incident_profile_shares(spark):
    inc = sv.incidents(spark, SF_SMALL).select(jobs.initial_last("Player_Name").alias("playerNameFormatted"),
                                               F.col("Date").alias("injuryDate"), "Injury_Type", "Notes")
    act = sv.activity(spark, SF_SMALL)
    prof = jobs.pre_incident_profile(inc, act).collect()
    pairs = jobs.pre_incident_events(inc, act)
    assert sum(r.n for r in prof) == pairs.count() > 0
    assert abs(sum(r.share for r in prof) - 1) < 1e-9
    cmp = jobs.season_vs_window(inc, act).collect()
    assert all(abs(r.delta - (r.Week_Before_Injury - r.Season)) < 1e-12 for r in cmp)


def test_window_analysis_and_report_jobs(spark, tmp_dir):
    inc = sv.item_incidents(spark, SF_SMALL)
    act = sv.activity(spark, SF_SMALL)
    season = ("1995-01-01", "2001-12-31")
    winc, final = jobs.analysis_ready(inc, act, sv.game_dates(spark, SF_SMALL), *season)
    write_parquet(winc, f"{tmp_dir}/ar/injuries_windowed")
    write_parquet(final, f"{tmp_dir}/ar/analysis_ready")
    jobs.window_analysis_job(spark, f"{tmp_dir}/ar/injuries_windowed", f"{tmp_dir}/ar/analysis_ready",
                             f"{tmp_dir}/wa")
    prof = spark.read.parquet(f"{tmp_dir}/wa/pre_incident_profile")
    assert prof.count() > 0 and abs(sum(r.share for r in prof.collect()) - 1) < 1e-9
    write_csv(sv.raw_incidents(spark, SF_SMALL), f"{tmp_dir}/raw")
    write_csv(act, f"{tmp_dir}/act")
    paths = jobs.report_job(spark, f"{tmp_dir}/clean-missing", f"{tmp_dir}/raw", f"{tmp_dir}/act",
                            f"{tmp_dir}/rep", 1998)
    assert spark.read.parquet(paths["league_vs_group"]).count() > 0


def test_staged_table_removed_after_block(spark):
    from sideline.session import staged
    df = spark.range(10)
    with staged(df, "t") as s:
        path = s.inputFiles()[0].rsplit("/", 1)[0]
        assert s.count() == 10
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    assert not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def test_clean_then_summary_jobs(spark, tmp_dir):
    write_csv(sv.raw_incidents(spark, SF_SMALL), f"{tmp_dir}/raw")
    jobs.clean_job(spark, f"{tmp_dir}/raw", f"{tmp_dir}/clean")
    paths = jobs.clean_summary_job(spark, f"{tmp_dir}/clean", f"{tmp_dir}/summary")
    counts = spark.read.parquet(paths["counts"]).first()
    assert counts.rows == jobs.clean_incidents(sv.raw_incidents(spark, SF_SMALL)).count()
    assert spark.read.parquet(paths["top_players"]).count() == 10


def test_analysis_ready_job_from_item_exports(spark, tmp_dir):
    season = ("1995-01-01", "2001-12-31")
    inc = sv.item_incidents(spark, SF_SMALL)
    act = sv.activity(spark, SF_SMALL).select(*jobs.ACTIVITY_COLUMNS)
    games = sv.game_dates(spark, SF_SMALL)
    for name, df in (("inc", inc), ("act", act), ("games", games)):
        item = F.struct(*[F.struct(F.col(c).alias("S")).alias(c) for c in df.columns]).alias("Item")
        df.select(item).write.json(f"{tmp_dir}/{name}")
    jobs.analysis_ready_job(spark, f"{tmp_dir}/inc", f"{tmp_dir}/act", f"{tmp_dir}/games", f"{tmp_dir}/out",
                            source="items", start=season[0], end=season[1])
    _, want = jobs.analysis_ready(inc, act, games, *season)
    got = spark.read.parquet(f"{tmp_dir}/out/analysis_ready")
    assert got.select(want.columns).exceptAll(want).count() == 0 and got.count() == want.count()


def test_clean_keeps_existing_injury_type(spark):
    raw = spark.createDataFrame([("2018-01-02", "lal", "a b", "torn acl", "Given")],
                                "Date string, Team string, Relinquished string, Notes string, Injury_Type string")
    assert jobs.clean_incidents(raw).first().Injury_Type == "Given"


def test_command_line_star_and_clean(spark, tmp_dir):
    from sideline.__main__ import main
    write_csv(sv.ragged_incidents(spark, SF_SMALL), f"{tmp_dir}/raw")
    main(["star", "--raw-injuries", f"{tmp_dir}/raw", "--clean-prefix", f"{tmp_dir}/star/", "--year", "1998"])
    assert spark.read.parquet(f"{tmp_dir}/star/fact_injury").count() == \
        jobs.star_tables(sv.ragged_incidents(spark, SF_SMALL), 1998)["fact_injury"].count()
    write_csv(sv.raw_incidents(spark, SF_SMALL), f"{tmp_dir}/raw2")
    main(["clean", "--raw", f"{tmp_dir}/raw2", "--out", f"{tmp_dir}/clean"])
    main(["summary", "--clean", f"{tmp_dir}/clean", "--out-prefix", f"{tmp_dir}/summary", "--single-line"])
    assert spark.read.parquet(f"{tmp_dir}/summary/top_teams").count() == 10


def test_year_filter_reaches_the_rows_before_keep_first(spark):
    raw = spark.createDataFrame([("2018-01-02", "lal", "a b", "torn acl", "1990"), ("2018-01-02", "abc", "a b", "z", "1991"), ("n/a", "lal", "a b", "x", None),
                                 ("2017-01-02", "lal", "a b", "x", "2018")], "Date string, Team string, Relinquished string, Notes string, Year string")
    for order in (None, ["Year", "Notes"]):
        got = sorted((r.Player_Name, r.Team, r.Year) for r in jobs.clean_incidents(raw, order_by=order).collect() if r.Year)
        assert got == sorted([("A B", "Abc" if order is None else "Lal", 2018), ("A B", "Lal", 2017)])
    year = jobs.clean_incidents(raw.drop("Year")).filter("Year = 2018")
    plan = year._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("2018")  # the filter stands below the aggregate
