"""Free text through files, item attributes, rebalanced writes, label coverage and scan counts."""

import datetime as dt
import json
import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from sideline.functions import rules
from sideline.operators.stats import closed_label_mixes, closed_label_shares
from sideline.plans import jobs
from sideline.plans import sample_views as sv
from sideline.sources.readers import read_csv, read_items
from sideline.sources.sinks import write_csv, write_parquet
from conftest import SF_SMALL

NOTES = ['torn "acl", out', "line one\nline two", "  padded  ", 'quote " alone', "plain", "comma, only", None, '"', "\\\"x\\"]


def test_notes_survive_our_own_csv(spark, tmp_dir):
    df = spark.createDataFrame([(i, n, "end") for i, n in enumerate(NOTES)], "i int, Notes string, last string")
    write_csv(df, f"{tmp_dir}/c")
    back = read_csv(spark, f"{tmp_dir}/c", multi_line=True)
    assert sorted((int(r.i), r.Notes, r["last"]) for r in back.collect()) == [(i, n, "end") for i, n in enumerate(NOTES)]


def test_notes_survive_a_file_that_pandas_wrote(spark, tmp_dir):
    import pandas as pd
    raw = pd.DataFrame({"Date": ["2018-01-02"] * len(NOTES), "Team": "T", "Relinquished": [f"P {i}" for i in range(len(NOTES))],
                        "Notes": NOTES})
    raw.to_csv(f"{tmp_dir}/raw.csv", index=False)
    jobs.clean_job(spark, f"{tmp_dir}/raw.csv", f"{tmp_dir}/clean")
    got = read_csv(spark, f"{tmp_dir}/clean", multi_line=True).collect()
    assert len(got) == len(NOTES)
    assert {r.Player_Name: r.Notes for r in got} == {f"P {i}": None if n is None else n.strip().title() for i, n in enumerate(NOTES)}


def test_item_attributes_of_every_type(spark, tmp_dir):
    items = [{"n": {"N": "0.000000000012345"}, "t": {"S": "a"}, "l": {"L": [{"S": "x"}, {"N": "1"}]}, "ss": {"SS": ["p", "q"]},
              "m": {"M": {"k": {"S": "v"}}}, "b": {"B": "AAE="}, "mix": {"S": "word"}, "nul": {"NULL": True}, "ok": {"BOOL": True}},
             {"n": {"N": "1E30"}, "mix": {"N": "2.5"}}, {"n": {"N": "0.1234567890123456"}}, {"n": {"N": "-7"}}]
    with open(f"{tmp_dir}/items.json", "w") as f:
        f.write("\n".join(json.dumps({"Item": i}) for i in items))
    rows = read_items(spark, f"{tmp_dir}/items.json").collect()
    assert [r.n for r in rows] == [1.2345e-11, 1e30, 0.1234567890123456, -7.0]
    r = rows[0]
    assert (r.t, r.ss, r.b, r.mix, r.nul, r.ok) == ("a", '["p","q"]', "AAE=", "word", None, True)
    assert json.loads(r.l) == [{"S": "x"}, {"N": "1"}] and json.loads(r.m) == {"k": {"S": "v"}}
    assert rows[1].mix == "2.5"


def test_five_incidents_of_a_player_stay_five(spark):
    days = [dt.date(2018, 1, d) for d in range(1, 6)]
    for texts in ([d.strftime("%m/%d/%Y") for d in days], [dt.datetime(2018, 1, d, 9) for d in range(1, 6)], days,
                  [d.isoformat() + "T09:00:00" for d in days]):
        raw = spark.createDataFrame([(t, "lal", "a b", "sore") for t in texts], ["Date", "Team", "Relinquished", "Notes"])
        assert sorted(r.Date for r in jobs.clean_incidents(raw).collect()) == days


def test_hot_folder_is_split_by_aqe(spark, tmp_dir):
    rows = spark.range(60000).select(F.when(F.col("id") % 3 < 2, "HOT").otherwise(F.concat(F.lit("t"), F.col("id") % 9)).alias("Team"),
                                     F.sha2(F.col("id").cast("string"), 256).alias("text"))
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        write_parquet(rows, f"{tmp_dir}/out", partitions=["Team"])
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    files = {d: sum(f.endswith(".parquet") for f in os.listdir(f"{tmp_dir}/out/{d}")) for d in os.listdir(f"{tmp_dir}/out") if "=" in d}
    assert files["Team=HOT"] >= 4 and all(n <= 2 for d, n in files.items() if d != "Team=HOT")
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 60000


def test_a_shared_folder_is_asked_for(monkeypatch):
    from types import SimpleNamespace

    from sideline.session import ensure_checkpoint_dir
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d)))


LABEL_QUERIES = {"severity_etl": "SEVERITY_ETL", "severity_text": "SEVERITY", "severity_notes": "SEVERITY",
                 "region_etl": "REGION_ETL", "region_report": "REGION_REPORT", "category": "CATEGORY",
                 "injury_type": "INJURY_TYPE", "play_type_window": "PLAY_TYPE_WINDOW", "play_type_report": "PLAY_TYPE_REPORT"}


@pytest.mark.parametrize("name", sorted(LABEL_QUERIES))
def test_every_label_occurs(spark, name):
    seen = {r.label for r in E.queries()[name](spark, SF_SMALL).select("label").distinct().collect()}
    assert seen == set(getattr(rules, LABEL_QUERIES[name]).labels)


def scans(df, table):
    """Reads of a table in the plan that ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return len(re.findall(rf"FileScan \w+ \[[^\]]*{table}", final))


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_activity_is_read_once(spark, tmp_dir, threshold):
    inc = sv.incidents(spark, SF_SMALL).select(F.col("Player_Name"), "Team", "Date", F.year("Date").alias("Year"), "Injury_Type", "Notes")
    sev = inc.select(jobs.initial_last("Player_Name").alias("playerNameFormatted"), F.col("Date").alias("injuryDate"), "Injury_Type", "Notes")
    sv.activity(spark, SF_SMALL).select(*[F.col(c).alias(f"{c}") for c in sv.activity(spark, SF_SMALL).columns]).write.parquet(f"{tmp_dir}/act")
    act = spark.read.parquet(f"{tmp_dir}/act")
    keys = {"spark.sql.autoBroadcastJoinThreshold": threshold}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        assert scans(jobs.season_mixes(sev, act), "description") == 1
        assert scans(jobs.report_mixes(inc, act, sv.SAMPLE_YEAR), "description") == 1
        assert scans(jobs.season_vs_window(sev, act), "description") == 1
        generic = jobs.window_vs_overall(sev.select("playerNameFormatted", "injuryDate"),
                                         act.select("playerNameFormatted", "gameDate", "actionType"),
                                         "playerNameFormatted", "injuryDate", "gameDate", "actionType")
        assert scans(generic, "actionType") <= 1 + generic._jdf.queryExecution().executedPlan().toString().count("Subquery subquery")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_stray_labels_are_errors(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    for out in (closed_label_shares(df, "c", ["a"]), closed_label_mixes(df, "c", ["a"], {"w": F.lit(1)})):
        with pytest.raises(Exception, match="outside the closed set: z"):
            out.collect()
    ok = closed_label_mixes(df, "c", ["a", "z", "q"], {"w": F.lit(1), "none": F.lit(None).cast("long")}).collect()
    assert {r.c: (r.n_w, r.share_w, r.n_none, r.share_none) for r in ok} == {
        "a": (1, .5, 0, 0.0), "z": (1, .5, 0, 0.0), "q": (0, 0.0, 0, 0.0)}


def test_title_case_is_worked_out_once(spark):
    plan = jobs.clean_incidents(sv.raw_incidents(spark, SF_SMALL))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 3  # name, team and notes


def test_absent_text_columns_and_dates(spark):
    inc = spark.createDataFrame([("A B", dt.date(2018, 12, 9), "torn acl")], "Player_Name string, Date date, Notes string")
    act = spark.createDataFrame([("A. B", "B", "2018-12-05"), ("A. B", "B", "n/a")], "playerNameFormatted string, playerName string, gameDate string")
    sev = inc.select(jobs.initial_last("Player_Name").alias("playerNameFormatted"), F.col("Date").alias("injuryDate"), "Notes")
    assert [(r.play_type, r.n) for r in jobs.pre_incident_profile(sev, act).collect()] == [("OTHER", 1)]
    rep = jobs.yearly_report(inc.withColumn("Year", F.lit("2018")), act, 2018)
    assert [(r.play_type, r.n) for r in rep["severe_group"].collect()] == [("OTHER", 2)]
