"""Several tables from one pass: equal to the tables made one by one."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from sideline.operators.onepass import counts_of, frequencies, members, members_of
from sideline.operators.star import build_star, classify_incidents, star_members
from sideline.operators.stats import count_summary, freq, ordered_freq
from sideline.operators.repair import normalize_incidents
from sideline.plans import jobs
from sideline.plans import sample_views as sv
from sideline.session import staged
from sideline.sources.sinks import write_csv, write_parquet
from conftest import SF_SMALL


def rows(df):
    return [tuple(r) for r in df.collect()]


def reads(df, column):
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return len(re.findall(rf"FileScan \w+ \[[^\]]*{column}", final))


def test_frequencies_with_nulls_types_and_a_hot_value(spark):
    data = [("hot", i % 2, 0.0 if i % 2 else -0.0, None) for i in range(2000)] + [
        (None, None, float("nan"), dt.date(2018, 1, 1)), ("", 7, None, dt.date(2018, 1, 1)), ("x", 7, float("nan"), None)]
    df = spark.createDataFrame(data, "s string, i int, d double, t date").repartition(5)
    got = frequencies(df, {c: (c, None) for c in df.columns} | {"odd": ("s", F.col("i") == 1)})
    for c, kind in df.dtypes:
        one = ordered_freq(counts_of(got, c, c, kind), c, dropna=False)
        assert str(rows(one)) == str(rows(freq(df, c, dropna=False)))
        assert one.dtypes == freq(df, c).dtypes
    assert rows(counts_of(got, "odd", "s")) == [("hot", 1000)]
    want = df.agg(F.count(F.lit(1)), *[F.countDistinct(c) for c in df.columns])
    summary = count_summary(df, df.columns)
    assert rows(summary) == rows(want) and summary.columns == ["rows", *[f"unique_{c}" for c in df.columns]]
    assert rows(count_summary(df.limit(0), ["s"])) == [(0, 0)]
    assert rows(count_summary(df, [])) == [(2003,)]


def test_distinct_counts_without_expand(spark):
    df = spark.createDataFrame([("a", "b", [1]), ("a", None, [1])], "s string, t string, l array<int>")
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan(count_summary(df, ["s", "t"])) and rows(count_summary(df, ["s", "t"])) == [(2, 1, 1)]
    assert rows(count_summary(df, ["s", "l"])) == [(2, 1, 1)]  # other types: Spark's own


def test_members(spark):
    df = spark.createDataFrame([("a", 1, dt.date(2018, 1, 1)), ("a", 1, None), (None, 2, None)], "s string, i int, d date")
    got = members(df, {"one": ["s"], "two": ["i", "d"]})
    assert sorted(rows(members_of(got, "one", {"s": "string"})), key=str) == [("a",), (None,)]
    two = members_of(got, "two", {"i": "int", "d": "date"})
    assert two.dtypes == [("i", "int"), ("d", "date")]
    assert sorted(rows(two), key=str) == sorted([(1, dt.date(2018, 1, 1)), (1, None), (2, None)], key=str)


def test_clean_summary_from_one_pass(spark, tmp_dir):
    write_parquet(jobs.clean_incidents(sv.raw_incidents(spark, SF_SMALL)), f"{tmp_dir}/clean")
    clean = spark.read.parquet(f"{tmp_dir}/clean")
    assert reads(jobs.summary_frequencies(clean), "Injury_Type") == 1
    with staged(jobs.summary_frequencies(clean), "t") as counts:
        got, want = jobs.clean_summary(clean, 10, counts), jobs.clean_summary(clean, 10)
        assert set(got) == set(want)
        for name in want:
            assert got[name].dtypes == want[name].dtypes and rows(got[name]) == rows(want[name])
            assert name == "preview" or reads(got[name], "Notes") == 0


def test_report_from_one_pass(spark, tmp_dir):
    write_parquet(jobs.clean_incidents(sv.raw_incidents(spark, SF_SMALL)), f"{tmp_dir}/clean")
    clean, act = spark.read.parquet(f"{tmp_dir}/clean"), sv.activity(spark, SF_SMALL)
    assert reads(jobs.report_frequencies(clean, 1998), "Notes") == 1
    for inc in (clean, clean.drop("Team"), clean.withColumn("Player_Name", F.lit(None).cast("string"))):
        with staged(jobs.report_frequencies(inc, 1998), "t") as counts:
            got, want = jobs.yearly_report(inc, act, 1998, counts=counts), jobs.yearly_report(inc, act, 1998)
            assert list(got) == list(want)
            for name in want:
                assert got[name].dtypes == want[name].dtypes and rows(got[name]) == rows(want[name]), name
                assert reads(got[name], "Notes") == 0  # the counts alone


def test_star_from_one_pass(spark, tmp_dir):
    write_parquet(classify_incidents(normalize_incidents(sv.ragged_incidents(spark, SF_SMALL))), f"{tmp_dir}/in")
    df = spark.read.parquet(f"{tmp_dir}/in")
    assert reads(star_members(df, 1998), "Player_Name") == 1
    with staged(star_members(df, 1998), "t") as found:
        got, want = build_star(df, 1998, found), build_star(df, 1998)
        for name in want:
            assert got[name].dtypes == want[name].dtypes
            assert sorted(rows(got[name]), key=str) == sorted(rows(want[name]), key=str)
            assert reads(got[name], "Notes") == (1 if name == "fact_injury" else 0)


@pytest.mark.parametrize("multi_line", [True, False])
def test_jobs_without_line_breaks_split_files(spark, tmp_dir, multi_line):
    write_csv(sv.raw_incidents(spark, SF_SMALL), f"{tmp_dir}/raw")
    jobs.clean_job(spark, f"{tmp_dir}/raw", f"{tmp_dir}/clean", multi_line=multi_line)
    paths = jobs.clean_summary_job(spark, f"{tmp_dir}/clean", f"{tmp_dir}/summary", multi_line=multi_line)
    want = jobs.clean_incidents(sv.raw_incidents(spark, SF_SMALL)).count()
    assert spark.read.parquet(paths["counts"]).first().rows == want
