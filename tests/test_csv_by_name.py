"""CSV files whose headers differ: columns are matched by name."""

import gzip

import pytest
from pyspark.sql import types as T

from sideline.sources.readers import _header_groups, _widened, read_csv, require_path


def put(folder, **files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in files.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def rows(df):
    return sorted((r.asDict() for r in df.collect()), key=str)


def test_reordered_extra_and_missing_columns(spark, tmp_path):
    src = put(tmp_path / "in", a="Player_Name,Team,Date,Notes\nAl Bo,T1,2018-01-02,x\n",
              b="Date,Notes,Team,Player_Name,Extra\n2018-01-03,y,T2,Cy Do,e\n", c="Team,Player_Name\nT3,Ed Fo\n")
    want = [{"Player_Name": "Al Bo", "Team": "T1", "Date": "2018-01-02", "Notes": "x", "Extra": None},
            {"Player_Name": "Cy Do", "Team": "T2", "Date": "2018-01-03", "Notes": "y", "Extra": "e"},
            {"Player_Name": "Ed Fo", "Team": "T3", "Date": None, "Notes": None, "Extra": None}]
    for path in (src, src + "/*.csv", [f"{src}/{n}.csv" for n in "abc"]):
        df = read_csv(spark, path)
        assert rows(df) == sorted(want, key=str)
        assert df.columns == ["Player_Name", "Team", "Date", "Notes", "Extra"]


def test_schema_is_matched_by_name(spark, tmp_path):
    src = put(tmp_path / "in", a="b,a\n1.5,1\n", b="a,x,b\n2,skip,2.5\n", c="a\n3\n")
    df = read_csv(spark, src, schema="a BIGINT, b DOUBLE")
    assert df.dtypes == [("a", "bigint"), ("b", "double")]
    assert rows(df) == [{"a": 1, "b": 1.5}, {"a": 2, "b": 2.5}, {"a": 3, "b": None}]
    one = read_csv(spark, f"{src}/a.csv", schema="a BIGINT, b DOUBLE")  # a single file, too
    assert rows(one) == [{"a": 1, "b": 1.5}]
    with pytest.raises(KeyError, match="'b' not found in .*c.csv"):
        read_csv(spark, src, required=["a", "b"])


def test_types_inferred_over_all_files(spark, tmp_path):
    src = put(tmp_path / "in", a="k,v,w,when\n1,1,007,2018-01-02\n", b="when,w,v,k\n2018-01-03,agent,2.5,3000000000\n")
    df = read_csv(spark, src, infer=True)
    assert df.dtypes == [("k", "bigint"), ("v", "double"), ("w", "string"), ("when", "date")]
    assert [(r.k, r.v, r.w) for r in df.orderBy("k").collect()] == [(1, 1.0, "007"), (3000000000, 2.5, "agent")]
    alone = read_csv(spark, f"{src}/b.csv", infer=True)
    assert dict(alone.dtypes)["k"] == "bigint"


def test_widened_types():
    one = lambda kind: T.StructType([T.StructField("c", kind)])
    assert _widened([one(T.IntegerType()), one(T.LongType())])["c"].dataType == T.LongType()
    assert _widened([one(T.LongType()), one(T.DoubleType())])["c"].dataType == T.DoubleType()
    assert _widened([one(T.DateType()), one(T.IntegerType())])["c"].dataType == T.StringType()


def test_odd_files(spark, tmp_path):
    folder = tmp_path / "in dir"
    put(folder, a='"a","multi\nline"\n1,"x\ny"\n', blank="", b='﻿"a","multi\nother"\n2,z\n', c="\n\na\n3\n")
    with gzip.open(folder / "d.csv.gz", "wt") as f:
        f.write("b,a\nzip,4\n")
    path = str(folder)
    assert len(_header_groups(spark, path)) == 4  # the empty file has no header
    got = rows(read_csv(spark, path, multi_line=True))
    assert {r["a"] for r in got} == {"1", "2", "3", "4"}
    assert {k: v for r in got for k, v in r.items() if v and k != "a"} == {"multi\nline": "x\ny", "multi\nother": "z", "b": "zip"}


def test_glob_characters_in_file_names(spark, tmp_path):
    src = put(tmp_path / "in", **{"a[1]": "a,b\n1,2\n", "a{2}": "b,a\n3,4\n", "c?*": "a\n5\n"})
    assert [(r.a, r.b) for r in read_csv(spark, src).orderBy("a").collect()] == [("1", "2"), ("4", "3"), ("5", None)]


def test_files_of_one_header_stay_one_scan(spark, tmp_path):
    src = put(tmp_path / "in", a="a,b\n1,2\n", b="a,b\n3,4\n")
    plan = read_csv(spark, src)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "Union" not in plan
    many = put(tmp_path / "two", **{f"f{i}": "a,b\n1,2\n" if i % 2 else "b,a\n1,2\n" for i in range(20)})
    plan = read_csv(spark, many)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2  # by distinct header, not by file


def test_only_empty_files_and_missing_paths(spark, tmp_path):
    src = put(tmp_path / "in", a="")
    assert read_csv(spark, src, schema="a INT").count() == 0
    with pytest.raises(FileNotFoundError):
        require_path(spark, str(tmp_path / "nowhere"))
