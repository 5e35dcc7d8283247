"""Item exports: the JSON is parsed once, columns are the union of attributes."""

import json
import math
import os
import subprocess
import sys

import pytest
from pyspark.sql import types as T

from sideline.sources.readers import _columns_of, read_items


def put(tmp_path, *lines):
    folder = tmp_path / "in"
    folder.mkdir(exist_ok=True)
    (folder / "part.json").write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))
    return str(folder)


def test_typed_items_of_any_kind_and_name(spark, tmp_path):
    odd = ["a.b 'c\"", "x`y", "OBJECT", "VOID", "decimal(1,1)", "tab\there", "é漢"]
    path = put(tmp_path, {"Item": {**{n: {"S": n} for n in odd}, "n": {"N": "1e400"}, "mix": {"N": "2"}, "l": {"L": [{"S": "x"}, {"N": "2"}]}}},
               {"Item": {"mix": {"S": "two"}, "either": {"S": "s"}, "nul": {"NULL": True}, "deep": {"M": {"k": {"N": "1"}}}}},
               {"Item": {"either": 5, "deep": {"M": {"k": "odd"}}, "flag": {"BOOL": False}}}, {"Item": {}})
    df = read_items(spark, path)
    assert set(df.columns) == {*odd, "n", "mix", "l", "either", "nul", "deep", "flag"}
    kinds = dict(df.dtypes)
    assert kinds["n"] == "double" and kinds["flag"] == "boolean" and kinds["mix"] == "string"
    rows = sorted((r.asDict() for r in df.collect()), key=str)
    assert len(rows) == 4
    one = next(r for r in rows if r["mix"] == "2")
    assert [one[n] for n in odd] == odd and math.isinf(one["n"]) and json.loads(one["l"]) == [{"S": "x"}, {"N": "2"}]
    two = next(r for r in rows if r["mix"] == "two")
    assert json.loads(two["either"]) == {"S": "s"} and two["nul"] is None and json.loads(two["deep"]) == {"k": {"N": "1"}}
    three = next(r for r in rows if r["either"] == "5")
    assert json.loads(three["deep"]) == {"k": "odd"} and three["flag"] is False


def test_plain_items_equal_spark_s_own_inference(spark, tmp_path):
    path = put(tmp_path, {"a": 1, "b": 1.5, "c": "x", "d": {"e": [1, 2], "f": None}, "g": True, "sci": 1e300, "n": None},
               {"a": 2.5, "b": 3, "c": None, "d": {"e": [], "h": "k"}, "z": [{"q": 1}], "long": 2**40})
    got, want = read_items(spark, path), spark.read.json(path)
    assert sorted(got.dtypes) == sorted(want.dtypes)
    assert got.select(sorted(got.columns)).exceptAll(want.select(sorted(got.columns))).count() == 0 and got.count() == want.count()
    mixed = read_items(spark, put(tmp_path, {"m": 1}, {"m": "s"}, {"m": {"k": [1]}}, {"m": None}, {"big": 10**30}))
    assert {r.m for r in mixed.collect()} == {"1", "s", '{"k":[1]}', None} and dict(mixed.dtypes)["big"] == "double"


def test_json_is_parsed_once(spark, tmp_path):
    path = put(tmp_path, {"Item": {"a": {"S": "x"}}})
    df = read_items(spark, path)
    assert df.count() == 1
    os.remove(f"{path}/part.json")  # nothing reads it again
    assert [r.a for r in df.collect()] == ["x"]
    assert "FileScan parquet" in df._jdf.queryExecution().executedPlan().toString()


def test_given_schema_reads_the_export_as_it_stands(spark, tmp_path):
    schema = T.StructType.fromDDL("Item STRUCT<a: STRUCT<N: STRING>, b: STRUCT<S: STRING>>")
    df = read_items(spark, put(tmp_path, {"Item": {"a": {"N": "1.5"}, "c": {"S": "y"}}}), schema)
    assert df.dtypes == [("a", "double"), ("b", "string")] and tuple(df.first()) == (1.5, None)


def test_bad_lines_and_empty_exports(spark, tmp_path):
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        read_items(spark, put(tmp_path, {"Item": {"a": {"S": "x"}}}, '{"Item": {"a":'))
    with pytest.raises(ValueError, match="JSON objects"):
        read_items(spark, put(tmp_path, "[1, 2]", "3"))
    assert read_items(spark, put(tmp_path, "")).columns == []
    assert read_items(spark, put(tmp_path, {})).columns == []


def test_columns_of():
    assert _columns_of("OBJECT<a: DECIMAL(21,1), `OBJECT<VOID>, x`: VOID, VOID: VOID, z: ARRAY<OBJECT<q: VOID>>, m: VARIANT>") == \
        "STRUCT<a: DOUBLE, `OBJECT<VOID>, x`: STRING, VOID: STRING, z: ARRAY<STRUCT<q: STRING>>, m: VARIANT>"


def test_kept_lines_go_when_the_driver_ends(tmp_path):
    path = put(tmp_path, {"Item": {"a": {"S": "x"}}})
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (f"import sys; sys.path.insert(0, {repo!r})\nfrom sideline.session import build_session\nfrom sideline.sources.readers import read_items\n"
            f"s = build_session('local[1]', shuffle_partitions=1, extra={{'spark.checkpoint.dir': {str(tmp_path / 'ckpt')!r}}})\n"
            f"assert read_items(s, {path!r}).count() == 1\ns.stop()")
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-1500:]
    assert os.listdir(tmp_path / "ckpt" / "sideline-kept") == []
