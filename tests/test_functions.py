import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sideline.functions.dates import INCIDENT_DATE_FORMATS, date_key, parse_date
from sideline.functions.keys import hash_key, sha256_hex
from sideline.functions.text import (initial_last, last_token, squeeze_ws, strip_point_zero,
                                     text_of, title_text, to_number_or_null)


def one_col(spark, values, fn, t="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {t}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_title_text_edge_case(spark):
    assert one_col(spark, ["\tplayer's mcl-tear (d/l) "], title_text) == ["Player'S Mcl-Tear (D/L)"]


def test_title_text_null_text(spark):
    assert one_col(spark, [None], title_text) == [None]
    assert one_col(spark, [None], lambda c: title_text(c, "nan")) == ["Nan"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("abcXYZ é'-3_ \t.ÉßǆΣ")), max_size=12), min_size=1, max_size=8))
def test_title_matches_python(spark, texts):
    assert one_col(spark, texts, title_text) == [t.strip().title() for t in texts]


def test_initial_last(spark):
    vals = ["LeBron James", "Nene", "Tim Hardaway Jr.", None, "", " Lead Space"]
    assert one_col(spark, vals, initial_last) == ["L. James", "N. Nene", "T. Jr.", None, None, None]


def test_last_token(spark):
    assert one_col(spark, [" Tim  Hardaway Jr. ", "", "Solo"], last_token) == ["Jr.", "", "Solo"]


def test_strip_point_zero_and_squeeze(spark):
    assert one_col(spark, ["2018.0", "2018", None], strip_point_zero) == ["2018", "2018", None]
    assert one_col(spark, ["a  b\t\tc"], squeeze_ws) == ["a b c"]


def test_parse_date_formats(spark):
    vals = ["2018-10-01", "10/13/2018", "13/10/2018", "junk", None, "2018-10-01 00:00:00"]
    got = one_col(spark, vals, lambda c: parse_date(c, INCIDENT_DATE_FORMATS))
    assert got == [dt.date(2018, 10, 1), dt.date(2018, 10, 13), dt.date(2018, 10, 13), None, None, dt.date(2018, 10, 1)]


def test_parse_date_reads_dates_and_times_whatever_the_formats(spark):
    df = spark.sql("SELECT DATE'2018-10-02' AS d, TIMESTAMP'2018-10-02 13:14:15.5' AS t, '2018-10-02T01:02:03Z' AS iso, "
                   "'10/02/2018' AS us, '2018' AS year")
    for formats in (("yyyy-MM-dd",), ("MM/dd/yyyy",), INCIDENT_DATE_FORMATS):
        got = df.select(*[parse_date(c, formats).alias(c) for c in df.columns]).first()
        us = None if formats == ("yyyy-MM-dd",) else dt.date(2018, 10, 2)
        assert tuple(got) == (*[dt.date(2018, 10, 2)] * 3, us, None)


def test_date_key_and_day_of_week(spark):
    df = spark.createDataFrame([(dt.date(2018, 10, 7),), (dt.date(999, 1, 2),)], "d date")
    rows = df.select(date_key("d"), F.dayofweek("d")).collect()
    assert [tuple(r) for r in rows] == [(20181007, 1), (9990102, rows[1][1])]


def test_text_of_skips_nulls(spark):
    df = spark.createDataFrame([("Fracture", None), (None, "Left FOOT"), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(text_of("a", "b")).collect()] == ["fracture", "left foot", ""]


def test_hash_keys(spark):
    import hashlib
    df = spark.createDataFrame([("abc", None, "x")], "a string, b string, c string")
    r = df.select(sha256_hex("a"), sha256_hex("b"), hash_key("a", "b", "c")).first()
    assert r[0] == hashlib.sha256(b"abc").hexdigest()
    assert r[1] is None
    assert r[2] == hashlib.sha256(b"abc|x").hexdigest()


def test_to_number_or_null(spark):
    assert one_col(spark, ["2018.0", "x", None], to_number_or_null) == [2018.0, None, None]
