"""The driver contract, and every registered query against its DuckDB twin on sf0.001."""

import datetime as dt
import math
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["play_type", "n", "share", "pct"]
    assert df.count() > 0


def test_registry_shape():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 45


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: [(x is None, str(x)) for x in t])
    return [cols[i] for i in order], out


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(E.oracle_sql()[name])
    want = _canon([d[0] for d in res.description], res.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


@pytest.mark.parametrize("conf", [{"spark.sql.session.timeZone": "America/Los_Angeles"},
                                  {"spark.sql.ansi.enabled": "false"}])
def test_results_do_not_depend_on_session_settings(spark, duck, conf):
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for name in ("pre_incident_pairs", "dim_date", "clean_incidents", "league_vs_group", "parse_dates"):
            df = E.queries()[name](spark, SF_SMALL)
            got = _canon(df.columns, [tuple(r) for r in df.collect()])
            res = duck.execute(E.oracle_sql()[name])
            assert got == _canon([d[0] for d in res.description], res.fetchall()), name
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("missing", ["xxhash", "public_tokenizers", "sideline.llm", "corpus_pipeline"])
def test_core_queries_need_nothing_of_the_optional_part(missing):
    code = (f"import sys, warnings; sys.modules[{missing!r}] = None; warnings.simplefilter('ignore'); import __spark_entry__ as E; "
            "assert 'fact_injury' in E.queries() and 'fact_injury' in E.oracle_sql() and 'pipeline' not in E.queries(), sorted(E.queries())")
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=repo, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-1500:]
