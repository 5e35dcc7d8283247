"""The daily run recomputes what new data touches, and nothing else."""

import os
import random

import pytest

from sideline.plans import jobs
from sideline.streaming import daily

SEASON = ("2018-10-01", "2019-05-01")
PLAYERS = [f"A{i} Bo{i}" for i in range(12)]


def put(folder, name, rows, columns=jobs.ACTIVITY_COLUMNS):
    os.makedirs(folder, exist_ok=True)
    lines = [",".join(columns), *(",".join(str(r.get(c, "extra")) for c in columns) for r in rows)]
    with open(f"{folder}/{name}.csv", "w") as f:
        f.write("\n".join(lines) + "\n")


def event(game, player, n):
    first, last = PLAYERS[player].split()
    return dict(zip(jobs.ACTIVITY_COLUMNS, (game, f"{first[0]}. {last}", "t", "T", 1, f"{n}:00", "shot", "dunk", "made", n)))


def incidents(spark, *rows):
    return spark.createDataFrame([(PLAYERS[p], "T", "torn acl", "Tear", d) for p, d in rows],
                                 "player_name string, Team string, Notes string, Injury_Type string, date string")


def dates(spark, **rows):
    return spark.createDataFrame([(k[1:], v) for k, v in rows.items()], "GAMEID string, gameDate string")


def rows_of(df):
    return sorted((tuple(r[c] for c in sorted(r.asDict())) for r in df.collect()), key=str)


class League:
    """Activity files by day, what is known of incidents and games, and both ways to make the table."""

    def __init__(self, spark, folder):
        self.spark, self.src, self.out, self.events = spark, f"{folder}/in", f"{folder}/out", []

    def day(self, name, events, columns=jobs.ACTIVITY_COLUMNS):
        put(self.src, name, events, columns)
        self.events += events

    def check(self, inc, games):
        got = daily.run_daily(self.spark, self.src, inc, games, self.out, None, *SEASON)
        act = self.spark.createDataFrame([tuple(str(e[c]) for c in jobs.ACTIVITY_COLUMNS) for e in self.events],
                                         ", ".join(f"{c} string" for c in jobs.ACTIVITY_COLUMNS))
        want = jobs.analysis_ready(inc, act, games, *SEASON)[1]
        assert sorted(got.columns) == sorted(want.columns)
        assert rows_of(got) == rows_of(want)
        return got

    def files(self, table="activity"):
        return {os.path.join(d, f) for d, _, names in os.walk(f"{self.out}/{table}") for f in names if f.endswith(".parquet")}


def season(seed, n_days=2):
    rng = random.Random(seed)
    return [[event(g, rng.randrange(12), n) for g in range(10 * d, 10 * d + 4) for n in range(30)] for d in range(n_days)]


def test_late_and_withdrawn_data(spark, tmp_path):
    one, two = season(1)
    league = League(spark, tmp_path)
    league.day("day1", one)
    some = incidents(spark, (0, "2018-11-05"), (1, "2018-12-01"), (2, "2017-01-01"))
    few = dates(spark, g0="2018-11-01")
    league.check(some, few)
    league.check(some, few)  # nothing new
    # late dates of old games, one changed; columns in another order and one more
    league.day("day2", two, ("x", *reversed(jobs.ACTIVITY_COLUMNS)))
    league.check(some, dates(spark, g0="2018-11-02", g1="2018-11-03", g10="2018-11-09"))
    # late incidents, one into the season
    more = incidents(spark, (0, "2018-11-05"), (2, "2019-01-01"), (3, "2019-01-02"), (4, "2018-11-05"))
    assert league.check(more, few).count() > 0
    # withdrawn incidents and dates
    league.check(incidents(spark, (4, "2018-11-05")), dates(spark, g10="2018-11-09"))
    assert league.check(incidents(spark, (4, "1990-01-01")), few).count() == 0
    league.check(more, few)


def test_untouched_partitions_are_neither_read_nor_written(spark, tmp_path):
    one, two = season(2)
    league = League(spark, tmp_path)
    league.day("day1", one)
    some, few = incidents(spark, (0, "2018-11-05"), (1, "2018-12-01"), (5, "2018-12-01")), dates(spark, g0="2018-11-01", g10="2018-11-08")
    league.check(some, few)
    old, written = league.files(), {f: os.stat(f).st_mtime_ns for f in league.files("analysis_ready")}
    kept = {f: open(f, "rb").read() for f in old}
    for f in old:  # unreadable: a scan of any of them fails
        open(f, "wb").write(b"not a table")
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    league.day("day2", two)
    league.check(some, few)  # reads the new batch alone
    assert {f: os.stat(f).st_mtime_ns for f in league.files("analysis_ready") if f in written} == written
    # a late incident needs the bucket of its player in all batches, and no other
    bucket = spark.sql("SELECT pmod(xxhash64('A. Bo3'), 16)").first()[0]
    for f, data in kept.items():
        if f"{daily.BUCKET}={bucket}/" in f:
            open(f, "wb").write(data)
    assert any(f"{daily.BUCKET}={bucket}/" not in f for f in old)
    league.check(incidents(spark, (0, "2018-11-05"), (1, "2018-12-01"), (5, "2018-12-01"), (3, "2018-12-01")), few)
    # a late date needs the partitions that hold the game
    with pytest.raises(Exception, match="not a Parquet file|is not a Parquet|FAILED_READ_FILE"):
        league.check(some, dates(spark, g0="2018-11-01", g10="2018-11-08", g1="2018-11-02"))


def test_a_run_that_dies_is_repeated(spark, tmp_path, monkeypatch):
    one, two = season(3)
    league = League(spark, tmp_path)
    some, few = incidents(spark, (0, "2018-11-05"), (1, "2018-12-01")), dates(spark, g0="2018-11-01")
    league.day("day1", one)
    league.check(some, few)
    more = incidents(spark, (1, "2018-12-01"), (3, "2018-12-01"))
    for where, what in ((daily, "land"), (daily, "lookup"), (daily.State, "finish")):
        def dies(*a, **kw):
            raise RuntimeError("lost")
        with monkeypatch.context() as m:
            m.setattr(where, what, dies)
            league.day(f"day2-{what}", two[:40] if what == "land" else [])
            with pytest.raises(RuntimeError, match="lost"):
                daily.run_daily(spark, league.src, more, few, league.out, None, *SEASON)
    league.day("day3", two[40:])
    league.check(more, few)
    league.check(more, few)


def test_a_file_without_a_needed_column_is_refused(spark, tmp_path):
    league = League(spark, tmp_path)
    some, few = incidents(spark, (0, "2018-11-05")), dates(spark, g0="2018-11-01")
    put(league.src, "bad", season(4)[0], jobs.ACTIVITY_COLUMNS[1:])
    with pytest.raises(KeyError, match="'gameId' not found in .*bad.csv"):
        daily.run_daily(spark, league.src, some, few, league.out, None, *SEASON)
    assert not league.files()
    put(league.src, "bad", [], jobs.ACTIVITY_COLUMNS)  # mended in place
    league.day("good", season(4)[0])
    league.check(some, few)


def test_no_activity_yet(spark, tmp_path):
    league = League(spark, tmp_path)
    os.makedirs(league.src)
    some, few = incidents(spark, (0, "2018-11-05")), dates(spark, g0="2018-11-01")
    assert daily.run_daily(spark, league.src, some, few, league.out, None, *SEASON).count() == 0
    league.day("day1", season(5)[0])
    league.check(some, few)
