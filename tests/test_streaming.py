import os
import subprocess
import sys

from pyspark.sql import functions as F

from sideline.plans import jobs
from sideline.plans import sample_views as sv
from sideline.streaming.daily import run_daily
from conftest import SF_SMALL

SEASON = ("1995-01-01", "2001-12-31")


def same(a, b):
    cols = b.columns
    return a.select(cols).exceptAll(b).count() == 0 and b.exceptAll(a.select(cols)).count() == 0


def test_daily_equals_batch_with_late_incidents_and_game_dates(spark, tmp_dir):
    act = sv.activity(spark, SF_SMALL).select(*jobs.ACTIVITY_COLUMNS, "gameDate")
    inc = sv.item_incidents(spark, SF_SMALL)
    games = sv.game_dates(spark, SF_SMALL)
    src, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    early = act.filter(F.year("gameDate") <= 1997).drop("gameDate")
    late = act.filter(F.year("gameDate") > 1997).drop("gameDate")
    # day 1 knows a few incidents and game dates only; the others arrive with day 2
    known = inc.filter("crc32(player_name) % 3 = 0")
    dated = games.filter("crc32(GAMEID) % 2 = 0")
    early.write.option("header", True).csv(os.path.join(src, "day1"))
    first = run_daily(spark, src + "/*", known, dated, out, None, *SEASON)
    assert same(first, jobs.analysis_ready(known, early, dated, *SEASON)[1])
    n = first.count()
    late.write.option("header", True).csv(os.path.join(src, "day2"))
    run_daily(spark, src + "/*", inc, games, out, None, *SEASON)
    got = run_daily(spark, src + "/*", inc, games, out, None, *SEASON)  # nothing new: no duplicates
    assert 0 < n < got.count()
    assert same(got, jobs.analysis_ready(inc, act.drop("gameDate"), games, *SEASON)[1])


ONE_RUN = """
import sys
sys.path.insert(0, {repo!r})
from sideline.__main__ import main
from sideline.session import build_session
build_session("local[2]", shuffle_partitions=2, extra={{"spark.checkpoint.dir": {ckpt!r}}})
main(["daily", "--activity-dir", {src!r}, "--incidents", {inc!r}, "--game-dates", {games!r}, "--out", {out!r}])
"""


def test_two_processes_lose_nothing(tmp_path):
    """Each day runs in a process of its own, without --checkpoint."""
    header = ",".join(jobs.ACTIVITY_COLUMNS)
    (tmp_path / "in").mkdir()
    (tmp_path / "inc.csv").write_text('player_name,Team,Notes,Injury_Type,date\nAl Bo,T,"torn ""acl"", out",,2018-11-05\n')
    (tmp_path / "games.csv").write_text("GAMEID,gameDate\n1,2018-11-01\n2,2018-11-02\n")
    run = ONE_RUN.format(repo=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), ckpt=str(tmp_path / "ckpt"),
                         src=str(tmp_path / "in"), inc=str(tmp_path / "inc.csv"), games=str(tmp_path / "games.csv"),
                         out=str(tmp_path / "out"))
    for day in (1, 2):
        (tmp_path / "in" / f"day{day}.csv").write_text(f"{header}\n{day},A. Bo,t,T,1,1:00,shot,dunk,made,{day}\n")
        done = subprocess.run([sys.executable, "-c", run], capture_output=True, text=True, timeout=300)
        assert done.returncode == 0, done.stderr[-2000:]
    import pyarrow.dataset as ds
    got = ds.dataset(str(tmp_path / "out" / "analysis_ready"), format="parquet").to_table().to_pylist()
    assert sorted(r["gameId"] for r in got) == ["1", "2"]
