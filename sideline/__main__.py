"""Command line for the batch jobs: ``python -m sideline <job> ...`` or the same
arguments after ``spark-submit sideline/__main__.py``. Paths may be any
Hadoop-compatible location; cluster settings (master, credentials, endpoints)
come from spark-submit / spark-defaults, not from here."""

from __future__ import annotations

import argparse

from .plans import jobs
from .session import build_session


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sideline")
    sub = p.add_subparsers(dest="job", required=True)

    c = sub.add_parser("clean", help="J1: raw incident CSV -> cleaned CSV")
    c.add_argument("--raw", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--null-text", default=None, help="render missing text as this (e.g. 'nan') before cleaning")
    c.add_argument("--date-format", action="append", default=None,
                   help="accepted date format, in order (repeatable); ISO dates and date-times always are")

    s = sub.add_parser("summary", help="J2: cleaned incidents -> summary tables (Parquet)")
    s.add_argument("--clean", required=True)
    s.add_argument("--out-prefix", required=True)
    s.add_argument("--top", type=int, default=10)

    st = sub.add_parser("star", help="J3: raw incident CSV(s) -> star schema (Parquet)")
    # These two option names are the interface users know.
    st.add_argument("--raw-injuries", required=True, help="raw incident CSV path, folder or glob")
    st.add_argument("--clean-prefix", required=True, help="output prefix for the five tables")
    st.add_argument("--year", type=int, default=2018)

    a = sub.add_parser("analysis-ready", help="J4: incidents + activity + game dates -> Parquet")
    a.add_argument("--incidents", required=True)
    a.add_argument("--activity", required=True)
    a.add_argument("--game-dates", required=True)
    a.add_argument("--out-prefix", required=True)
    a.add_argument("--source", choices=["csv", "items"], default="csv")
    a.add_argument("--start", default=jobs.SEASON_START)
    a.add_argument("--end", default=jobs.SEASON_END)

    w = sub.add_parser("window-analysis", help="J5+J6: analysis-ready Parquet -> profiles (Parquet)")
    w.add_argument("--incidents", required=True)
    w.add_argument("--activity", required=True)
    w.add_argument("--out-prefix", required=True)
    w.add_argument("--days", type=int, default=7)

    r = sub.add_parser("report", help="J7: cleaned (or raw) incidents + activity -> report tables")
    r.add_argument("--clean", required=True)
    r.add_argument("--raw", required=True)
    r.add_argument("--activity", required=True)
    r.add_argument("--out-prefix", required=True)
    r.add_argument("--year", type=int, default=2018)

    d = sub.add_parser("daily", help="land newly arrived activity files, then bring J4 up to date")
    d.add_argument("--activity-dir", required=True)
    d.add_argument("--incidents", required=True, help="incident CSV (item-table columns)")
    d.add_argument("--game-dates", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--checkpoint", default=None, help="default: a folder under --out; keep it from run to run")
    d.add_argument("--start", default=jobs.SEASON_START)
    d.add_argument("--end", default=jobs.SEASON_END)
    d.add_argument("--max-files-per-trigger", type=int, default=None)
    for job in (c, s, st, a, r, d):
        job.add_argument("--single-line", action="store_true",
                         help="no incident value holds a line break: large CSV files are then split over tasks")
    return p


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(app=f"sideline-{args.job}")
    lines = {"multi_line": not getattr(args, "single_line", False)}
    if args.job == "clean":
        formats = {"date_formats": args.date_format} if args.date_format else {}
        jobs.clean_job(spark, args.raw, args.out, null_text=args.null_text, **lines, **formats)
    elif args.job == "summary":
        jobs.clean_summary_job(spark, args.clean, args.out_prefix, args.top, **lines)
    elif args.job == "star":
        jobs.star_job(spark, args.raw_injuries, args.clean_prefix, args.year, **lines)
    elif args.job == "analysis-ready":
        jobs.analysis_ready_job(spark, args.incidents, args.activity, args.game_dates, args.out_prefix,
                                source=args.source, start=args.start, end=args.end, **lines)
    elif args.job == "window-analysis":
        jobs.window_analysis_job(spark, args.incidents, args.activity, args.out_prefix, args.days)
    elif args.job == "report":
        jobs.report_job(spark, args.clean, args.raw, args.activity, args.out_prefix, args.year, **lines)
    elif args.job == "daily":
        from .sources.readers import read_csv
        from .streaming.daily import run_daily
        run_daily(spark, args.activity_dir, read_csv(spark, args.incidents, **lines),
                  read_csv(spark, args.game_dates),
                  args.out, args.checkpoint, args.start, args.end,
                  max_files_per_trigger=args.max_files_per_trigger)


if __name__ == "__main__":
    main()
