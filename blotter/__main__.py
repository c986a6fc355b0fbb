"""Command line: build the star from the raw feeds, or print a report.

    python -m blotter build  --sf-dir /root/testdata/sf0.01 --out /data/star
    python -m blotter build  --csv calls.csv incidents.csv tencodes.csv suffixes.csv --out /data/star
    python -m blotter build  --tables db.calls db.incidents db.tencodes db.suffixes --out /data/star
    python -m blotter report violent_rate_by_month --out /data/star
    python -m blotter update --raw /data/star/raw --out /data/star      # only the drops that are new
    python -m blotter report calls_by_month --merged --out /data/star   # from the counts that update keeps

``--master`` is only for local runs; on a cluster the submit settings apply.
"""

from __future__ import annotations

import argparse
import json

from blotter.operators import dims
from blotter.plans import reports, trends
from blotter.plans.incremental_star import FEEDS, IncrementalStar
from blotter.plans.star import Star, read_star, write_star
from blotter.session import get_session
from blotter.sources.tables import raw_from_csv, raw_from_tables, raw_inputs

REPORTS = {
    "calls_by_hour": lambda s: reports.calls_by_hour(s.calls_for_reports, s.dim_time),
    "calls_by_month": lambda s: reports.calls_by_month(s.calls_for_reports, s.dim_date),
    "violent_by_dow_hour": lambda s: reports.violent_by_dow_hour(s.incidents_for_reports, s.dim_date, s.dim_time),
    "violent_rate_by_month": lambda s: reports.violent_rate_by_month(
        s.calls_for_reports, s.incidents_for_reports, s.dim_date),
    "incidents_by_time_of_day": lambda s: reports.incidents_by_time_of_day(s.incidents_for_reports, s.dim_time),
    "incidents_weekend": lambda s: reports.incidents_weekend(s.incidents_for_reports, s.dim_date),
    "calls_incidents_correlation": lambda s: reports.calls_incidents_correlation(
        s.calls_for_reports, s.incidents_for_reports, s.dim_date),
    "calls_incidents_significance": lambda s: trends.calls_incidents_significance(
        s.calls_for_reports, s.incidents_for_reports, s.dim_date),
    "calls_incidents_lags": lambda s: trends.calls_incidents_lags(s.calls_for_reports, s.incidents_for_reports, s.dim_date),
    "incidents_moving_average": lambda s: trends.incidents_moving_average(s.incidents_for_reports, s.dim_date),
    "seasonal_index": lambda s: trends.seasonal_index(s.incidents_for_reports, s.dim_date),
}


class Merged:
    """What reports read, from the counts of an incremental star."""

    def __init__(self, spark, star: IncrementalStar) -> None:
        self.calls_for_reports, self.incidents_for_reports = star.rollup("calls"), star.rollup("incidents")
        self.dim_date, self.dim_time = dims.dim_date(spark), dims.dim_time(spark)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="blotter")
    p.add_argument("command", choices=["build", "update", "report"])
    p.add_argument("report", nargs="?", choices=sorted(REPORTS))
    p.add_argument("--sf-dir", help="folder with the events / orders test tables")
    p.add_argument("--csv", nargs=4, metavar=("CALLS", "INCIDENTS", "REF_TENCODE", "REF_SUFFIX"),
                   help="CSV drops to land (header row) instead of the test tables")
    p.add_argument("--tables", nargs=4, metavar=("CALLS", "INCIDENTS", "REF_TENCODE", "REF_SUFFIX"),
                   help="catalog tables to build from")
    p.add_argument("--raw", help="raw layer to update from: one folder per feed and drop")
    p.add_argument("--merged", action="store_true", help="report on the counts that update keeps")
    p.add_argument("--out", required=True, help="folder of the written star")
    p.add_argument("--master", default=None)
    p.add_argument("--normalize-lookups", action="store_true")
    args = p.parse_args(argv)
    spark = get_session(args.master)
    changing = IncrementalStar(spark, args.raw or f"{args.out}/raw", f"{args.out}/incremental")
    if args.command == "update":
        for feed in FEEDS:
            for done in changing.process(feed):
                print(json.dumps({"feed": feed} | {k: done[k] for k in ("drop", "rows", "first_key", "last_key", "months")}))
        return 0
    if args.tables:
        raw = raw_from_tables(spark, *args.tables)
    elif args.csv:
        raw = raw_from_csv(spark, *args.csv, raw_dir=f"{args.out}/raw")
    elif args.sf_dir:
        raw = raw_inputs(spark, args.sf_dir)
    elif args.command == "report":
        raw = None   # reports read the written star only
    else:
        p.error("build needs --sf-dir, --csv or --tables")
    if args.command == "build":
        metrics = write_star(Star(spark, raw, normalize_lookups=args.normalize_lookups), args.out)
        print(json.dumps(metrics, default=str))
        for row in raw.corrupt.where("corrupt > 0").collect() if raw.corrupt is not None else []:  # a row per feed and drop
            print(json.dumps(row.asDict()))
        return 0
    if not args.report:
        p.error("report needs a report name")
    needed = ["dim_date", "dim_time", "fact_calls", "fact_incidents"]
    star = Merged(spark, changing) if args.merged else read_star(spark, raw, args.out, needed)
    for row in REPORTS[args.report](star).collect():
        print(json.dumps(row.asDict(), default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
