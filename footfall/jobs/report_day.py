"""Write one day's browser and region reports and show the busiest regions.

    spark-submit footfall/jobs/report_day.py --day 20190130 \\
        --table /warehouse/visits --reports /warehouse/reports
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from footfall.plans.daily import report_day
from footfall.schemas import BROWSER_STAT_SCHEMA, REGION_STAT_SCHEMA
from footfall.session import build_session
from footfall.sinks.jdbc import replace_day
from footfall.sinks.tables import read_days


def main(argv: list[str] | None = None) -> None:
    options = argparse.ArgumentParser(description="Report on one day's visits")
    options.add_argument("--day", required=True, help="yyyyMMdd")
    options.add_argument("--table", required=True, help="folder of the visit table, or of the table of requests")
    options.add_argument("--reports", required=True, help="folder of the report tables")
    options.add_argument("--jdbc-url", help="also replace the day in SQL tables browser_stat and region_stat")
    options.add_argument("--jdbc-option", action="append", default=[], metavar="NAME=VALUE")
    options.add_argument("--top", type=int, default=10)
    args = options.parse_args(argv)

    spark = build_session(f"report_day {args.day}")
    print(f"unreported={report_day(spark, args.table, args.reports, args.day)}")
    browsers = read_days(spark, f"{args.reports}/browser_stat", BROWSER_STAT_SCHEMA, args.day)
    regions = read_days(spark, f"{args.reports}/region_stat", REGION_STAT_SCHEMA, args.day)
    regions.orderBy(F.desc("cnt"), "country", "province").show(args.top, truncate=False)
    # One row per browser of the rule list.
    browsers.orderBy(F.desc("cnt"), "browser").show(browsers.count(), truncate=False)
    if args.jdbc_url:
        properties = dict(option.split("=", 1) for option in args.jdbc_option)
        replace_day(browsers, args.jdbc_url, "browser_stat", args.day, properties)
        replace_day(regions, args.jdbc_url, "region_stat", args.day, properties)


if __name__ == "__main__":
    main()
