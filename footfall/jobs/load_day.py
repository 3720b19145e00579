"""Load one day of the access log into the visit table.

    spark-submit footfall/jobs/load_day.py --day 20190130 --logs /access \\
        --ranges /geo/ranges --table /warehouse/visits --rejects /warehouse/rejects
"""

from __future__ import annotations

import argparse

from footfall.plans.daily import bulk_load_visits, load_day
from footfall.schemas import VISIT_SCHEMA
from footfall.session import build_session
from footfall.sinks.tables import read_days
from footfall.sources.access_log import read_lines


def main(argv: list[str] | None = None) -> None:
    options = argparse.ArgumentParser(description="Load one day of the access log")
    options.add_argument("--day", required=True, help="yyyyMMdd")
    options.add_argument("--logs", required=True, help="folder with one sub-folder of log files per day")
    options.add_argument("--ranges", required=True, help="Parquet table: lo, hi, country, province, city")
    options.add_argument("--table", required=True, help="folder of the visit table")
    options.add_argument("--rejects", help="folder for lines that cannot be read")
    options.add_argument("--requests", help="folder of a second table that keeps repeated requests")
    options.add_argument("--cells", help="folder for the same visits as sorted cells")
    options.add_argument("--partitions", type=int, help="number of cell files; the shuffle partitions when left out")
    options.add_argument("--tz", default="UTC", help="zone of the stored minute")
    options.add_argument("--key", default="crc32", choices=["crc32", "sha2"])
    options.add_argument("--add", action="store_true", help="late files of a loaded day: merge them into it")
    args = options.parse_args(argv)

    spark = build_session(f"load_day {args.day}")
    lines = read_lines(spark, args.logs, args.day)
    ranges = spark.read.parquet(args.ranges)
    counted = load_day(lines, ranges, args.table, args.day, args.rejects, args.requests, args.tz, args.key, args.add)
    print(" ".join(f"{name}={n}" for name, n in counted.items()))
    if args.cells:
        # From the stored table: placing the sort ranges reads the input twice.
        bulk_load_visits(read_days(spark, args.table, VISIT_SCHEMA, args.day), args.cells, args.day, 0, args.partitions)


if __name__ == "__main__":
    main()
