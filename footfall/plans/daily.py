"""The daily access-log job: load one day's visits, then report on them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from footfall.functions.agents import with_agent
from footfall.functions.keys import visit_key
from footfall.operators.cells import sort_for_bulk_load, sort_rows_for_bulk_load, to_cells
from footfall.operators.geo_nested import located
from footfall.operators.visits import browser_stat, dedup_visits, merged_keys, region_stat, storable, unreported, visit_cube
from footfall.schemas import GEO_COLUMNS, LOG_COLUMNS, VISIT_COLUMNS, VISIT_SCHEMA
from footfall.session import discard, materialize
from footfall.sinks.tables import append_day, read_days, upsert_days, write_day, write_report
from footfall.sources.access_log import accepted, parse_lines, with_key

BARE_COLUMNS = tuple(c for c in VISIT_COLUMNS if c not in GEO_COLUMNS)
FAMILY = "info"


def log_rows(lines: DataFrame, ranges: DataFrame, tz: str = "UTC") -> DataFrame:
    """Readable lines as located and classed rows, for looking at a log directly."""
    return located(with_agent(accepted(parse_lines(lines, tz))), ranges).select(*LOG_COLUMNS)


def requests(lines: DataFrame, tz: str = "UTC", day: str | None = None, digest: str = "crc32") -> DataFrame:
    """Every readable request with its key, browser and system; one row per log line."""
    rows = with_key(with_agent(accepted(parse_lines(lines, tz))), day, digest)
    return rows.select("rowkey", *BARE_COLUMNS, "day")


def visits(lines: DataFrame, ranges: DataFrame, tz: str = "UTC", day: str | None = None, digest: str = "crc32") -> DataFrame:
    """Deduplicated, located visits in table order.

    User agents are classed before the shuffle, as the classes are shorter than the
    text. Addresses are looked up after it: the place follows from the address, so it
    neither changes which row wins nor has to travel.
    """
    return storable(located(dedup_visits(requests(lines, tz, day, digest)), ranges))


def staged_day(
    lines: DataFrame, tz: str = "UTC", day: str | None = None, digest: str = "crc32"
) -> tuple[DataFrame, dict[str, int]]:
    """Every line, parsed in the one scan of the log, as stored rows: the request's columns or, where it cannot be
    taken, its text and ``reject_reason``. ``sha2_key`` is the key without collisions, to count those of the key.

    Lines and rejected ones are counted by the write itself.
    """
    rows = with_key(with_agent(parse_lines(lines, tz)), day, digest)
    incomplete = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in ("rowkey", *BARE_COLUMNS)])
    reason = F.coalesce("reject_reason", F.when(incomplete, "incomplete"))
    rows = rows.withColumn("sha2_key", visit_key(F.col("day"), "sha2")).withColumn("reject_reason", reason)
    text = F.when(F.col("reject_reason").isNotNull(), F.col("value")).alias("value")
    seen = Observation()
    rows = rows.select("rowkey", *BARE_COLUMNS, "day", "sha2_key", "reject_reason", text)
    bad = F.count_if(F.col("reject_reason").isNotNull())
    staged = materialize(rows.observe(seen, F.count(F.lit(1)).alias("lines"), bad.alias("rejected")), "staged_day")
    return staged, seen.get


def merged_visits(stored: DataFrame) -> DataFrame:
    """Located visits of several loads as one load of all their lines has them."""
    return dedup_visits(stored, BARE_COLUMNS)


def load_day(
    lines: DataFrame,
    ranges: DataFrame,
    table: str,
    day: str,
    rejects: str | None = None,
    every_request: str | None = None,
    tz: str = "UTC",
    digest: str = "crc32",
    add: bool = False,
) -> dict[str, int]:
    """Replace one day of the visit table; lines that cannot be taken go to ``rejects``, if given.

    With ``add``, the lines are late files of a loaded day: its visits are merged with theirs, so that the table is as
    one load of all files leaves it, and only the files of the table that they touch are written anew. Requests and
    rejects are appended, so the same files must not be added twice where these are kept.

    ``every_request`` names a second table of the same shape that keeps repeated
    requests. Reports count visits or requests by the table they read. Returns what was
    counted: lines, accepted, rejected, and merged (visits that the short key hides).
    """
    staged, counted = staged_day(lines, tz, day, digest)
    try:
        bad = F.col("reject_reason").isNotNull()
        good = staged.where(~bad).select("rowkey", *BARE_COLUMNS, "day")
        if every_request:
            every = _in_key_order(storable(located(good, ranges)))
            append_day(every, every_request, day) if add else write_day(every, every_request, day)
        visits_ = storable(located(dedup_visits(good), ranges))
        if add:
            upsert_days(visits_.withColumn("day", F.lit(day)), table, merged_visits)
        else:
            write_day(_in_key_order(visits_), table, day, "rowkey")
        if rejects:
            # Few rows from very many tasks: rebalance them into few files.
            wrong = staged.where(bad).select("value", "reject_reason").hint("rebalance")
            append_day(wrong, rejects, day) if add else write_day(wrong, rejects, day)
        merged = merged_keys(staged.where(~bad)) if digest == "crc32" else 0
    finally:
        discard(staged)
    return {
        "lines": counted["lines"], "accepted": counted["lines"] - counted["rejected"],
        "rejected": counted["rejected"], "merged": merged,
    }


def _in_key_order(visits: DataFrame) -> DataFrame:
    """Ranges of the key, sorted inside, so that a lookup skips files and row groups."""
    return visits.repartitionByRange("rowkey").sortWithinPartitions("rowkey")


def visit_cells(stored: DataFrame, ts: int = 0) -> DataFrame:
    """Stored visits as cells, fifteen per visit."""
    return to_cells(stored, {FAMILY: VISIT_COLUMNS}, ts)


def bulk_load_day(cells: DataFrame, table: str, day: str, partitions: int | None = None) -> str:
    """Replace one day of a cell table by files that are in total key order; returns their folder."""
    return write_day(sort_for_bulk_load(cells, partitions), table, day)


def bulk_load_visits(stored: DataFrame, table: str, day: str, ts: int = 0, partitions: int | None = None) -> str:
    """``bulk_load_day`` for stored visits: they are sorted as wide rows, a fifteenth of the rows, and then cut."""
    return write_day(sort_rows_for_bulk_load(stored, {FAMILY: VISIT_COLUMNS}, ts, partitions), table, day)


def report_day(spark: SparkSession, table: str, reports: str, day: str) -> int:
    """Replace the day in both report tables; the visits are scanned once, three columns wide.

    Visits with a null report key go to a table of their own, ``unreported``; their number is returned.
    """
    stored = read_days(spark, table, VISIT_SCHEMA, day)
    cube = visit_cube(stored).persist()
    try:
        write_report(browser_stat(cube), f"{reports}/browser_stat", day)
        write_report(region_stat(cube), f"{reports}/region_stat", day)
        write_report(unreported(cube), f"{reports}/unreported", day)
        return unreported(cube).agg(F.coalesce(F.sum("cnt"), F.lit(0))).first()[0]
    finally:
        cube.unpersist()
