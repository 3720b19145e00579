"""Visits and their counts."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.schemas import VISIT_COLUMNS


def dedup_visits(rows: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """One row per (day, rowkey): the one with the latest ``formattime``.

    Ties go to the larger row, column by column (of ``columns``, if given), so a rerun keeps the same rows, and
    deduplicating stored rows with new ones gives what one load of both gives. Spark turns the rank filter into a group limit that also runs before the shuffle: a key
    that holds a third of the log leaves each task as one row.
    """
    rest = [c for c in columns or rows.columns if c not in ("day", "rowkey", "formattime")]
    latest = Window.partitionBy("day", "rowkey").orderBy(*[F.desc(c) for c in ("formattime", *rest)])
    return rows.withColumn("_rank", F.row_number().over(latest)).where(F.col("_rank") == 1).drop("_rank")


def visits_by(visits: DataFrame, *columns: str) -> DataFrame:
    return visits.groupBy(*columns).agg(F.count(F.lit(1)).alias("cnt"))


def visits_by_region(visits: DataFrame) -> DataFrame:
    return visits_by(visits, "country", "province")


def visits_by_browser(visits: DataFrame) -> DataFrame:
    return visits_by(visits, "browsername").orderBy(F.col("cnt").desc(), "browsername")


def visits_by_browser_sql(visits: DataFrame) -> DataFrame:
    """The same report as SQL text over a view."""
    return visits.sparkSession.sql(
        "SELECT browsername, count(1) AS cnt FROM {visits} "
        "GROUP BY browsername ORDER BY cnt DESC, browsername",
        visits=visits,
    )


def top_regions(visits: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` busiest regions; equal counts go by name."""
    return visits_by_region(visits).orderBy(F.col("cnt").desc(), "country", "province").limit(n)


def visit_cube(visits: DataFrame) -> DataFrame:
    """Counts per (day, region, browser): one scan that both daily reports add up from.

    Its size is regions times browsers, so it can be cached whatever the log's size.
    """
    return visits_by(visits, "day", "country", "province", "browsername")


def region_stat(cube: DataFrame) -> DataFrame:
    """Report table rows; the table forbids nulls, see ``unreported`` for the rest."""
    rows = cube.where(F.col("country").isNotNull() & F.col("province").isNotNull())
    return rows.groupBy("day", "country", "province").agg(F.sum("cnt").alias("cnt"))


def browser_stat(cube: DataFrame) -> DataFrame:
    """Report table rows; as ``region_stat``. ``cube`` may lack the region."""
    rows = cube.where(F.col("browsername").isNotNull())
    named = rows.withColumnRenamed("browsername", "browser")
    return named.groupBy("day", "browser").agg(F.sum("cnt").alias("cnt"))


def unreported(cube: DataFrame) -> DataFrame:
    """The visits that a report leaves out, counted: day, country, province, browsername, cnt, reject_reason."""
    no_region = F.col("country").isNull() | F.col("province").isNull()
    reason = F.when(no_region & F.col("browsername").isNull(), "region, browser").when(no_region, "region")
    reason = reason.when(F.col("browsername").isNull(), "browser")
    return cube.withColumn("reject_reason", reason).where(F.col("reject_reason").isNotNull())


def _complete() -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in VISIT_COLUMNS])


def storable(visits: DataFrame) -> DataFrame:
    """Visits in table order; every stored column must have a value."""
    return visits.where(_complete()).select("rowkey", *VISIT_COLUMNS, "day")


def unstorable(visits: DataFrame) -> DataFrame:
    """The visits that ``storable`` leaves out."""
    return visits.where(~_complete()).select("rowkey", *VISIT_COLUMNS, "day")


def merged_keys(keyed: DataFrame) -> int:
    """How many visits a short key hides: distinct (day, key text) pairs beyond the distinct (day, rowkey) pairs.

    ``keyed`` has day, rowkey and ``sha2_key``, the same visit's key by a digest without collisions.
    """
    row = keyed.agg(F.count_distinct("day", "sha2_key").alias("texts"), F.count_distinct("day", "rowkey").alias("keys")).first()
    return row["texts"] - row["keys"]
