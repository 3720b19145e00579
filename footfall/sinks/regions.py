"""Bulk loads into regions: split points that are kept with a table and shared by all its loads.

The first load samples its rows once to place the splits. Every later one sends its rows straight to their region, by
binary search in the kept splits, without a sampling pass and into the same regions, so files of several loads line up.
A region that a load fills beyond ``most_rows`` is split for the loads to come; no region is ever joined or moved.

Regions are of ``region``, an expression of the row: the row key, or for keys that begin with a day the rest of it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.keys import region_of
from footfall.operators.cells import to_cells
from footfall.sinks.tables import publish
from footfall.sinks.versions import File, folder_of, hadoop_path

REGIONS = "_regions"
WITHOUT_DAY = "substring_index(rowkey, '_', -1)"


def _numbers(spark: SparkSession, root: str) -> list[int]:
    path, fs = hadoop_path(spark, f"{root.rstrip('/')}/{REGIONS}")
    return sorted(int(s.getPath().getName()) for s in fs.listStatus(path)) if fs.exists(path) else []


def splits(spark: SparkSession, root: str) -> tuple[int, list[str] | None]:
    """(number, ascending split points) of the table; (-1, None) before its first load."""
    for number in reversed(_numbers(spark, root)):
        path, fs = hadoop_path(spark, f"{root.rstrip('/')}/{REGIONS}/{number:012d}")
        stream = fs.open(path)
        try:
            return number, json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except ValueError:  # its writer died; the ones before still hold
            continue
        finally:
            stream.close()
    return -1, None


def _keep(spark: SparkSession, root: str, after: int, points: list[str]) -> None:
    """Store new splits, unless another load has stored some since: those are as good."""
    path, fs = hadoop_path(spark, f"{root.rstrip('/')}/{REGIONS}/{after + 1:012d}")
    if fs.exists(path):
        return
    stream = fs.create(path, False)
    stream.write(bytearray(json.dumps(points), "utf-8"))
    stream.close()


def _sampled(rows: DataFrame, pieces: int, *within: str) -> list[str]:
    """The least ``region_`` of each range that rows are dealt to."""
    ranged = rows.repartitionByRange(pieces, *within, "region_")
    starts = ranged.groupBy(F.spark_partition_id().alias("part")).agg(F.min("region_").alias("start"))
    return [r["start"] for r in starts.collect() if r["start"] is not None]  # a row per region


def load_regions(
    rows: DataFrame, root: str, day: str, families: Mapping[str, Iterable[str]], ts: int = 0, region: str = "rowkey",
    most_rows: int = 50_000_000,
) -> str:
    """Replace one day of a cell table by wide rows, cut into cells, a sorted file for each region; returns its folder.

    Row keys are unique and should be stored: the first load, and regions that are full, are read a second time.
    """
    spark = rows.sparkSession
    placed = rows.withColumn("region_", F.expr(region))
    number, points = splits(spark, root)
    if points is None:
        pieces = int(spark.conf.get("spark.sql.shuffle.partitions"))
        points = sorted(set(_sampled(placed, pieces)))[1:]
        _keep(spark, root, number, points)
        number, points = splits(spark, root)  # another load may have been first
    dealt = placed.withColumn("number_", region_of("region_", points)).repartitionById(len(points) + 1, F.col("number_"))
    cells = to_cells(dealt.sortWithinPartitions("region_", "rowkey"), families, ts)
    folder = folder_of(day, uuid.uuid4().hex)
    cells.write.parquet(f"{root.rstrip('/')}/{folder}")
    publish(spark, root, day, [File(folder)], {})
    _split_full(placed, root, number, points, most_rows)
    return f"{root.rstrip('/')}/{folder}"


def _split_full(placed: DataFrame, root: str, number: int, points: list[str], most_rows: int) -> None:
    """Keep more splits where a region has more than ``most_rows`` rows."""
    numbered = placed.select("region_", region_of("region_", points).alias("number_"))
    counts = numbered.groupBy("number_").count().where(F.col("count") > most_rows).collect()  # a row per full region
    if counts:
        full = numbered.where(F.col("number_").isin([r["number_"] for r in counts]))
        pieces = sum(-(-r["count"] // most_rows) for r in counts)
        more = set(_sampled(full, pieces, "number_")) | set(points)
        _keep(placed.sparkSession, root, number, sorted(more - {""}))
