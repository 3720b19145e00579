"""Cell-level work on wide keyed rows.

The long form has one row per cell: rowkey, family, qualifier, ts, value. A missing
cell is an absent row, never a null value.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.sizes import measured_bytes
from footfall.schemas import CELL_SCHEMA
from footfall.session import materialize

CELL_KEY = ("rowkey", "family", "qualifier")


def to_cells(rows: DataFrame, families: Mapping[str, Iterable[str]], ts: Column | int = 0) -> DataFrame:
    """Wide rows to cells. ``families`` names the columns of each family; a column may be in several."""
    stamp = (F.lit(ts) if isinstance(ts, int) else ts).cast("bigint")
    pairs = sorted((f, q) for f, qualifiers in families.items() for q in qualifiers)
    cells = [
        F.struct(F.lit(f).alias("family"), F.lit(q).alias("qualifier"), F.col(q).cast("string").alias("value"))
        for f, q in pairs
    ]
    # In key order, so that rows sorted by key give sorted cells.
    long = rows.select("rowkey", stamp.alias("ts"), F.inline(F.array(*cells)))
    return long.where(F.col("value").isNotNull()).select(*CELL_SCHEMA.names)


def from_cells(cells: DataFrame, columns: Iterable[tuple[str, str]], names: Iterable[str] | None = None) -> DataFrame:
    """Cells to wide rows with the given (family, qualifier) columns; a missing cell is null.

    Columns are named by ``names``, or else by their qualifier. The latest version of each cell wins (the larger value
    on equal stamps), so versions need not be merged before; it stays one shuffle on the row key.
    """
    columns = list(columns)
    names = list(names) if names else [q for _, q in columns]
    latest = [
        F.max(F.when((F.col("family") == f) & (F.col("qualifier") == q), F.struct("ts", "value")))["value"].alias(name)
        for (f, q), name in zip(columns, names, strict=True)
    ]
    return cells.groupBy("rowkey").agg(*latest)


def latest_cells(cells: DataFrame) -> DataFrame:
    """One version per cell: the latest, and the larger value on equal stamps."""
    newest = F.max(F.struct("ts", "value")).alias("v")
    return cells.groupBy(*CELL_KEY).agg(newest).select(*CELL_KEY, "v.ts", "v.value")


def _same(names: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(CELL_KEY, names)])


def merged_cells(base: DataFrame, runs: DataFrame) -> DataFrame:
    """``base`` with all puts of ``runs`` on top, as ``upsert_cells`` would leave it after the last of them.

    Nothing is stored, so that a filter on the row key reaches the files of both.
    """
    columns, names = CELL_SCHEMA.names, [f"_{c}" for c in CELL_KEY]
    news = latest_cells(runs)
    keys = news.select(*[F.col(c).alias(n) for c, n in zip(CELL_KEY, names)])
    untouched = base.join(keys, _same(names), "left_anti").select(*columns)
    touched = base.join(keys, _same(names), "left_semi").select(*columns)
    return untouched.unionByName(latest_cells(touched.unionByName(news.select(*columns))).select(*columns))


def upsert_cells(base: DataFrame, changes: DataFrame, broadcast_bytes: int = 128 << 20) -> DataFrame:
    """``base`` with ``changes`` put on top.

    Each cell that the changes name comes out once, with its latest version from both; every other cell stays as it
    is, with all its versions. Keys are compared null-safely. The changes are stored once. Their size decides only how
    Spark joins: while it stays under ``broadcast_bytes`` they are broadcast and the base, however large, does not
    move, and beyond it both sides shuffle; the result is the same.
    """
    columns, names = CELL_SCHEMA.names, [f"_{c}" for c in CELL_KEY]
    news = materialize(latest_cells(changes.select(*columns)), "changes")
    keys = news.select(*[F.col(c).alias(n) for c, n in zip(CELL_KEY, names)])
    if measured_bytes(news, *CELL_KEY) <= broadcast_bytes:
        keys = F.broadcast(keys)
    untouched = base.join(keys, _same(names), "left_anti").select(*columns)
    touched = base.join(keys, _same(names), "left_semi").select(*columns)
    return untouched.unionByName(latest_cells(touched.unionByName(news)).select(*columns))


def get_row(rows: DataFrame, key: str) -> DataFrame:
    """Point lookup; on a stored table the test reaches the file scan."""
    return rows.where(F.col("rowkey") == key)


def column_scan(rows: DataFrame, column: str) -> DataFrame:
    """Only the rows that have ``column``, and only that column."""
    return rows.where(F.col(column).isNotNull()).select("rowkey", column)


def prefix_scan(rows: DataFrame, prefixes: Iterable[str]) -> DataFrame:
    """Rows whose key starts with any of the prefixes."""
    tests = [F.col("rowkey").startswith(p) for p in prefixes]
    return rows.where(reduce(lambda a, b: a | b, tests))


def sort_for_bulk_load(cells: DataFrame, partitions: int | None = None) -> DataFrame:
    """Cells in total order: ranges of the cell key across files, sorted inside each.

    The range covers the whole cell key, so a row with very many cells spans several
    files. Spark samples its input to place the ranges: pass a stored table, not a
    plan that is dear to run twice.
    """
    key = [F.col(c) for c in CELL_KEY]
    ranged = cells.repartitionByRange(*([partitions] if partitions else []), *key)
    return ranged.sortWithinPartitions(*key)


def sort_rows_for_bulk_load(rows: DataFrame, families: Mapping[str, Iterable[str]], ts: Column | int = 0,
                            partitions: int | None = None) -> DataFrame:
    """Wide rows as cells in total order. The rows are ranged and sorted, and only then cut into cells.

    One row is moved where ``sort_for_bulk_load`` would move each of its cells. Row keys must be unique.
    """
    ranged = rows.repartitionByRange(*([partitions] if partitions else []), F.col("rowkey"))
    return to_cells(ranged.sortWithinPartitions("rowkey"), families, ts)
