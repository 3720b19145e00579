"""Shards along a Hilbert curve through document metadata.

Each dimension is quantised to ``2**BITS`` cells by its place in the order of its values, weighted by rows, so cells
are about equally full whatever the values are. The cells' point on the Hilbert curve is the sort key; the sorted rows
are cut into runs of equal row counts (law ``rows``: at most one apart). Neighbours on the curve are near in every
dimension, so files written in this order have narrow value ranges in all of them and readers skip most files.

The sort key ends with text checksum, document key and a row number, which splits a hot cell or copies over ranges.
Distinct values per dimension are counted with partial aggregation and joined back; a hot value is a skewed join that
adaptive execution splits. Defined results: null values are a value of their own, before all others; a null text has
no bytes and checksum 0; repeated rows are rows of their own; extra columns are kept by ``sharded_rows`` and not read
otherwise; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import partitions, with_running_total
from footfall.operators.ordering import with_position
from footfall.session import materialize

BITS = 5
SHARDS = 8
SIZE_BITS = 4  # leading bits of a size that count


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points (rows of ``cells``, values below 2**bits).

    From the coordinates' bits, highest first: each level's cell of the curve, with the turn and flip that the curve
    takes inside that cell applied to the lower bits (Skilling's transposed form).
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for bit in range(bits - 1, 0, -1):
        q, low = 1 << bit, (1 << bit) - 1
        for i in range(dims):
            up = (x[i] & q) > 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(up, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] & (1 << bit)) > 0, (1 << bit) - 1, 0)
    x ^= turn
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | (x[i] >> bit & 1)
    return out


def cells_of(rows: DataFrame, dimension: str, bits: int = BITS) -> DataFrame:
    """(value, cell) of every distinct value: the cell holds its first row in the order of values."""
    counts = rows.groupBy(F.col(dimension).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.repartitionByRange(partitions(rows.sparkSession), F.col("value").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("value").asc_nulls_first())
    ranked = with_running_total(ordered, F.col("n"), "before")
    total = max(counts.agg(F.sum("n")).first()[0] or 0, 1)
    cell = F.expr(f"CAST({1 << bits} * before DIV {total} AS INT)")
    return materialize(ranked.select("value", cell.alias(dimension + "_cell")), "cells")


def _rounded_size(size: Column) -> Column:
    return F.expr("shiftleft(shiftright(size, drop), drop)")


def sharded_rows(
    docs: DataFrame, key: str = "doc_id", text: str = "text", dimensions: tuple[str, ...] = ("source", "lang"),
    shards: int = SHARDS, bits: int = BITS, rows: bool = True,
) -> DataFrame:
    """Columns row (the document, if ``rows``), key, size, text_crc32, curve, shard, slot.

    Dimensions are the given columns and the size of the text.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    names = {f"d{i}": F.col(d) for i, d in enumerate(dimensions)}
    held = docs.select(
        *([F.struct("*").alias("row")] if rows else []), F.col(key).alias("key"),
        (F.octet_length(body).cast("long") + 1).alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
        *[c.alias(n) for n, c in names.items()],
    )
    drop = F.greatest(F.length(F.bin("size")) - SIZE_BITS, F.lit(0)).cast("int")
    held = held.withColumn("drop", drop)
    held = held.withColumn("size_class", _rounded_size(F.col("size"))).drop("drop")
    cells = []
    for d in [*names, "size_class"]:
        found = cells_of(held, d, bits)
        held = held.join(found, F.col(d).eqNullSafe(F.col("value")), "left").drop("value", d)
        cells.append(f"{d}_cell")

    @F.pandas_udf("long")
    def curve(points: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index(points.to_numpy(), bits))

    held = held.withColumn("curve", curve(F.struct(*cells))).drop(*cells)
    held = held.withColumn("number", F.monotonically_increasing_id())
    order = ["curve", "text_crc32", F.col("key").asc_nulls_first(), "number"]
    ordered = held.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    placed = with_position(ordered.drop("number"), "position")
    total = max(placed.count(), 1)
    cut = placed.withColumn("shard", F.expr(f"CAST((position - 1) * {shards} DIV {total} AS INT)"))
    return cut.withColumn("slot", F.expr(f"position - 1 - (shard * {total} + {shards - 1}) DIV {shards}")).drop("position")


def write_shards(docs: DataFrame, folder: str, **options) -> None:
    """Write the documents in curve order, a folder per shard; Parquet footers then let readers skip files."""
    placed = sharded_rows(docs, **options).select("row.*", F.col("shard").alias("_shard"), F.col("slot").alias("_slot"))
    spread = placed.repartitionByRange(partitions(docs.sparkSession), "_shard", "_slot")
    spread.sortWithinPartitions("_shard", "_slot").drop("_slot").write.partitionBy("_shard").parquet(folder)


def report(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document: key, size, text_crc32, law, shard, slot, grown_shard."""
    placed = sharded_rows(docs, key, rows=False)
    return placed.select(
        F.col("key").alias(key), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
