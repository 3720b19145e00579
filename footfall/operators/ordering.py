"""Global orders without a single sorting task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.session import materialize

# monotonically_increasing_id puts the partition above bit 33 and the row below it.
ROW_BITS = 33


def sort_products(products: DataFrame, *tie_break: Column) -> DataFrame:
    """Dearest first; equal prices by larger stock."""
    return products.orderBy(F.col("price").desc(), F.col("store").desc(), *tie_break)


def sort_products_by_price(products: DataFrame, *tie_break: Column) -> DataFrame:
    """Dearest first, whatever the stock."""
    return products.orderBy(F.col("price").desc(), *tie_break)


def with_position(ordered: DataFrame, name: str = "position") -> DataFrame:
    """Number the rows of a globally sorted DataFrame 1, 2, 3, …

    ``row_number`` over an unpartitioned window would bring every row into one task.
    Here the sorted rows are stored once with their place inside their range; what is
    left is to add the sizes of the earlier ranges, one small row per range.
    """
    stamped = ordered.withColumn("_id", F.monotonically_increasing_id())
    stored = materialize(stamped, "sorted")
    part = F.shiftright("_id", ROW_BITS)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per sort partition, so this window and the broadcast stay small.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + 1
    joined = stored.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return joined.select(*ordered.columns, (F.col("_before") + place).alias(name))
