"""Order totals per day, hour and minute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.schemas import DAY_HASH_KEY, PAID_COUNT_KEY, PAID_FEE_KEY

GRAINS = {
    "day": ("day",),
    "hour": ("day", "hour"),
    "minute": ("day", "hour", "minute"),
}


def _measures() -> dict[str, Column]:
    """total, success and fee of a group. Unpaid orders (any flag but "1", null too) add
    zero, so a day without a paid order still gets its row."""
    paid = F.col("flag") == "1"
    return {
        "total": F.count(F.lit(1)),
        "success": F.sum(F.when(paid, 1).otherwise(0)),
        "fee": F.sum(F.when(paid, F.col("amount")).otherwise(0)),
    }


def order_stats(orders: DataFrame, grain: str, *also_by: Column) -> DataFrame:
    """total, success, fee per group of one grain.

    ``also_by`` adds group columns, such as the window that lets a watermark close groups.
    """
    return orders.groupBy(*also_by, *GRAINS[grain]).agg(*[m.alias(n) for n, m in _measures().items()])


def paid_count_per_day(orders: DataFrame) -> DataFrame:
    return orders.groupBy("day").agg(_measures()["success"].alias("success"))


def paid_fee_per_day(orders: DataFrame) -> DataFrame:
    return orders.groupBy("day").agg(_measures()["fee"].alias("fee"))


def roll_up(minutes: DataFrame) -> DataFrame:
    """Totals of all three grains, marked by ``grain``, from totals per minute."""
    sums = [F.sum(n).alias(n) for n in _measures()]
    sets = [list(columns) for columns in GRAINS.values()]
    rolled = minutes.groupingSets(sets, "day", "hour", "minute")
    # grouping_id has a bit for every column rolled away, minute being the lowest.
    level = F.grouping_id()
    grain = F.when(level == 0, "minute").when(level == 1, "hour").otherwise("day")
    return rolled.agg(grain.alias("grain"), *sums).select("grain", "day", "hour", "minute", *_measures())


def order_stats_all_grains(orders: DataFrame) -> DataFrame:
    """All three grains from one pass over the orders.

    Grouping sets multiply their input. Here that is the totals per minute, 1,440 rows
    a day at most, and not the orders.
    """
    return roll_up(order_stats(orders, "minute"))


def to_counters(day_totals: DataFrame) -> DataFrame:
    """Day totals as ``(key, value)``: paid count and paid amount of each day."""
    wide = day_totals.select("day", F.col("success").alias(PAID_COUNT_KEY), F.col("fee").alias(PAID_FEE_KEY))
    long = wide.unpivot("day", [PAID_COUNT_KEY, PAID_FEE_KEY], "prefix", "value")
    return long.select(F.concat("prefix", "day").alias("key"), "value")


def to_hash_fields(totals: DataFrame) -> DataFrame:
    """Day and hour totals as ``(key, field, value)``; an hour's fields end in its two digits."""
    kept = totals.where(F.col("grain").isin("day", "hour"))
    long = kept.unpivot(["day", "hour"], ["total", "success", "fee"], "measure", "value")
    return long.select(
        F.concat(F.lit(DAY_HASH_KEY), "day").alias("key"),
        F.concat("measure", F.coalesce("hour", F.lit(""))).alias("field"),
        "value",
    )
