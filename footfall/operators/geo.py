"""IP range lookup.

Ranges are cut along aligned blocks of the address space, so the range condition
becomes an equality on the block plus a residual ``between`` and Spark can hash it. A
block is a /16 unless more than ``DENSE`` ranges fall into it; then it is a /24, where
at most 256 disjoint ranges fit. So no address meets more than 256 candidates, however
unevenly the ranges lie.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.net import ip_number
from footfall.functions.sizes import row_bytes
from footfall.schemas import GEO_COLUMNS

DENSE = 256
FINE_OFFSET = 1 << 32  # keeps /24 block numbers apart from /16 ones


@dataclass(frozen=True)
class RangeProfile:
    blocks: int
    bytes: int
    densest: int
    broken: int
    overlaps: int


def _coarse_blocks(ranges: DataFrame) -> DataFrame:
    blocks = F.sequence(F.shiftright("lo", 16), F.shiftright("hi", 16))
    return ranges.select("*", F.explode(blocks).alias("block"))


def profile(ranges: DataFrame) -> RangeProfile:
    """Size, density and faults of a range table, in one job over the ranges only."""
    sound = (F.col("lo") >= 0) & (F.col("lo") <= F.col("hi")) & (F.col("hi") < FINE_OFFSET)
    # A broken range gets the null block, where it is only counted.
    blocks = F.when(sound, F.sequence(F.shiftright("lo", 16), F.shiftright("hi", 16)))
    cut = ranges.select(
        "lo",
        "hi",
        row_bytes(*GEO_COLUMNS).alias("bytes"),
        F.explode_outer(blocks).alias("block"),
    )
    # Two ranges that overlap share a block, so looking inside the blocks is enough.
    before = Window.partitionBy("block").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    seen = cut.withColumn("overlap", F.max("hi").over(before) >= F.col("lo"))
    per_block = seen.groupBy("block").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("bytes").alias("bytes"),
        F.sum(F.col("overlap").cast("bigint")).alias("overlaps"),
    )

    good, bad = F.col("block").isNotNull(), F.col("block").isNull()
    measures = {
        "blocks": F.sum(F.when(good, F.col("n"))),
        "bytes": F.sum(F.when(good, F.col("bytes"))),
        "densest": F.max(F.when(good, F.col("n"))),
        "broken": F.sum(F.when(bad, F.col("n"))),
        "overlaps": F.sum(F.when(good, F.col("overlaps"))),
    }
    row = per_block.agg(*[F.coalesce(m, F.lit(0)).alias(n) for n, m in measures.items()]).first()
    return RangeProfile(**row.asDict())


def _dense_blocks(ranges: DataFrame) -> DataFrame:
    """/16 blocks that need the finer cut; at most 65,536 rows by construction."""
    counted = _coarse_blocks(ranges).groupBy("block").count()
    return counted.where(F.col("count") > DENSE).select("block")


def _lookup(ranges: DataFrame, dense: DataFrame | None) -> DataFrame:
    columns = (F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), *GEO_COLUMNS)
    coarse = _coarse_blocks(ranges)
    if dense is None:
        return coarse.select(F.col("block").alias("_near"), *columns)
    plain = coarse.join(F.broadcast(dense), "block", "left_anti").select(F.col("block").alias("_near"), *columns)
    start = F.shiftleft("block", 16)
    first = F.shiftright(F.greatest("lo", start), 8)
    last = F.shiftright(F.least("hi", start + 65535), 8)
    cut = coarse.join(F.broadcast(dense), "block", "left_semi").withColumn("_fine", F.explode(F.sequence(first, last)))
    fine = cut.select((F.col("_fine") + F.lit(FINE_OFFSET)).alias("_near"), *columns)
    return plain.unionByName(fine)


def with_geo(
    rows: DataFrame,
    ranges: DataFrame,
    ip: str = "ip",
    unknown: str | None = "unknown",
    broadcast_bytes: int = 128 << 20,
    salts: int = 32,
) -> DataFrame:
    """Add country, province and city of the range that holds each address.

    ``ranges`` has lo, hi (address numbers, both inclusive) and the three names; ranges
    must not overlap, since a row would then come out twice. Rows without a range keep
    ``unknown``. The ranges are broadcast while their measured size stays under
    ``broadcast_bytes``, so ``rows`` does not move at all; beyond it both sides shuffle
    on (block, salt) with the ranges repeated once per salt. The salt counts the rows of
    a task, so equal rows get different salts: one busy block, or one busy address, is
    shared by ``salts`` tasks. The ranges are profiled by a job when this is called.
    """
    ranges = ranges.select(F.col("lo").cast("bigint"), F.col("hi").cast("bigint"), *GEO_COLUMNS)
    facts = profile(ranges)
    if facts.broken or facts.overlaps:
        raise ValueError(f"range table has {facts.broken} broken and {facts.overlaps} overlapping ranges")

    own = rows.columns
    keyed = rows.withColumn("_ip", ip_number(ip))
    block = F.shiftright("_ip", 16)
    size = facts.bytes
    if facts.densest > DENSE:
        size *= 2  # the finer cut at most doubles the rows of a dense block
        dense = _dense_blocks(ranges)
        marks = dense.select(F.col("block").alias("_block"), F.lit(True).alias("_dense"))
        keyed = keyed.withColumn("_block", block).join(F.broadcast(marks), "_block", "left")
        fine = F.shiftright("_ip", 8) + F.lit(FINE_OFFSET)
        keyed = keyed.withColumn("_key", F.when(F.col("_dense"), fine).otherwise(F.col("_block")))
        lookup = _lookup(ranges, dense)
    else:
        keyed = keyed.withColumn("_key", block)
        lookup = _lookup(ranges, None)

    match = (F.col("_key") == F.col("_near")) & F.col("_ip").between(F.col("_lo"), F.col("_hi"))
    if size <= broadcast_bytes:
        lookup = F.broadcast(lookup)
    else:
        # The salt does not decide the result, so a retried task may number its rows anew.
        keyed = keyed.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
        lookup = lookup.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        match = match & (F.col("_salt") == F.col("_copy"))
    joined = keyed.join(lookup, match, "left")
    names = [F.col(c) if unknown is None else F.coalesce(c, F.lit(unknown)).alias(c) for c in GEO_COLUMNS]
    return joined.select(*own, *names)
