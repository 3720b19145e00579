"""IP range lookup for both address families and for ranges that lie in each other.

Addresses are keys of 32 hexadecimal digits (``net.ip_key``; IPv4 as the mapped IPv6 address), so order and prefixes of
the text are those of the address. Of the ranges that hold an address the one counts that begins last, and of those the
one that ends first: among nested ranges, the innermost.

The ranges are cut along blocks, which are prefixes of the key: /16 and /24 of IPv4, /16, /32, /48 and /64 of IPv6. A
block in which more than ``DENSE`` ranges begin or end is cut into the next finer ones, so a row meets few candidates
however unevenly ranges lie. Inside a block the ranges are flattened: at every place where one begins or ends, the range
that counts there is looked up. What is left lies side by side, and a row
matches one piece at most.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions.net import V4_PREFIX, ip_key
from footfall.functions.sizes import measured_bytes
from footfall.operators.geo import with_geo
from footfall.schemas import GEO_COLUMNS
from footfall.session import materialize

DENSE = 256
# Digits of the blocks' prefixes, coarse to fine.
V4_BLOCKS, V6_BLOCKS = (28, 30), (4, 8, 12, 16)


def _is_v4(key: str) -> Column:
    return F.col(key).startswith(V4_PREFIX)


def _prefix(key: str, level: int) -> Column:
    """The block of a key at a level; of IPv4 the finest from the last level on."""
    v4, v6 = (F.substring(key, 1, lens[min(level, len(lens) - 1)]) for lens in (V4_BLOCKS, V6_BLOCKS))
    return F.when(_is_v4(key), v4).otherwise(v6)


def keyed_ranges(ranges: DataFrame) -> DataFrame:
    """(lo, hi, names) with keys for bounds, given as address text. Refuses ranges that cannot be read.

    An IPv6 range that holds the mapped IPv4 addresses besides others is cut in three, as blocks are of one family.
    """
    rows = ranges.select(ip_key("lo").alias("lo"), ip_key("hi").alias("hi"), *GEO_COLUMNS)
    broken = rows.where(F.col("lo").isNull() | F.col("hi").isNull() | (F.col("lo") > F.col("hi"))).count()
    if broken:
        raise ValueError(f"range table has {broken} ranges without two addresses in order")
    first, last = V4_PREFIX + "0" * 8, V4_PREFIX + "f" * 8
    before = f"{int(first, 16) - 1:032x}"
    after = f"{int(last, 16) + 1:032x}"
    part = lambda lo, hi: F.struct(F.greatest("lo", F.lit(lo)).alias("lo"), F.least("hi", F.lit(hi)).alias("hi"))
    parts = F.array(part("0" * 32, before), part(first, last), part(after, "f" * 32))
    cut = rows.select(F.explode(parts).alias("p"), *GEO_COLUMNS)
    return cut.select("p.lo", "p.hi", *GEO_COLUMNS).where("lo <= hi")


def _cut(rows: DataFrame, level: int) -> DataFrame:
    """Rows (lo, hi, ...) that lie in one block of the level before, repeated for each block of this level they meet."""
    stop = F.when(_is_v4("lo"), V4_BLOCKS[min(level, 1)]).otherwise(V6_BLOCKS[level])
    start = F.when(_is_v4("lo"), len(V4_PREFIX) if level == 0 else V4_BLOCKS[0]).otherwise(V6_BLOCKS[level] - 4)
    number = lambda c: F.conv(F.expr(f"substring({c}, start_ + 1, stop_ - start_)"), 16, 10).cast("int")
    cut = rows.withColumns({"stop_": stop, "start_": start}).withColumn("n_", F.explode(F.sequence(number("lo"), number("hi"))))
    block = F.concat(F.expr("substring(lo, 1, start_)"), F.expr("lpad(lower(hex(n_)), stop_ - start_, '0')"))
    cut = cut.withColumn("block", block).drop("stop_", "start_", "n_")
    low, high = F.rpad("block", 32, "0"), F.rpad("block", 32, "f")
    return cut.withColumns({"lo": F.greatest("lo", low), "hi": F.least("hi", high)})


def _covers() -> Column:
    """Whether a cut range holds its whole block."""
    return (F.col("lo") == F.rpad("block", 32, "0")) & (F.col("hi") == F.rpad("block", 32, "f"))


# The greatest of these is the range that counts: the digits of its end are turned round.
_RANK = ("first", "turned", *GEO_COLUMNS)


def _with_one_cover(cut: DataFrame) -> DataFrame:
    """Without the ranges that hold a whole block and count nowhere in it, as another one does that holds it too."""
    covers = cut.where(_covers()).groupBy("block", "lo", "hi").agg(F.max(F.struct(*_RANK, "last")).alias("r"))
    columns = [F.col("r.last") if c == "last" else F.col(f"r.{c}") if c in _RANK else F.col(c) for c in cut.columns]
    return cut.where(~_covers()).unionByName(covers.select(*columns))


def blocked(ranges: DataFrame, dense: int) -> tuple[DataFrame, list[DataFrame]]:
    """(lo, hi, first, last, names, block): ranges cut to blocks, first and last being their own bounds; and the blocks of
    each level that had to be cut finer."""
    turned = F.translate("hi", "0123456789abcdef", "fedcba9876543210")
    todo, settled, crowded = ranges.withColumns({"first": F.col("lo"), "last": F.col("hi"), "turned": turned}), [], []
    for level, digits in enumerate(V6_BLOCKS):
        cut = _with_one_cover(_cut(todo, level))
        v4 = F.col("block").startswith(V4_PREFIX)
        finest = F.when(v4, F.length("block") == V4_BLOCKS[-1]).otherwise(F.lit(digits == V6_BLOCKS[-1]))
        # A range that holds the whole block would hold all finer ones, too.
        counts = cut.groupBy("block").agg(F.count_if(~_covers()).alias("n"))
        full = materialize(counts.where((F.col("n") > dense) & ~finest).select("block"), "dense_blocks")
        if full.isEmpty():
            settled.append(cut)
            break
        # A block is full only with more than ``dense`` ranges, so these are few beside the ranges.
        settled.append(cut.join(F.broadcast(full), "block", "left_anti"))
        crowded.append(full)
        todo = cut.join(F.broadcast(full), "block", "left_semi").drop("block")
    return reduce(DataFrame.unionByName, settled), crowded


def flattened(cut: DataFrame) -> DataFrame:
    """(block, start, stop, names): pieces side by side. A key x lies in one if start <= x followed by 0 < stop.

    A range begins at its first key followed by 0 and ends at its last key followed by 1, so no key needs a successor.
    """
    begins, ends = F.concat("lo", F.lit("0")).alias("begins"), F.concat("hi", F.lit("1")).alias("ends")
    held = cut.groupBy("block").agg(F.collect_set(F.struct(*_RANK, begins, ends)).alias("held"))
    points = F.concat(F.transform("held", lambda r: r["begins"]), F.transform("held", lambda r: r["ends"]))
    held = held.withColumn("points", F.array_sort(F.array_distinct(points)))
    rows = held.select("block", "held", "points", F.posexplode("points").alias("at", "start"))
    rows = rows.select("block", "start", F.get("points", F.col("at") + 1).alias("stop"), F.expr(
        "array_max(filter(held, r -> r.begins <= start AND r.ends > start))"
    ).alias("r"))
    return rows.where("r IS NOT NULL").select("block", "start", "stop", *[F.col(f"r.{c}").alias(c) for c in GEO_COLUMNS])


def with_geo_nested(
    rows: DataFrame, ranges: DataFrame, ip: str = "ip", unknown: str | None = "unknown", broadcast_bytes: int = 128 << 20,
    salts: int = 32, dense: int = DENSE,
) -> DataFrame:
    """Add country, province and city of the range that counts for each address, IPv4 or IPv6.

    ``ranges`` has lo and hi (address text, both inclusive) and the names; ranges may lie in or across each other, and
    ranges with the same bounds count once, with the greatest names. Rows without a range, or without a readable
    address, keep ``unknown``. As in ``geo.with_geo`` the pieces are broadcast while their measured size stays under
    ``broadcast_bytes``; beyond it both sides shuffle on (block, salt), which shares a busy address among ``salts`` tasks.
    """
    cut, crowded = blocked(keyed_ranges(ranges), dense)
    pieces = materialize(flattened(cut), "geo_pieces")
    own = rows.columns
    keyed = rows.withColumn("_ip", ip_key(ip)).withColumn("_block", _prefix("_ip", 0))
    for level, full in enumerate(crowded):
        marks = full.select(F.col("block").alias("_full"))
        keyed = keyed.join(F.broadcast(marks), F.col("_block") == F.col("_full"), "left")
        finer = F.when(F.col("_full").isNotNull(), _prefix("_ip", level + 1)).otherwise(F.col("_block"))
        keyed = keyed.withColumn("_block", finer).drop("_full")
    keyed = keyed.withColumn("_at", F.concat("_ip", F.lit("0")))
    lookup = pieces.select("block", F.col("start").alias("_start"), F.col("stop").alias("_stop"), *[F.col(c).alias(f"_{c}") for c in GEO_COLUMNS])
    match = (F.col("_block") == F.col("block")) & (F.col("_start") <= F.col("_at")) & (F.col("_at") < F.col("_stop"))
    if measured_bytes(pieces, *pieces.columns) <= broadcast_bytes:
        lookup = F.broadcast(lookup)
    else:
        # The salt does not decide the result, so a retried task may number its rows anew.
        keyed = keyed.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
        lookup = lookup.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        lookup = lookup.hint("merge")
        match = match & (F.col("_salt") == F.col("_copy"))
    joined = keyed.join(lookup, match, "left")
    names = [F.col(f"_{c}") if unknown is None else F.coalesce(f"_{c}", F.lit(unknown)) for c in GEO_COLUMNS]
    return joined.select(*own, *[n.alias(c) for n, c in zip(names, GEO_COLUMNS)])


def located(rows: DataFrame, ranges: DataFrame, **options) -> DataFrame:
    """``with_geo_nested`` for ranges with address text, ``with_geo`` for those with IPv4 numbers."""
    text = dict(ranges.dtypes)["lo"] == "string"
    return (with_geo_nested if text else with_geo)(rows, ranges, **options)
