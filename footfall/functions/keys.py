"""Row keys of visits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_key(day: Column, *parts: Column, digest: str = "crc32") -> Column:
    """``<day>_<digest of the joined parts>``.

    A null part counts as the text ``null``. ``crc32`` keeps existing keys; being 32
    bits wide it merges about n*n/2^33 unrelated visits a day, which ``sha2`` avoids.
    """
    text = F.concat(*[F.coalesce(p, F.lit("null")) for p in parts])
    if digest == "crc32":
        code = F.crc32(text).cast("string")
    elif digest == "sha2":
        code = F.sha2(text, 256)
    else:
        raise ValueError(f"unknown digest {digest!r}; use 'crc32' or 'sha2'")
    return F.concat(day, F.lit("_"), code)


def visit_key(day: Column, digest: str = "crc32") -> Column:
    """Key of a parsed log row: same client, page and referer on one day share a key."""
    return row_key(day, F.col("referer"), F.col("url"), F.col("ip"), F.col("ua"), digest=digest)


def region_of(key: str, bounds: list[str]) -> Column:
    """How many of the ascending bounds are at most the key, by binary search: 0 to their number; 0 for a null key."""
    if not bounds:
        return F.lit(0)
    listed = F.lit(bounds)

    def step(at: Column, _: Column) -> Column:
        middle = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        below = F.coalesce(F.element_at(listed, F.least(middle, F.lit(len(bounds) - 1)) + 1) <= F.col(key), F.lit(False))
        return F.struct(
            F.when((at["lo"] < at["hi"]) & below, middle + 1).otherwise(at["lo"]).alias("lo"),
            F.when((at["lo"] < at["hi"]) & ~below, middle).otherwise(at["hi"]).alias("hi"),
        )

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(len(bounds).bit_length() + 1)), start, step, lambda at: at["lo"])
