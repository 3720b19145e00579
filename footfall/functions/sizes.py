"""Sizes of tables as a broadcast would hold them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Per row of a broadcast hash table, beside the text itself.
ROW_OVERHEAD = 96


def row_bytes(*columns: str) -> Column:
    """What a row with these text columns takes in a broadcast hash table."""
    texts = [F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint") for c in columns]
    return reduce(lambda a, b: a + b, texts, F.lit(ROW_OVERHEAD).cast("bigint"))


def measured_bytes(rows: DataFrame, *columns: str) -> int:
    """The rows' size by ``row_bytes``; runs a job over these columns."""
    return rows.agg(F.coalesce(F.sum(row_bytes(*columns)), F.lit(0))).first()[0]
