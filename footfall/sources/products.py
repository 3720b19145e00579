"""Product lines: ``name price store`` separated by blanks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_products(lines: DataFrame) -> DataFrame:
    """Replace column ``value`` by name, price and store; other columns stay.

    Any run of blanks separates, so a doubled blank does not shift the fields.
    """
    parts = F.split(F.trim("value"), r"\s+")
    return lines.withColumns(
        {
            "name": F.get(parts, F.lit(0)),
            "price": F.get(parts, F.lit(1)).try_cast("int"),
            "store": F.get(parts, F.lit(2)).try_cast("int"),
        }
    ).drop("value")
