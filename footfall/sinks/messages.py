"""Message output."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_messages(messages: DataFrame, format: str, **options: str) -> None:
    """Append column ``value`` to a topic (``kafka``) or to text files (``text``)."""
    messages.select("value").write.format(format).options(**options).mode("append").save()
