"""Time text in and out, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the layout of a log line's time field.
LOG_TIME_PATTERN = "dd/MMM/yyyy:HH:mm:ss Z"


def between_brackets(text: Column) -> Column:
    """Text from the first ``[`` up to the last ``]``; empty when either is missing."""
    return F.regexp_extract(text, r"\[(.*)\]", 1)


def log_instant(text: Column) -> Column:
    """Bracketed log time as a timestamp, or null when it cannot be read."""
    return F.try_to_timestamp(between_brackets(text), F.lit(LOG_TIME_PATTERN))


def wall_clock(instant: Column, tz: str) -> Column:
    """What a clock in ``tz`` shows at ``instant``, as a zone-less timestamp.

    A cast to TIMESTAMP_NTZ would read the session zone instead.
    """
    seconds = F.unix_seconds(F.from_utc_timestamp(instant, tz))
    return F.timestamp_add("SECOND", seconds, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def minute_digits(wall: Column) -> Column:
    """``yyyyMMddHHmm`` of a zone-less timestamp.

    Digits by arithmetic: date_format would go through the session zone, and casting
    to string and trimming costs about three times as much per row.
    """
    number = (
        F.year(wall) * F.lit(100_000_000).cast("bigint")
        + F.month(wall) * F.lit(1_000_000)
        + F.day(wall) * F.lit(10_000)
        + F.hour(wall) * F.lit(100)
        + F.minute(wall)
    )
    return F.lpad(number.cast("string"), 12, "0")


def second_digits(wall: Column) -> Column:
    """``yyyyMMddHHmmss`` of a zone-less timestamp."""
    seconds = F.second(wall).cast("string")
    return F.concat(minute_digits(wall), F.lpad(seconds, 2, "0"))


def format_time(text: Column, tz: str = "UTC") -> Column:
    """Bracketed log time as ``yyyyMMddHHmm`` in ``tz``; null when unreadable."""
    return minute_digits(wall_clock(log_instant(text), tz))


def order_day(text: Column) -> Column:
    return F.substring(text, 1, 8)


def order_hour(text: Column) -> Column:
    return F.substring(text, 9, 2)


def order_minute(text: Column) -> Column:
    return F.substring(text, 11, 2)


def is_minute(text: Column) -> Column:
    """Whether the text starts with twelve digits that are a minute of the calendar; false for null.

    By arithmetic: reading the text as a timestamp costs several times as much per order.
    """
    head = F.substring(text, 1, 12)
    digits = (F.length(head) == 12) & (F.translate(head, "0123456789", "") == "")
    year, month, day, hour, minute = (F.substring(text, at, n).try_cast("int") for at, n in ((1, 4), (5, 2), (7, 2), (9, 2), (11, 2)))
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    days = F.when(month.isin(4, 6, 9, 11), 30).when(month != 2, 31).when(leap, 29).otherwise(28)
    real = month.between(1, 12) & (day >= 1) & (day <= days) & (hour <= 23) & (minute <= 59)
    return F.coalesce(digits & real, F.lit(False))
