"""Access-log text to rows.

A line reads: ip identity user [time zone] "method url protocal" status bytes "host"
"referer" - "ua" and a tail that is not used. Servers escape quotes inside a field, so
the quotes cut nearly every line at the same places. Two rounds of splitting, at the
quotes and then at the blanks, cost about a quarter of one ``regexp_extract`` per field;
the rare line that does not fall apart this way is judged by the pattern.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.clock import log_instant, minute_digits, wall_clock
from footfall.functions.keys import visit_key
from footfall.schemas import LINE_FIELDS

REJECT_COLUMNS = ("value", "reject_reason")


def day_path(root: str, day: str) -> str:
    """Glob over one day's log files."""
    return f"{root.rstrip('/')}/{day}/*"


def read_lines(spark: SparkSession, root: str, day: str) -> DataFrame:
    """Raw lines of one day in column ``value``."""
    return spark.read.text(day_path(root, day))


# The line layout. It decides about every line that the cheaper cut does not settle, such
# as one with a raw quote in its address.
LINE_PATTERN = (
    r'(?s)^(\S+) \S+ \S+ (\[[^\]]+\]) "(\S+) (\S+) ([^"]+)" '
    r'(\d{3}) (\d+|-) "([^"]*)" "([^"]*)" (?:- )?"([^"]*)".*$'
)

# When all of these hold, the pieces named in parse_lines are the fields.
# get() and not [], which fails on a short array: common parts are evaluated up front.
PLAIN = (
    "size(quoted) >= 9",
    "NOT contains(value, '\\n')",
    # Other white space where the pattern allows none; looked for in the two short pieces.
    *(f"NOT contains(get(quoted, {i}), '{blank}')" for i in (0, 1) for blank in (r"\t", r"\r", r"\u000b", r"\u000c")),
    # ip, identity, user, [time, zone], ""
    "size(head) = 6",
    "get(head, 0) <> '' AND get(head, 1) <> '' AND get(head, 2) <> ''",
    "startswith(get(head, 3), '[') AND endswith(get(head, 4), ']') AND get(head, 5) = ''",
    # method, url, protocal
    "size(request) = 3",
    "get(request, 0) <> '' AND get(request, 1) <> '' AND get(request, 2) <> ''",
    # "", status, bytes, ""
    "size(numbers) = 4",
    "get(numbers, 0) = '' AND get(numbers, 3) = ''",
    "length(get(numbers, 1)) = 3 AND translate(get(numbers, 1), '0123456789', '') = ''",
    "get(numbers, 2) <> '' AND (get(numbers, 2) = '-' OR translate(get(numbers, 2), '0123456789', '') = '')",
    "get(quoted, 4) = ' ' AND get(quoted, 6) IN (' ', ' - ')",
)

# In the order of LINE_FIELDS.
PIECES = (
    "get(head, 0)", "concat(get(head, 3), ' ', get(head, 4))", "get(request, 0)", "get(request, 1)", "get(request, 2)",
    "get(numbers, 1)", "get(numbers, 2)", "get(quoted, 3)", "get(quoted, 5)", "get(quoted, 7)",
)


# The pieces between quotes that hold several fields.
CUTS = (
    "split(get(quoted, 0), ' ') AS head",
    "split(get(quoted, 1), ' ', 3) AS request",
    "split(get(quoted, 2), ' ') AS numbers",
)


def by_pattern() -> str:
    """SQL: the fields by the layout pattern, or null. No field can hold a line break."""
    groups = "\\n".join(f"${i + 1}" for i in range(len(LINE_FIELDS)))
    cut = f"split(regexp_replace(value, r'{LINE_PATTERN}', '{groups}'), '\\n')"
    return f"CASE WHEN NOT contains(value, '\\n') AND size({cut}) = {len(LINE_FIELDS)} THEN {cut} END"


def parse_lines(lines: DataFrame, tz: str = "UTC") -> DataFrame:
    """Add the line's fields, ``formattime`` and ``reject_reason`` to column ``value``.

    A good row has a null ``reject_reason``; a bad one says why, has null fields and
    keeps its text, so one damaged line never fails the job.
    """
    pieces = lines.selectExpr("value", "split(value, '\"') AS quoted").selectExpr("value", "quoted", *CUTS)
    judged = pieces.withColumn("plain", F.expr(f"coalesce({' AND '.join(PLAIN)}, false)"))
    cut = judged.selectExpr(
        "value", f"CASE WHEN plain THEN array({', '.join(PIECES)}) ELSE {by_pattern()} END AS fields"
    )
    walled = cut.withColumn("wall", wall_clock(log_instant(F.expr("get(fields, 1)")), tz))
    stamped = walled.withColumn("formattime", minute_digits(F.col("wall")))
    named = ", ".join(f"'{name}', get(fields, {i})" for i, name in enumerate(LINE_FIELDS))
    row = f"CASE WHEN formattime IS NOT NULL THEN named_struct({named}, 'formattime', formattime) END"
    reason = "CASE WHEN fields IS NULL THEN 'layout' WHEN formattime IS NULL THEN 'time' END"
    # explode of a one-element array: as plain projections all of the above would be
    # repeated inside every filter that a caller adds.
    whole = stamped.selectExpr("value", f"explode(array(named_struct('row', {row}, 'reason', {reason}))) AS cut")
    return whole.selectExpr("value", "cut.row.*", "cut.reason AS reject_reason")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNull()).drop(*REJECT_COLUMNS)


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNotNull()).select(*REJECT_COLUMNS)


def with_key(rows: DataFrame, day: str | None = None, digest: str = "crc32") -> DataFrame:
    """Add ``day`` and ``rowkey``. Without ``day`` each row's own day is taken."""
    value = F.substring("formattime", 1, 8) if day is None else F.lit(day)
    return rows.withColumn("day", value).withColumn("rowkey", visit_key(F.col("day"), digest))


def typed_view(rows: DataFrame) -> DataFrame:
    """``status`` and ``bytessent`` as numbers; ``-`` becomes null."""
    return rows.withColumns(
        {
            "status": F.col("status").try_cast("int"),
            "bytessent": F.col("bytessent").try_cast("bigint"),
        }
    )
