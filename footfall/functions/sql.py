"""The log's functions in SQL text, for reports that are written wholly in SQL.

``register`` defines them in a session, as SQL functions that Spark inlines: no Python runs when they are called.

- ``format_time(text, zone)``: the bracketed log time as yyyyMMddHHmm in a zone, null when unreadable;
- ``row_key(day, referer, url, ip, ua)``: the visit's key;
- ``access_log(zone)``: the rows of the view ``log_lines`` (column ``value``) with the line's fields, ``formattime`` and
  ``reject_reason``, as ``sources.access_log.parse_lines`` gives them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from footfall.functions.clock import LOG_TIME_PATTERN
from footfall.schemas import LINE_FIELDS
from footfall.sources import access_log

LINES = "log_lines"

_WALL = (
    "timestampadd(SECOND, unix_seconds(from_utc_timestamp(try_to_timestamp("
    f"regexp_extract(text, r'\\[(.*)\\]', 1), '{LOG_TIME_PATTERN}'), zone)), TIMESTAMP_NTZ '1970-01-01 00:00:00')"
)
_MINUTE = "year(w) * 100000000L + month(w) * 1000000 + day(w) * 10000 + hour(w) * 100 + minute(w)"
FORMAT_TIME = f"""
CREATE OR REPLACE TEMPORARY FUNCTION format_time(text STRING, zone STRING) RETURNS STRING
RETURN get(transform(array({_WALL}), w -> lpad(CAST({_MINUTE} AS STRING), 12, '0')), 0)"""

_PARTS = ", ".join(f"coalesce({c}, 'null')" for c in ("referer", "url", "ip", "ua"))
ROW_KEY = f"""
CREATE OR REPLACE TEMPORARY FUNCTION row_key(day STRING, referer STRING, url STRING, ip STRING, ua STRING) RETURNS STRING
RETURN concat(day, '_', CAST(crc32(CAST(concat({_PARTS}) AS BINARY)) AS STRING))"""

_FIELDS = ", ".join(f"CASE WHEN formattime IS NOT NULL THEN get(fields, {i}) END AS {name}" for i, name in enumerate(LINE_FIELDS))
_CUT = f"CASE WHEN plain THEN array({', '.join(access_log.PIECES)}) ELSE {access_log.by_pattern()} END"
# The explode of one keeps the line from being cut again for every use of a field.
ACCESS_LOG = f"""
CREATE OR REPLACE TEMPORARY FUNCTION access_log(zone STRING)
RETURNS TABLE (value STRING, {", ".join(f"{name} STRING" for name in LINE_FIELDS)}, formattime STRING, reject_reason STRING)
RETURN SELECT value, {_FIELDS}, formattime,
    CASE WHEN fields IS NULL THEN 'layout' WHEN formattime IS NULL THEN 'time' END
  FROM (SELECT value, cut.fields, format_time(get(cut.fields, 1), access_log.zone) AS formattime
    FROM (SELECT value, {_CUT} AS fields
      FROM (SELECT *, coalesce({" AND ".join(access_log.PLAIN)}, false) AS plain
        FROM (SELECT value, quoted, {", ".join(access_log.CUTS)}
          FROM (SELECT value, split(value, '"') AS quoted FROM {LINES}))))
    LATERAL VIEW explode(array(named_struct('fields', fields))) AS cut)"""


def register(spark: SparkSession, lines: DataFrame) -> None:
    """Define the functions in the session, ``access_log`` over these lines."""
    lines.select("value").createOrReplaceTempView(LINES)
    for function in (FORMAT_TIME, ROW_KEY, ACCESS_LOG):
        spark.sql(function)
