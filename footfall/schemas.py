"""Row shapes shared by the sources, operators and sinks."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Fields cut out of one access-log line, in line order.
LINE_FIELDS = ("ip", "time", "method", "url", "protocal", "status", "bytessent", "host", "referer", "ua")

# The 15 columns stored per visit, in storage order.
VISIT_COLUMNS = (
    "ip", "country", "province", "city", "formattime",
    "method", "url", "protocal", "status", "bytessent",
    "referer", "browsername", "browserversion", "osname", "osversion",
)

GEO_COLUMNS = ("country", "province", "city")
AGENT_COLUMNS = ("browsername", "browserversion", "osname", "osversion")

# The columns of a parsed, located and classed log line.
LOG_COLUMNS = (
    "ip", "country", "province", "city", "time", "method", "url", "protocal", "status", "bytessent",
    "referer", "browsername", "browserversion", "osname", "osversion", "ua", "formattime",
)

VISIT_SCHEMA = _strings("rowkey", *VISIT_COLUMNS, "day")

# The fields of one order message; all of them travel as JSON strings.
ORDER_FIELDS = ("time", "userid", "courseid", "fee", "flag", "orderid")
ORDER_SCHEMA = _strings(*ORDER_FIELDS)

# Key prefixes under which downstream readers look the totals up.
PAID_COUNT_KEY = "ImoocCount-"
PAID_FEE_KEY = "ImoocFee-"
DAY_HASH_KEY = "Imooc-"

CELL_SCHEMA = T.StructType(
    [
        T.StructField("rowkey", T.StringType()),
        T.StructField("family", T.StringType()),
        T.StructField("qualifier", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("value", T.StringType()),
    ]
)

# cnt is 64-bit: a day of a 100 TB log passes 2^31 visits.
BROWSER_STAT_SCHEMA = T.StructType(
    [
        T.StructField("browser", T.StringType(), False),
        T.StructField("cnt", T.LongType()),
        T.StructField("day", T.StringType(), False),
    ]
)
REGION_STAT_SCHEMA = T.StructType(
    [
        T.StructField("country", T.StringType(), False),
        T.StructField("province", T.StringType(), False),
        T.StructField("cnt", T.LongType()),
        T.StructField("day", T.StringType(), False),
    ]
)

TOTALS_SCHEMA = T.StructType(
    [
        T.StructField("day", T.StringType()),
        T.StructField("hour", T.StringType()),
        T.StructField("minute", T.StringType()),
        T.StructField("total", T.LongType()),
        T.StructField("success", T.LongType()),
        T.StructField("fee", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
