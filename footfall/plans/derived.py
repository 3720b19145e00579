"""Log lines, orders, cells and products derived from the warehouse tables.

Everything here is a row-by-row projection of a whole table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions.clock import second_digits
from footfall.operators.cells import to_cells
from footfall.schemas import CELL_SCHEMA

# One user agent each of a suffixed browser, a plain browser, a system agent, a crawler and an HTTP library.
USER_AGENTS = (
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) "
    "Chrome/96.0.4664.45 Safari/537.36 SE 2.X MetaSr 1.0",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/537.36 (KHTML, like Gecko) "
    "Chrome/120.0.6099.71 Safari/537.36",
    "swcd (unknown version) CFNetwork/1331.0.7 Darwin/21.4.0",
    "Mozilla/5.0 (compatible; examplebot/2.1; +http://bot.example.org/about)",
    "Go-http-client/2.0",
)

MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def _pick(values: tuple[str, ...], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"get(array({listed}), CAST({index} AS INT))"


def access_lines(spark: SparkSession, sf_dir: str, which: str = "TRUE") -> DataFrame:
    """One access-log line per event (or per event of which ``which`` holds), in column ``value``."""
    # d reads yyyyMMddHHmmss
    rows = events(spark, sf_dir).where(which).withColumns({"d": second_digits(F.col("ts")), "k": _k()})
    month = _pick(MONTHS, "substr(d, 5, 2) - 1")
    time = f"substr(d, 7, 2), '/', {month}, '/', substr(d, 1, 4), ':'"
    clock = "substr(d, 9, 2), ':', substr(d, 11, 2), ':', substr(d, 13, 2)"
    fields = rows.selectExpr(
        "concat('10.', (user_id * 37) % 200, '.', user_id % 256, '.1') AS ip",
        f"concat('[', {time}, {clock}, ' +0000]') AS time",
        "concat('GET /', event_type, '/', k % 2, ' HTTP/1.1') AS request",
        "CASE WHEN event_type = 'error' THEN '404' ELSE '200' END AS status",
        "event_id % 5000 AS sent",
        "CASE WHEN user_id % 3 = 0 THEN '-' ELSE concat('https://www.example.com/', event_type) END AS referer",
        f"{_pick(USER_AGENTS, f'user_id % {len(USER_AGENTS)}')} AS ua",
    )
    return fields.selectExpr(
        "concat(ip, ' - - ', time, ' \"', request, '\" ', status, ' ', sent, ' \"www.example.com\" \"', referer, "
        "'\" - \"', ua, '\" \"-\" 10.100.0.1:80 ', status, ' 0.001 0.001') AS value"
    )


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One range of eight /16 blocks per nation."""
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    key = F.col("n_nationkey").cast("bigint")
    start = F.lit(10 << 24) + key * (8 * 65536)
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        start.alias("lo"),
        (start + (8 * 65536 - 1)).alias("hi"),
        F.col("r_name").alias("country"),
        F.col("n_name").alias("province"),
        F.concat(F.lit("CITY_"), F.col("n_nationkey")).alias("city"),
    )


def visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An address per event: every third of IPv6, some that are none."""
    place, host = "(user_id * 37) % 200", "user_id % 256"
    v6 = f"concat('2001:DB8:', hex({place}), '::', lower(hex({host})), ':1')"
    ip = f"CASE WHEN event_id % 101 = 0 THEN '10.1.2' WHEN event_id % 3 = 0 THEN {v6} ELSE concat('10.', {place}, '.', {host}, '.1') END"
    return events(spark, sf_dir).selectExpr("event_id", f"{ip} AS ip")


def nested_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each family: one range of all, one for each nation in it, and one of some hosts in each nation's."""
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    named = nations.join(regions, F.col("n_nationkey").isNotNull() & (F.col("n_regionkey") == F.col("r_regionkey")))
    k = "CAST(n_nationkey AS BIGINT) * 8"
    own = "r_name AS country, n_name AS province, concat('CITY_', n_nationkey) AS city"
    inner = "r_name AS country, n_name AS province, concat('INNER_', n_nationkey) AS city"
    full = ":ffff:ffff:ffff:ffff:ffff"
    parts = [
        named.selectExpr(f"concat('10.', {k}, '.0.0') AS lo", f"concat('10.', {k} + 7, '.255.255') AS hi", *own.split(", ", 2)),
        named.selectExpr(f"concat('10.', {k} + 1, '.0.0') AS lo", f"concat('10.', {k} + 1, '.127.255') AS hi", *inner.split(", ", 2)),
        named.selectExpr(f"concat('2001:db8:', hex({k}), '::') AS lo", f"concat('2001:db8:', hex({k} + 7), '{full}') AS hi", *own.split(", ", 2)),
        named.selectExpr(f"concat('2001:db8:', hex({k} + 1), '::') AS lo", f"concat('2001:db8:', hex({k} + 1), '::7f:ffff') AS hi", *inner.split(", ", 2)),
        regions.where("r_regionkey = 0").selectExpr("'10.0.0.0' AS lo", "'10.255.255.255' AS hi", "'TEN' AS country", "'ALL' AS province", "'ALL' AS city"),
        regions.where("r_regionkey = 0").selectExpr("'2001:db8::' AS lo", f"'2001:db8:ffff{full}' AS hi", "'SIX' AS country", "'ALL' AS province", "'ALL' AS city"),
    ]
    return reduce(DataFrame.unionByName, parts)


def order_rows(rows: DataFrame) -> DataFrame:
    """Events as order rows, every field a string; purchases count as paid."""
    paid = F.when(F.col("event_type") == "purchase", F.lit("1")).otherwise(F.lit("0"))
    return rows.select(
        second_digits(F.col("ts")).alias("time"),
        F.col("user_id").cast("string").alias("userid"),
        (F.col("event_id") % 500).cast("string").alias("courseid"),
        _k().cast("string").alias("fee"),
        paid.alias("flag"),
        F.col("event_id").cast("string").alias("orderid"),
    )


def _customer_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("rowkey"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").cast("string").alias("acctbal"),
        F.col("c_nationkey").cast("string").alias("nationkey"),
        F.col("c_acctbal").alias("_balance"),
    )


def _supplier_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("rowkey"),
        F.lit(None).cast("string").alias("segment"),
        F.col("s_acctbal").cast("string").alias("acctbal"),
        F.col("s_nationkey").cast("string").alias("nationkey"),
    )


# acctbal is in both families, as two cells.
FAMILIES = {"info": ("segment", "acctbal"), "address": ("nationkey", "acctbal")}
CELL_COLUMNS = (("info", "segment"), ("info", "acctbal"), ("address", "nationkey"), ("address", "acctbal"))
CELL_NAMES = ("segment", "acctbal", "nationkey", "address_acctbal")


def wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers as keyed rows; suppliers have no segment."""
    customers = _customer_wide(spark, sf_dir).drop("_balance")
    return customers.unionByName(_supplier_wide(spark, sf_dir))


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_cells(wide_rows(spark, sf_dir), FAMILIES, ts=1)


def customer_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' cells; every third nation's customers also have an older version of their segment."""
    wide = _customer_wide(spark, sf_dir)
    older = wide.where(F.col("nationkey").cast("int") % 3 == 0).select("rowkey", F.lit("PROSPECT").alias("segment"))
    return to_cells(wide, FAMILIES, ts=1).unionByName(to_cells(older, {"info": ("segment",)}, ts=0))


def cell_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later put: overdrawn customers go on hold, and all suppliers are added."""
    overdrawn = _customer_wide(spark, sf_dir).where(F.col("_balance") < 0)
    hold = overdrawn.select("rowkey", F.lit("ON_HOLD").alias("segment"))
    updates = to_cells(hold, {"info": ("segment",)}, ts=2)
    added = to_cells(_supplier_wide(spark, sf_dir), FAMILIES, ts=2)
    return updates.unionByName(added).select(*CELL_SCHEMA.names)


def later_changes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two more puts: a newer one renames the segment of all customers of nation 3, a late one brings old values."""
    wide = _customer_wide(spark, sf_dir)
    renamed = wide.where("nationkey = '3'").select("rowkey", F.lit("RENAMED").alias("segment"))
    outdated = _supplier_wide(spark, sf_dir).select("rowkey", F.lit("0").alias("acctbal"), F.lit("-").alias("segment"))
    first = to_cells(renamed, {"info": ("segment",)}, ts=3)
    return first, to_cells(outdated, {"info": ("acctbal", "segment")}, ts=1)


def product_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as ``name price store`` text beside their key; blanks in names become ``_``."""
    name = F.translate("p_name", " ", "_")
    price = F.floor("p_retailprice").cast("string")
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(name, F.lit("  "), price, F.lit(" "), F.col("p_size").cast("string")).alias("value")
    )
