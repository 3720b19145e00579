"""DuckDB twins of the named queries.

They compute the expected rows straight from the tables: no log line or JSON text is
built or parsed, places come from a plain range join, and CRC32 is spelled out.
"""

from __future__ import annotations

from footfall.plans.derived import USER_AGENTS

_AGENTS = ", ".join(f"'{ua}'" for ua in USER_AGENTS)

# Requests as they should come out of parsing, classing and locating.
_REQUESTS = f"""
base AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         10 * 16777216 + ((user_id * 37) % 200) * 65536 + (user_id % 256) * 256 + 1 AS ip_num
  FROM events),
places AS (
  SELECT 167772160 + n_nationkey * 8 * 65536 AS lo, 167772160 + (n_nationkey + 1) * 8 * 65536 - 1 AS hi,
         r_name AS country, n_name AS province, 'CITY_' || n_nationkey AS city
  FROM nation JOIN region ON n_regionkey = r_regionkey),
requests AS (
  SELECT '10.' || ((user_id * 37) % 200) || '.' || (user_id % 256) || '.1' AS ip,
         country, province, city,
         strftime(ts, '%Y%m%d%H%M') AS formattime,
         'GET' AS method,
         '/' || event_type || '/' || (k % 2) AS url,
         'HTTP/1.1' AS protocal,
         CASE WHEN event_type = 'error' THEN '404' ELSE '200' END AS status,
         CAST(event_id % 5000 AS VARCHAR) AS bytessent,
         CASE WHEN user_id % 3 = 0 THEN '-' ELSE 'https://www.example.com/' || event_type END AS referer,
         (['Sogou Explorer', 'Chrome', 'swcd', 'Crawler', 'Go-http-client'])[user_id % 5 + 1] AS browsername,
         (['2.X', '120.0.6099.71', 'unknown', '2.1', '2.0'])[user_id % 5 + 1] AS browserversion,
         (['Windows', 'Mac OS X', 'Darwin', 'unknown', 'unknown'])[user_id % 5 + 1] AS osname,
         (['10.0', '10_15_7', '21.4.0', 'unknown', 'unknown'])[user_id % 5 + 1] AS osversion,
         ([{_AGENTS}])[user_id % 5 + 1] AS ua,
         strftime(ts, '[%d/%b/%Y:%H:%M:%S +0000]') AS time,
         'www.example.com' AS host,
         strftime(ts, '%Y%m%d') AS day
  FROM base LEFT JOIN places ON ip_num BETWEEN lo AND hi)"""

# CRC32 with the reflected polynomial 0xEDB88320: eight steps per table entry, then
# one table look-up per byte.
_KEYS = """
crc_step(entry, step, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT entry, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
  FROM crc_step WHERE step < 8),
crc_table AS (SELECT list(c ORDER BY entry) AS t FROM crc_step WHERE step = 8),
texts AS (
  SELECT DISTINCT referer || url || ip || ua AS text, hex(encode(referer || url || ip || ua)) AS h FROM requests),
codes AS (
  SELECT text, xor(list_reduce(list_prepend(4294967295,
           list_transform(range(1, length(h), 2), lambda i: CAST('0x' || h[i:i + 1] AS BIGINT))),
           lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS code
  FROM texts, crc_table),
keyed AS (
  SELECT requests.*, day || '_' || code AS rowkey
  FROM requests JOIN codes ON text = referer || url || ip || ua)"""

_VISITS = """
visits AS (
  SELECT * EXCLUDE (n) FROM (
    SELECT *, row_number() OVER (PARTITION BY day, rowkey ORDER BY formattime DESC, ip DESC, method DESC, url DESC,
      protocal DESC, status DESC, bytessent DESC, referer DESC, browsername DESC, browserversion DESC, osname DESC,
      osversion DESC) AS n
    FROM keyed)
  WHERE n = 1)"""


def _on_requests(select: str) -> str:
    return f"WITH {_REQUESTS}\n{select}"


def _on_keyed(select: str) -> str:
    return f"WITH RECURSIVE {_REQUESTS}, {_KEYS}\n{select}"


def _on_visits(select: str) -> str:
    return f"WITH RECURSIVE {_REQUESTS}, {_KEYS}, {_VISITS}\n{select}"


_BARE = (
    "rowkey, formattime, ip, method, url, protocal, status, bytessent, referer, "
    "browsername, browserversion, osname, osversion, day"
)
_STORED = (
    "ip, country, province, city, formattime, method, url, protocal, status, bytessent, "
    "referer, browsername, browserversion, osname, osversion"
)

_VISIT_CELLS = (
    "SELECT rowkey, 'info' AS family, qualifier, CAST(1 AS BIGINT) AS ts, value "
    f"FROM (UNPIVOT (SELECT rowkey, {_STORED} FROM visits) ON {_STORED} INTO NAME qualifier VALUE value)"
)

_ORDERS = """
orders_in AS (
  SELECT strftime(ts, '%Y%m%d%H%M%S') AS time, CAST(user_id AS VARCHAR) AS userid,
         CAST(event_id % 500 AS VARCHAR) AS courseid, json_extract_string(props, '$.k') AS fee,
         CASE WHEN event_type = 'purchase' THEN '1' ELSE '0' END AS flag, CAST(event_id AS VARCHAR) AS orderid,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS amount,
         strftime(ts, '%Y%m%d') AS day, strftime(ts, '%H') AS hour, strftime(ts, '%M') AS minute
  FROM events)"""

_SUCCESS = "CAST(count(*) FILTER (flag = '1') AS BIGINT) AS success"
_FEE = "CAST(coalesce(sum(amount) FILTER (flag = '1'), 0) AS BIGINT) AS fee"
_MEASURES = f"count(*) AS total, {_SUCCESS}, {_FEE}"


def _on_orders(select: str) -> str:
    return f"WITH {_ORDERS}\n{select}"


def _stats(columns: str) -> str:
    return f"SELECT {columns}, {_MEASURES} FROM orders_in GROUP BY {columns}"


_ALL_GRAINS = f"""
SELECT 'day' AS grain, day, CAST(NULL AS VARCHAR) AS hour, CAST(NULL AS VARCHAR) AS minute, {_MEASURES}
FROM orders_in GROUP BY day
UNION ALL
SELECT 'hour', day, hour, NULL, {_MEASURES} FROM orders_in GROUP BY day, hour
UNION ALL
SELECT 'minute', day, hour, minute, {_MEASURES} FROM orders_in GROUP BY day, hour, minute"""

_COUNTERS = f"""
SELECT 'ImoocCount-' || day AS key, success AS value FROM ({_stats("day")})
UNION ALL
SELECT 'ImoocFee-' || day, fee FROM ({_stats("day")})"""

_HASH_FIELDS = " UNION ALL ".join(
    f"SELECT 'Imooc-' || day AS key, '{m}' AS field, {m} AS value FROM ({_stats('day')}) "
    f"UNION ALL SELECT 'Imooc-' || day, '{m}' || hour, {m} FROM ({_stats('day, hour')})"
    for m in ("total", "success", "fee")
)

_WIDE = """
wide AS (
  SELECT c_name AS rowkey, c_mktsegment AS segment, CAST(c_acctbal AS VARCHAR) AS acctbal,
         CAST(c_nationkey AS VARCHAR) AS nationkey, c_acctbal AS balance, 'customer' AS kind FROM customer
  UNION ALL
  SELECT s_name, NULL, CAST(s_acctbal AS VARCHAR), CAST(s_nationkey AS VARCHAR), s_acctbal, 'supplier' FROM supplier)"""


def _cells(source: str, ts: int) -> str:
    columns = [("segment", "info"), ("acctbal", "info"), ("nationkey", "address"), ("acctbal", "address")]
    return " UNION ALL ".join(
        f"SELECT rowkey, '{f}' AS family, '{q}' AS qualifier, CAST({ts} AS BIGINT) AS ts, {q} AS value "
        f"FROM {source} WHERE {q} IS NOT NULL"
        for q, f in columns
    )


def _on_wide(select: str) -> str:
    return f"WITH {_WIDE}\n{select}"


# Cells that a change names come out once, as changed here; all others with all their versions.
_UPSERTED = f"""
SELECT rowkey, family, qualifier, ts, value FROM ({_cells("(SELECT * FROM wide WHERE kind = 'customer')", 1)}
  UNION ALL SELECT rowkey, 'info', 'segment', 0, 'PROSPECT' FROM wide
  WHERE kind = 'customer' AND CAST(nationkey AS INTEGER) % 3 = 0)
WHERE qualifier <> 'segment' OR rowkey NOT IN (SELECT rowkey FROM wide WHERE kind = 'customer' AND balance < 0)
UNION ALL {_cells("(SELECT * FROM wide WHERE kind = 'supplier')", 2)}
UNION ALL SELECT rowkey, 'info', 'segment', 2, 'ON_HOLD' FROM wide WHERE kind = 'customer' AND balance < 0"""

# After two more puts: of each cell that any put names, the version with the newest stamp.
_PUTS = f"""
SELECT rowkey, family, qualifier, max(ts) AS ts, arg_max(value, ts) AS value FROM (
  SELECT rowkey, family, qualifier, ts, value FROM ({_UPSERTED})
  WHERE qualifier = 'segment' AND rowkey IN (SELECT rowkey FROM wide WHERE kind = 'customer' AND nationkey = '3')
  UNION ALL SELECT rowkey, 'info', 'segment', 3, 'RENAMED' FROM wide WHERE kind = 'customer' AND nationkey = '3'
  UNION ALL SELECT * FROM ({_cells("(SELECT * FROM wide WHERE kind = 'supplier')", 2)})
  UNION ALL SELECT rowkey, 'info', 'acctbal', 1, '0' FROM wide WHERE kind = 'supplier'
  UNION ALL SELECT rowkey, 'info', 'segment', 1, '-' FROM wide WHERE kind = 'supplier')
GROUP BY rowkey, family, qualifier
UNION ALL
SELECT rowkey, family, qualifier, ts, value FROM ({_UPSERTED})
WHERE rowkey NOT IN (SELECT rowkey FROM wide WHERE kind = 'supplier')
  AND (qualifier <> 'segment' OR rowkey NOT IN (SELECT rowkey FROM wide WHERE kind = 'customer' AND nationkey = '3'))"""

_PRODUCTS = """
SELECT p_partkey, replace(p_name, ' ', '_') AS name, CAST(floor(p_retailprice) AS INTEGER) AS price, p_size AS store
FROM part"""

ORACLE: dict[str, str] = {
    "access_log_parse": _on_requests(
        "SELECT ip, time, method, url, protocal, status, bytessent, host, referer, ua, formattime FROM requests"
    ),
    "access_log_rows": _on_requests(
        "SELECT ip, country, province, city, time, method, url, protocal, status, bytessent, referer, "
        "browsername, browserversion, osname, osversion, ua, formattime FROM requests"
    ),
    "access_log_typed": _on_requests(
        "SELECT ip, formattime, url, CAST(status AS INTEGER) AS status, CAST(bytessent AS BIGINT) AS bytessent "
        "FROM requests"
    ),
    "access_log_rejects": "SELECT text AS value, 'layout' AS reject_reason FROM documents",
    "format_time": _on_requests("SELECT time, formattime FROM requests"),
    "row_key": _on_keyed("SELECT day, referer, url, ip, ua, rowkey FROM keyed"),
    "ua_classify": _on_requests("SELECT ua, browsername, browserversion, osname, osversion FROM requests"),
    "ip_geo_range_join": _on_requests("SELECT ip, country, province, city FROM requests"),
    "ip_geo_nested": """
WITH e AS (SELECT event_id, (user_id * 37) % 200 AS place, user_id % 256 AS host FROM events),
n AS (SELECT n_nationkey AS nation, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT event_id, CASE WHEN event_id % 101 = 0 THEN '10.1.2'
    WHEN event_id % 3 = 0 THEN '2001:DB8:' || printf('%X', place) || '::' || printf('%x', host) || ':1'
    ELSE '10.' || place || '.' || host || '.1' END AS ip,
  CASE WHEN event_id % 101 = 0 THEN 'unknown' ELSE coalesce(r_name, CASE WHEN event_id % 3 = 0 THEN 'SIX' ELSE 'TEN' END) END AS country,
  CASE WHEN event_id % 101 = 0 THEN 'unknown' ELSE coalesce(n_name, 'ALL') END AS province,
  CASE WHEN event_id % 101 = 0 THEN 'unknown' WHEN nation IS NULL THEN 'ALL'
    WHEN place % 8 = 1 AND host <= 127 THEN 'INNER_' || nation ELSE 'CITY_' || nation END AS city
FROM e LEFT JOIN n ON place // 8 = nation""",
    "visit_dedup": _on_visits(f"SELECT {_BARE} FROM visits"),
    "visit_table": _on_visits(f"SELECT rowkey, {_STORED}, day FROM visits"),
    "visit_upsert": _on_visits(f"SELECT rowkey, {_STORED}, day FROM visits"),
    "visit_scan_projected": _on_visits("SELECT country, province, browsername FROM visits"),
    "visit_cells": _on_visits(_VISIT_CELLS),
    "visits_by_region": _on_visits(
        "SELECT country, province, count(*) AS cnt FROM visits GROUP BY country, province"
    ),
    "top10_regions": _on_visits(
        "SELECT country, province, count(*) AS cnt FROM visits GROUP BY country, province "
        "ORDER BY cnt DESC, country, province LIMIT 10"
    ),
    "visits_by_browser": _on_visits("SELECT browsername, count(*) AS cnt FROM visits GROUP BY browsername"),
    "visits_by_browser_sql": _on_visits("SELECT browsername, count(*) AS cnt FROM visits GROUP BY browsername"),
    "visits_sql": _on_visits("SELECT day, url, count(*) AS cnt, min(formattime) AS first_minute FROM visits GROUP BY day, url"),
    "requests_by_browser": _on_requests("SELECT browsername, count(*) AS cnt FROM requests GROUP BY browsername"),
    "browser_stat": _on_visits(
        "SELECT day, browsername AS browser, count(*) AS cnt FROM visits GROUP BY day, browsername"
    ),
    "region_stat": _on_visits(
        "SELECT day, country, province, count(*) AS cnt FROM visits GROUP BY day, country, province"
    ),
    "order_parse_json": _on_orders("SELECT time, userid, courseid, fee, flag, orderid, amount FROM orders_in"),
    "order_rejects": "SELECT text AS value, 'json' AS reject_reason FROM conversations",
    "order_time_parts": _on_orders("SELECT time, day, hour, minute FROM orders_in"),
    "order_paid_count_day": _on_orders(f"SELECT day, {_SUCCESS} FROM orders_in GROUP BY day"),
    "order_paid_fee_day": _on_orders(f"SELECT day, {_FEE} FROM orders_in GROUP BY day"),
    "order_stats_day": _on_orders(_stats("day")),
    "order_stats_hour": _on_orders(_stats("day, hour")),
    "order_stats_minute": _on_orders(_stats("day, hour, minute")),
    "order_stats_all_grains": _on_orders(_ALL_GRAINS),
    "order_counters": _on_orders(_COUNTERS),
    "order_hash_fields": _on_orders(_HASH_FIELDS),
    "order_to_json": _on_orders(
        """SELECT '{"time":"' || time || '","userid":"' || userid || '","courseid":"' || courseid || '","fee":"' || fee
        || '","flag":"' || flag || '","orderid":"' || orderid || '"}' AS value FROM orders_in"""
    ),
    "order_stream_rejects": "SELECT text AS value, 'json' AS reject_reason FROM conversations",
    "order_stream_windows": _on_orders(_stats("day, hour, minute")),
    "order_stream_distinct": _on_orders(_ALL_GRAINS),
    "order_stream_totals": _on_orders(_ALL_GRAINS),
    "order_stream_counters": _on_orders(_COUNTERS),
    "order_stream_hash_fields": _on_orders(_HASH_FIELDS),
    "row_to_cells": _on_wide(_cells("wide", 1)),
    "cells_to_row": _on_wide("SELECT rowkey, segment, acctbal, nationkey, acctbal AS address_acctbal FROM wide"),
    "cell_upsert": _on_wide(_UPSERTED),
    "cell_put_stored": _on_wide(_UPSERTED),
    "cell_put_runs": _on_wide(_PUTS),
    "cell_table_sql": _on_wide(_PUTS),
    "rowkey_get_stored": _on_wide(f"SELECT * FROM ({_PUTS}) WHERE rowkey = 'Supplier#000000001'"),
    "rowkey_prefix_stored": _on_wide(f"SELECT * FROM ({_PUTS}) WHERE rowkey LIKE 'Customer#00000001%'"),
    "rowkey_get": _on_wide(
        "SELECT rowkey, segment, acctbal, nationkey FROM wide WHERE rowkey = 'Customer#000000042'"
    ),
    "column_scan": _on_wide("SELECT rowkey, segment FROM wide WHERE segment IS NOT NULL"),
    "rowkey_prefix_scan": _on_wide(
        "SELECT rowkey, segment, acctbal, nationkey FROM wide "
        "WHERE rowkey LIKE 'Customer#0000001%' OR rowkey LIKE 'Supplier#%'"
    ),
    "family_scan": _on_wide(f"SELECT * FROM ({_cells('wide', 1)}) WHERE family = 'info'"),
    "bulk_cells": _on_wide(_cells("wide", 1)),
    "bulk_cells_regions": _on_wide(
        f"SELECT c.*, day FROM ({_cells('wide', 1)}) c, (SELECT unnest(['20240101', '20240102']) AS day)"
    ),
    "bulk_visit_cells": _on_visits(_VISIT_CELLS),
    "product_sort": (
        "SELECT *, row_number() OVER (ORDER BY price DESC, store DESC, p_partkey) AS position "
        f"FROM ({_PRODUCTS})"
    ),
    "product_sort_price": (
        f"SELECT *, row_number() OVER (ORDER BY price DESC, p_partkey) AS position FROM ({_PRODUCTS})"
    ),
}
