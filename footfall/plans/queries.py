"""Named queries over the warehouse tables: ``name(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from footfall.functions.agents import with_agent
from footfall.functions.sql import register
from footfall.operators import cells as cell_ops
from footfall.operators import order_stats as stats
from footfall.operators import ordering
from footfall.operators import visits as visit_ops
from footfall.operators.geo import with_geo
from footfall.operators.geo_nested import with_geo_nested
from footfall.plans import daily, derived
from footfall.schemas import (
    AGENT_COLUMNS,
    BROWSER_STAT_SCHEMA,
    CELL_SCHEMA,
    GEO_COLUMNS,
    LINE_FIELDS,
    ORDER_FIELDS,
    REGION_STAT_SCHEMA,
    VISIT_SCHEMA,
)
from footfall.session import materialize, scratch_path
from footfall.sinks.messages import write_messages
from footfall.sinks.regions import load_regions
from footfall.sinks.tables import create_cell_table, fold_cells, list_families, publish_cells, put_cells, read_cells
from footfall.sinks.tables import read_days, read_family, upsert_days, write_cells, write_days
from footfall.sources.access_log import accepted, parse_lines, rejected, typed_view, with_key
from footfall.sources.orders import accepted_orders, parse_orders, rejected_orders, to_messages
from footfall.sources.products import parse_products
from footfall.streaming.order_stream import read_rejects, read_totals, read_windows, start_order_stream
from footfall.streaming.order_stream import start_window_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(parse_lines(derived.access_lines(spark, sf_dir)))


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.requests(derived.access_lines(spark, sf_dir))


def _visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily.visits(derived.access_lines(spark, sf_dir), derived.ip_ranges(spark, sf_dir))


def _stored_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "visits")
    write_days(_visits(spark, sf_dir), root, "rowkey")
    return read_days(spark, root, VISIT_SCHEMA)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_messages(derived.order_rows(derived.events(spark, sf_dir)))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted_orders(parse_orders(_messages(spark, sf_dir)))


# access log


@query
def access_log_parse(spark, sf_dir):
    return _parsed(spark, sf_dir).select(*LINE_FIELDS, "formattime")


@query
def access_log_rows(spark, sf_dir):
    return daily.log_rows(derived.access_lines(spark, sf_dir), derived.ip_ranges(spark, sf_dir))


@query
def access_log_typed(spark, sf_dir):
    return typed_view(_parsed(spark, sf_dir)).select("ip", "formattime", "url", "status", "bytessent")


@query
def access_log_rejects(spark, sf_dir):
    """Log lines mixed with prose: exactly the prose must come back, whole."""
    prose = derived.table(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    return rejected(parse_lines(derived.access_lines(spark, sf_dir).unionByName(prose)))


@query
def format_time(spark, sf_dir):
    return _parsed(spark, sf_dir).select("time", "formattime")


@query
def row_key(spark, sf_dir):
    return with_key(_parsed(spark, sf_dir)).select("day", "referer", "url", "ip", "ua", "rowkey")


@query
def ua_classify(spark, sf_dir):
    return with_agent(_parsed(spark, sf_dir)).select("ua", *AGENT_COLUMNS)


@query
def ip_geo_range_join(spark, sf_dir):
    return with_geo(_parsed(spark, sf_dir).select("ip"), derived.ip_ranges(spark, sf_dir)).select("ip", *GEO_COLUMNS)


@query
def ip_geo_nested(spark, sf_dir):
    """Addresses of both families in ranges that lie in each other."""
    return with_geo_nested(derived.visitors(spark, sf_dir), derived.nested_ranges(spark, sf_dir))


@query
def visit_dedup(spark, sf_dir):
    return visit_ops.dedup_visits(_requests(spark, sf_dir))


@query
def visit_table(spark, sf_dir):
    return _stored_visits(spark, sf_dir)


@query
def visit_upsert(spark, sf_dir):
    """Half of the log is loaded, the other half comes late and is merged into the loaded days."""
    root, ranges = scratch_path(spark, "visits"), derived.ip_ranges(spark, sf_dir)
    first, late = (derived.access_lines(spark, sf_dir, f"event_id % 2 = {i}") for i in (0, 1))
    write_days(daily.visits(first, ranges), root, "rowkey")
    upsert_days(daily.visits(late, ranges), root, daily.merged_visits)
    return read_days(spark, root, VISIT_SCHEMA)


@query
def visit_scan_projected(spark, sf_dir):
    return _stored_visits(spark, sf_dir).select("country", "province", "browsername")


@query
def visit_cells(spark, sf_dir):
    return daily.visit_cells(_visits(spark, sf_dir), ts=1)


# visit reports


@query
def visits_by_region(spark, sf_dir):
    return visit_ops.visits_by_region(_visits(spark, sf_dir))


@query
def top10_regions(spark, sf_dir):
    return visit_ops.top_regions(_visits(spark, sf_dir), 10)


@query
def visits_by_browser(spark, sf_dir):
    # The count needs no place, so the visits are neither located nor stored.
    return visit_ops.visits_by_browser(visit_ops.dedup_visits(_requests(spark, sf_dir)))


@query
def visits_by_browser_sql(spark, sf_dir):
    return visit_ops.visits_by_browser_sql(visit_ops.dedup_visits(_requests(spark, sf_dir)))


@query
def visits_sql(spark, sf_dir):
    """Visits per day and page, from the log's lines to the report in SQL text alone."""
    register(spark, derived.access_lines(spark, sf_dir))
    return spark.sql(
        """
        WITH requests AS (
          SELECT *, substring(formattime, 1, 8) AS day FROM access_log('UTC') WHERE reject_reason IS NULL),
        keyed AS (SELECT *, row_key(day, referer, url, ip, ua) AS rowkey FROM requests),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY day, rowkey ORDER BY formattime DESC, url DESC) AS n FROM keyed),
        visits AS (SELECT * FROM ranked WHERE n = 1)
        SELECT day, url, count(*) AS cnt, min(formattime) AS first_minute FROM visits GROUP BY day, url
        """
    )


@query
def requests_by_browser(spark, sf_dir):
    """Every request counts, also repeated ones of the same visit."""
    return visit_ops.visits_by_browser(_requests(spark, sf_dir))


@query
def browser_stat(spark, sf_dir):
    root = scratch_path(spark, "browser_stat")
    # The report needs no place, so the visits are not located.
    visits = visit_ops.dedup_visits(_requests(spark, sf_dir))
    write_days(visit_ops.browser_stat(visit_ops.visits_by(visits, "day", "browsername")), root)
    return read_days(spark, root, BROWSER_STAT_SCHEMA)


@query
def region_stat(spark, sf_dir):
    root = scratch_path(spark, "region_stat")
    write_days(visit_ops.region_stat(visit_ops.visit_cube(_visits(spark, sf_dir))), root)
    return read_days(spark, root, REGION_STAT_SCHEMA)


# orders


@query
def order_parse_json(spark, sf_dir):
    return _orders(spark, sf_dir).select(*ORDER_FIELDS, "amount")


@query
def order_rejects(spark, sf_dir):
    """Order messages mixed with chat text: exactly the chat text must come back."""
    chat = derived.table(spark, sf_dir, "conversations").select(F.col("text").alias("value"))
    return rejected_orders(parse_orders(_messages(spark, sf_dir).unionByName(chat)))


@query
def order_time_parts(spark, sf_dir):
    return _orders(spark, sf_dir).select("time", "day", "hour", "minute")


@query
def order_paid_count_day(spark, sf_dir):
    return stats.paid_count_per_day(_orders(spark, sf_dir))


@query
def order_paid_fee_day(spark, sf_dir):
    return stats.paid_fee_per_day(_orders(spark, sf_dir))


@query
def order_stats_day(spark, sf_dir):
    return stats.order_stats(_orders(spark, sf_dir), "day")


@query
def order_stats_hour(spark, sf_dir):
    return stats.order_stats(_orders(spark, sf_dir), "hour")


@query
def order_stats_minute(spark, sf_dir):
    return stats.order_stats(_orders(spark, sf_dir), "minute")


@query
def order_stats_all_grains(spark, sf_dir):
    return stats.order_stats_all_grains(_orders(spark, sf_dir))


@query
def order_counters(spark, sf_dir):
    return stats.to_counters(stats.order_stats(_orders(spark, sf_dir), "day"))


@query
def order_hash_fields(spark, sf_dir):
    return stats.to_hash_fields(stats.order_stats_all_grains(_orders(spark, sf_dir)))


@query
def order_to_json(spark, sf_dir):
    path = scratch_path(spark, "messages")
    write_messages(_messages(spark, sf_dir), "text", path=path)
    return spark.read.text(path)


def _stream(spark: SparkSession, messages: DataFrame, **options) -> str:
    """Work off a stream of messages; returns the folder of totals, with the rejects beside it."""
    root = scratch_path(spark, "totals")
    start_order_stream(messages, root, scratch_path(spark, "checkpoint"), every=None, **options).awaitTermination()
    return root


def _arriving(spark: SparkSession, sf_dir: str, table: str, pattern: str) -> DataFrame:
    schema = derived.table(spark, sf_dir, table).schema
    # A file stream takes a folder or a pattern; this pattern also fits a single file.
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(f"{sf_dir}/{pattern}")


def _stream_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals that a streaming run over the events leaves behind."""
    arriving = _arriving(spark, sf_dir, "events", "event[s].parquet")
    return read_totals(spark, _stream(spark, to_messages(derived.order_rows(arriving))))


@query
def order_stream_rejects(spark, sf_dir):
    """Order messages and chat text in one stream: the chat text must be kept, whole, with its reason."""
    orders = to_messages(derived.order_rows(_arriving(spark, sf_dir, "events", "event[s].parquet")))
    chat = _arriving(spark, sf_dir, "conversations", "conversation[s].parquet").select(F.col("text").alias("value"))
    return read_rejects(spark, f"{_stream(spark, orders.unionByName(chat))}_rejects")


@query
def order_stream_windows(spark, sf_dir):
    """Totals per minute that windows in the state store leave behind."""
    arriving = _arriving(spark, sf_dir, "events", "event[s].parquet")
    root = scratch_path(spark, "windows")
    messages = to_messages(derived.order_rows(arriving))
    start_window_stream(messages, root, scratch_path(spark, "checkpoint"), every=None).awaitTermination()
    return read_windows(spark, root).drop("batch_id")


@query
def order_stream_distinct(spark, sf_dir):
    """Every order is sent twice and counted once."""
    arriving = _arriving(spark, sf_dir, "events", "event[s].parquet")
    messages = to_messages(derived.order_rows(arriving.unionByName(arriving)))
    return read_totals(spark, _stream(spark, messages, distinct="1 day"))


@query
def order_stream_totals(spark, sf_dir):
    return _stream_totals(spark, sf_dir)


@query
def order_stream_counters(spark, sf_dir):
    return stats.to_counters(_stream_totals(spark, sf_dir).where(F.col("grain") == "day"))


@query
def order_stream_hash_fields(spark, sf_dir):
    return stats.to_hash_fields(_stream_totals(spark, sf_dir))


# cells


@query
def row_to_cells(spark, sf_dir):
    return derived.cells(spark, sf_dir)


@query
def cells_to_row(spark, sf_dir):
    return cell_ops.from_cells(derived.cells(spark, sf_dir), derived.CELL_COLUMNS, derived.CELL_NAMES)


@query
def cell_upsert(spark, sf_dir):
    return cell_ops.upsert_cells(derived.customer_cells(spark, sf_dir), derived.cell_changes(spark, sf_dir))


@query
def cell_put_stored(spark, sf_dir):
    """Put into a stored cell table, then read it."""
    root = scratch_path(spark, "cell_table")
    write_cells(derived.customer_cells(spark, sf_dir), root)
    put_cells(spark, root, derived.cell_changes(spark, sf_dir))
    return read_cells(spark, root)


def _put_table(spark: SparkSession, sf_dir: str) -> str:
    """A stored cell table after three puts, of which the first two are folded into it."""
    root = scratch_path(spark, "cell_table")
    write_cells(derived.customer_cells(spark, sf_dir), root)
    newer, outdated = derived.later_changes(spark, sf_dir)
    put_cells(spark, root, derived.cell_changes(spark, sf_dir))
    put_cells(spark, root, newer)
    fold_cells(spark, root)
    put_cells(spark, root, outdated)
    return root


@query
def cell_put_runs(spark, sf_dir):
    return read_cells(spark, _put_table(spark, sf_dir))


@query
def cell_table_sql(spark, sf_dir):
    """The same table by its name in the catalog, in SQL; the catalog keeps no trace of it."""
    root, name = _put_table(spark, sf_dir), f"cells_{uuid.uuid4().hex}"
    create_cell_table(spark, name, root, ["info", "address", "unused"])
    try:
        publish_cells(spark, name, root)
        families = list_families(spark).where(F.col("table") == name).select("family")
        stored = spark.sql(f"SELECT rowkey, family, qualifier, ts, value FROM {name}")
        return materialize(stored.join(families, "family").select(*CELL_SCHEMA.names), "cell_table")
    finally:
        spark.sql(f"DROP TABLE {name}")


@query
def rowkey_get_stored(spark, sf_dir):
    """A row of a stored table, from the files whose span of keys holds it."""
    return read_cells(spark, _put_table(spark, sf_dir), key="Supplier#000000001")


@query
def rowkey_prefix_stored(spark, sf_dir):
    return read_cells(spark, _put_table(spark, sf_dir), prefix="Customer#00000001")


@query
def rowkey_get(spark, sf_dir):
    return cell_ops.get_row(derived.wide_rows(spark, sf_dir), "Customer#000000042")


@query
def column_scan(spark, sf_dir):
    return cell_ops.column_scan(derived.wide_rows(spark, sf_dir), "segment")


@query
def rowkey_prefix_scan(spark, sf_dir):
    return cell_ops.prefix_scan(derived.wide_rows(spark, sf_dir), ["Customer#0000001", "Supplier#"])


@query
def family_scan(spark, sf_dir):
    root = scratch_path(spark, "cells")
    write_cells(derived.cells(spark, sf_dir), root)
    return read_family(spark, root, "info")


@query
def bulk_cells(spark, sf_dir):
    root = scratch_path(spark, "bulk_cells")
    folder = daily.bulk_load_day(derived.cells(spark, sf_dir), root, "20240101")
    return spark.read.schema(CELL_SCHEMA).parquet(folder)


@query
def bulk_cells_regions(spark, sf_dir):
    """Two days loaded into the same regions, the second by the splits that the first left."""
    root, rows = scratch_path(spark, "region_cells"), derived.wide_rows(spark, sf_dir)
    for day in ("20240101", "20240102"):
        load_regions(rows, root, day, derived.FAMILIES, ts=1, most_rows=1000)
    schema = StructType([*CELL_SCHEMA.fields, StructField("day", StringType())])
    return read_days(spark, root, schema)


@query
def bulk_visit_cells(spark, sf_dir):
    root = scratch_path(spark, "bulk_visit_cells")
    folder = daily.bulk_load_visits(_stored_visits(spark, sf_dir), root, "20240101", ts=1)
    return spark.read.schema(CELL_SCHEMA).parquet(folder)


# products


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_products(derived.product_lines(spark, sf_dir))


@query
def product_sort(spark, sf_dir):
    return ordering.with_position(ordering.sort_products(_products(spark, sf_dir), F.col("p_partkey")))


@query
def product_sort_price(spark, sf_dir):
    return ordering.with_position(ordering.sort_products_by_price(_products(spark, sf_dir), F.col("p_partkey")))
