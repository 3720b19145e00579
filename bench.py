"""Time the headline queries, each cold and then warm; prints one JSON line.

``value`` and ``queries`` are the second run, ``cold`` is the first with its code generation.

BENCH_SF_DIR is the folder of tables, BENCH_CPUS the local core count.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from footfall.plans.queries import QUERIES  # noqa: E402
from footfall.session import build_session  # noqa: E402

HEADLINE = (
    "access_log_parse", "format_time", "row_key", "ua_classify", "ip_geo_range_join", "visit_dedup", "visit_table",
    "visit_cells", "visits_by_region", "top10_regions", "visits_by_browser", "visits_by_browser_sql", "browser_stat",
    "region_stat", "order_parse_json", "order_stats_day", "order_stats_hour", "order_stats_minute",
    "order_stats_all_grains", "order_counters", "order_hash_fields", "order_stream_totals", "order_stream_rejects", "row_to_cells",
    "cells_to_row", "cell_upsert", "cell_put_stored", "bulk_visit_cells", "rowkey_prefix_scan", "bulk_cells", "product_sort", "product_sort_price",
    "visit_upsert", "visits_sql", "ip_geo_nested", "cell_put_runs", "rowkey_get_stored", "bulk_cells_regions", "order_stream_windows",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "footfall-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The first query pays for JVM and code generation start-up; it is run once unmeasured.
    QUERIES["top10_regions"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    cold, seconds = {}, {}
    for times in (cold, seconds):
        for name in HEADLINE:
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "cold_value": round(sum(cold.values()), 3),
        "cold": cold,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
