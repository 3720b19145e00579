from __future__ import annotations

import pytest
from pyspark.sql import types as T

from footfall import session
from footfall.jobs import load_day, order_stream, report_day, sort_products
from footfall.schemas import BROWSER_STAT_SCHEMA, CELL_SCHEMA, REGION_STAT_SCHEMA, VISIT_SCHEMA
from footfall.sinks.tables import read_days
from footfall.streaming.order_stream import read_totals

LINE = '{ip} - - [30/Jan/2019:0{h}:00:21 +0000] "GET /{page} HTTP/1.1" 200 10 "h" "-" - "{ua}" "-" 10.0.0.1:80 200 0.1 0.1'


def write_log(folder):
    (folder / "logs" / "20190130").mkdir(parents=True)
    lines = [
        LINE.format(ip="10.0.0.1", h=1, page="a", ua="Go-http-client/1.1"),
        LINE.format(ip="10.0.0.1", h=2, page="a", ua="Go-http-client/1.1"),
        LINE.format(ip="10.0.0.2", h=1, page="a", ua="curl/7.1"),
        LINE.format(ip="99.0.0.2", h=1, page="b", ua="curl/7.1"),
        "damaged",
    ]
    (folder / "logs" / "20190130" / "access.log").write_text("\n".join(lines))


def test_daily_jobs_end_to_end_and_again(spark, tmp_path, capsys):
    write_log(tmp_path)
    ranges = [(10 << 24, (10 << 24) + 255, "CN", "SH", "SH")]
    spark.createDataFrame(ranges, "lo bigint, hi bigint, country string, province string, city string").write.parquet(
        str(tmp_path / "ranges")
    )
    table, rejects, cells, reports = (str(tmp_path / n) for n in ("visits", "rejects", "cells", "reports"))
    for _ in range(2):
        load_day.main(
            ["--day", "20190130", "--logs", str(tmp_path / "logs"), "--ranges", str(tmp_path / "ranges"),
             "--table", table, "--rejects", rejects, "--cells", cells,
             "--requests", str(tmp_path / "requests")]
        )
        report_day.main(["--day", "20190130", "--table", table, "--reports", reports])
    stored = read_days(spark, table, VISIT_SCHEMA).collect()
    assert len(stored) == 3 and {r.day for r in stored} == {"20190130"}
    assert {r.formattime for r in stored if r.ip == "10.0.0.1"} == {"201901300200"}
    assert {r.ip: r.city for r in stored} == {"10.0.0.1": "SH", "10.0.0.2": "SH", "99.0.0.2": "unknown"}
    requests = read_days(spark, str(tmp_path / "requests"), VISIT_SCHEMA)
    assert requests.count() == 4 and requests.select("rowkey").distinct().count() == 3
    bad = read_days(spark, rejects, T.StructType.fromDDL("value string, reject_reason string, day string")).collect()
    assert [(r.value, r.reject_reason) for r in bad] == [("damaged", "layout")]
    cell_days = read_days(spark, cells, T.StructType([*CELL_SCHEMA.fields, T.StructField("day", T.StringType())]))
    assert cell_days.count() == 3 * 15
    browsers = read_days(spark, f"{reports}/browser_stat", BROWSER_STAT_SCHEMA).collect()
    assert sorted(tuple(r) for r in browsers) == [("Go-http-client", 1, "20190130"), ("curl", 2, "20190130")]
    regions = read_days(spark, f"{reports}/region_stat", REGION_STAT_SCHEMA).collect()
    assert sorted(tuple(r) for r in regions) == [("CN", "SH", 2, "20190130"), ("unknown", "unknown", 1, "20190130")]
    shown = capsys.readouterr().out
    assert "SH" in shown and "lines=5 accepted=4 rejected=1 merged=0" in shown and "unreported=0" in shown


def test_day_is_required():
    with pytest.raises(SystemExit):
        load_day.main(["--logs", "x", "--ranges", "y", "--table", "z"])


def test_order_stream_job(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"time":"20240101093015","fee":"12","flag":"1"}\n')
    order_stream.main(
        ["--files", str(tmp_path / "in"), "--totals", str(tmp_path / "t"), "--checkpoint", str(tmp_path / "c"), "--once",
         "--option", "maxFilesPerTrigger=1"]
    )
    rows = {r.grain: (r.total, r.success, r.fee) for r in read_totals(spark, str(tmp_path / "t")).collect()}
    assert rows == dict.fromkeys(("day", "hour", "minute"), (1, 1, 12))
    with pytest.raises(SystemExit):
        order_stream.main(["--brokers", "h:9092", "--totals", "t", "--checkpoint", "c"])


def test_sort_products_job(spark, tmp_path, capsys):
    (tmp_path / "p.txt").write_text("a 1 2\nb 5 1\nc 5 3\n")
    sort_products.main(["--lines", str(tmp_path / "p.txt")])
    text = capsys.readouterr().out
    assert text.index("c 5") < text.index("b 5") < text.index("a 1")
    sort_products.main(["--lines", str(tmp_path / "p.txt"), "--by", "price", "--out", str(tmp_path / "o")])
    assert spark.read.parquet(str(tmp_path / "o")).count() == 3


def test_shared_folder_comes_from_the_session(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x").startswith(session.shared_dir(spark))


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        applicationId = "app-1"  # noqa: N815
        master = "yarn"

    class Session:
        conf = Conf()
        sparkContext = Context()  # noqa: N815

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
    Session.sparkContext.master = "local[2]"
    assert session.shared_dir(Session()) == session.shared_dir(Session())
