from __future__ import annotations

import pytest

from footfall.plans import daily
from footfall.schemas import VISIT_SCHEMA
from footfall.sinks.tables import read_days

LINE = '{ip} - - [30/Jan/2019:01:00:21 +0000] "GET /{page} HTTP/1.1" 200 10 "h" "-" - "curl/7.1" "-" x'


@pytest.fixture
def ranges(spark):
    return spark.createDataFrame([(0, 9, "C", "P", "T")], "lo bigint, hi bigint, country string, province string, city string")


def test_every_line_is_accounted_for(spark, tmp_path, ranges):
    lines = [LINE.format(ip=f"1.0.0.{i % 40}", page=i % 3) for i in range(100)] + ["damaged", "", "also damaged"]
    log = spark.createDataFrame([(x,) for x in lines], "value string")
    table, rejects = str(tmp_path / "visits"), str(tmp_path / "rejects")
    counted = daily.load_day(log, ranges, table, "20190130", rejects)
    assert counted == {"lines": 103, "accepted": 100, "rejected": 3, "merged": 0}
    bad = read_days(spark, rejects, "value string, reject_reason string, day string")
    assert sorted(r.value for r in bad.collect()) == ["", "also damaged", "damaged"]
    assert read_days(spark, table, VISIT_SCHEMA).count() == len({(x.split()[0], x.split()[6]) for x in lines[:100]})


def test_the_log_is_scanned_once(spark, tmp_path, ranges, monkeypatch):
    (tmp_path / "log.txt").write_text(LINE.format(ip="1.0.0.1", page="a") + "\ndamaged\n")
    scans = []
    whole = daily.staged_day
    monkeypatch.setattr(daily, "staged_day", lambda *a, **k: scans.append(1) or whole(*a, **k))
    daily.load_day(
        spark.read.text(str(tmp_path / "log.txt")), ranges, str(tmp_path / "t"), "20190130", str(tmp_path / "r"),
        str(tmp_path / "q"),
    )
    assert len(scans) == 1
    assert read_days(spark, str(tmp_path / "q"), VISIT_SCHEMA).count() == 1


def test_the_load_counts_in_its_one_write(spark, tmp_path, ranges):
    (tmp_path / "log.txt").write_text("\n".join([LINE.format(ip="1.0.0.1", page=i) for i in range(7)] + ["x", "y"]))
    staged, counted = daily.staged_day(spark.read.text(str(tmp_path / "log.txt")), day="20190130")
    (tmp_path / "log.txt").unlink()  # nothing reads the log again
    assert counted == {"lines": 9, "rejected": 2} and staged.count() == 9


def test_late_files_join_a_loaded_day(spark, tmp_path, ranges):
    lines = [LINE.format(ip=f"1.0.0.{i % 40}", page=i % 3).replace("01:00", f"01:{i % 60:02}") for i in range(100)] + ["bad"] * 4
    log = lambda part: spark.createDataFrame([(x,) for x in part], "value string")
    one, two = (str(tmp_path / n) for n in ("one", "two"))
    daily.load_day(log(lines), ranges, f"{one}/t", "20190130", f"{one}/r", f"{one}/q")
    for k in range(3):
        counted = daily.load_day(log(lines[k::3]), ranges, f"{two}/t", "20190130", f"{two}/r", f"{two}/q", add=k > 0)
        assert counted["lines"] == len(lines[k::3])
    wrong = "value string, reject_reason string, day string"
    for name, schema in (("t", VISIT_SCHEMA), ("q", VISIT_SCHEMA), ("r", wrong)):
        a, b = (sorted(map(tuple, read_days(spark, f"{root}/{name}", schema).collect())) for root in (one, two))
        assert a == b and a


def test_keys_that_hide_visits_are_counted(spark):
    rows = [("d", "d_1", "x"), ("d", "d_1", "y"), ("d", "d_2", "z"), ("d", "d_2", "z")]
    assert daily.merged_keys(spark.createDataFrame(rows, "day string, rowkey string, sha2_key string")) == 1
