from __future__ import annotations

from footfall.operators import visits as v
from footfall.schemas import VISIT_COLUMNS, VISIT_SCHEMA

ROW = "rowkey string, formattime string, ip string, status string, day string"


def test_latest_request_of_a_key_wins_and_ties_go_to_the_larger_row(spark):
    rows = spark.createDataFrame(
        [
            ("k1", "201901300000", "9", "200", "d"),
            ("k1", "201901300001", "1", "200", "d"),
            ("k2", "201901300000", "1", "200", "d"),
            ("k2", "201901300000", "2", "100", "d"),
            ("k2", "201901300000", "2", "300", "d"),
            ("k1", "201901290000", "5", "200", "e"),
        ],
        ROW,
    )
    found = {(r.day, r.rowkey): (r.formattime, r.ip, r.status) for r in v.dedup_visits(rows).collect()}
    assert found == {
        ("d", "k1"): ("201901300001", "1", "200"),
        ("d", "k2"): ("201901300000", "2", "300"),
        ("e", "k1"): ("201901290000", "5", "200"),
    }


def test_a_hot_key_is_reduced_before_the_shuffle(spark, plan):
    rows = spark.range(20000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE string(id) END AS rowkey", "string(id) AS formattime",
        "'1' AS ip", "'200' AS status", "'d' AS day",
    )
    visits = v.dedup_visits(rows)
    text = plan(visits)
    before, after = text.index("WindowGroupLimit"), text.rindex("WindowGroupLimit")
    assert before < text.index("Exchange hashpartitioning") < after
    assert visits.count() == 1 + sum(1 for i in range(20000) if i % 3)


def sample(spark):
    rows = [("A", "P", "Chrome")] * 3 + [("A", "Q", "Edge")] * 3 + [("B", "P", "Chrome")] * 2 + [("B", "R", None)]
    return spark.createDataFrame([(*r, "d") for r in rows], "country string, province string, browsername string, day string")


def test_reports(spark):
    rows = sample(spark)
    assert [tuple(r) for r in v.top_regions(rows, 3).collect()] == [("A", "P", 3), ("A", "Q", 3), ("B", "P", 2)]
    assert {tuple(r) for r in v.visits_by_region(rows).collect()} == {("A", "P", 3), ("A", "Q", 3), ("B", "P", 2), ("B", "R", 1)}
    browsers = [tuple(r) for r in v.visits_by_browser(rows).collect()]
    assert browsers == [("Chrome", 5), ("Edge", 3), (None, 1)]
    assert [tuple(r) for r in v.visits_by_browser_sql(rows).collect()] == browsers


def test_report_tables_come_from_one_small_cube_and_refuse_nulls(spark):
    cube = v.visit_cube(sample(spark))
    assert {tuple(r) for r in v.browser_stat(cube).collect()} == {("d", "Chrome", 5), ("d", "Edge", 3)}
    assert {tuple(r) for r in v.region_stat(cube).collect()} == {
        ("d", "A", "P", 3), ("d", "A", "Q", 3), ("d", "B", "P", 2), ("d", "B", "R", 1),
    }


def test_top_regions_needs_no_full_sort(spark, plan):
    assert "TakeOrderedAndProject" in plan(v.top_regions(sample(spark)))


def test_visits_with_a_missing_column_are_told_apart(spark):
    full = {c: "x" for c in (*VISIT_COLUMNS, "rowkey", "day")}
    rows = spark.createDataFrame([full, {**full, "rowkey": "y", "city": None}], VISIT_SCHEMA)
    assert [r.rowkey for r in v.storable(rows).collect()] == ["x"]
    assert [r.rowkey for r in v.unstorable(rows).collect()] == ["y"]
