from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.operators import cells as c
from footfall.schemas import CELL_SCHEMA

FAMILIES = {"info": ("age", "birthday", "company"), "address": ("country", "province", "city")}
COLUMNS = [(f, q) for f, group in FAMILIES.items() for q in group]
QUALIFIERS = [q for _, q in COLUMNS]
WIDE = "rowkey string, " + ", ".join(f"{q} string" for q in QUALIFIERS)
PEOPLE = [
    ("anna", "31", "May", "Acme", "AT", "TIROL", "IMST"),
    ("boris", "19", "June", "Zeta", "AT", "WIEN", "WIEN"),
]


@pytest.fixture
def people(spark):
    return c.to_cells(spark.createDataFrame(PEOPLE, WIDE), FAMILIES, ts=1)


def test_cells(people):
    rows = people.collect()
    assert people.columns == CELL_SCHEMA.names and len(rows) == 12
    assert ("anna", "info", "company", 1, "Acme") in [tuple(r) for r in rows]
    assert ("boris", "address", "city", 1, "WIEN") in [tuple(r) for r in rows]


def test_updating_one_cell_keeps_the_others(spark, people):
    change = spark.createDataFrame([("boris", "info", "age", 2, "20")], CELL_SCHEMA)
    updated = c.from_cells(c.upsert_cells(people, change), COLUMNS)
    assert sorted(map(tuple, updated.collect())) == [PEOPLE[0], ("boris", "20", *PEOPLE[1][2:])]


def test_rows_having_a_column_and_rows_by_prefix(spark, people):
    wide = c.from_cells(people, COLUMNS)
    assert sorted(map(tuple, c.column_scan(wide, "company").collect())) == [("anna", "Acme"), ("boris", "Zeta")]
    partly = c.to_cells(spark.createDataFrame([("a", None, "b", None, None, None, None)], WIDE), FAMILIES)
    assert [tuple(r) for r in partly.collect()] == [("a", "info", "birthday", 0, "b")]
    assert c.column_scan(c.from_cells(partly, COLUMNS), "age").count() == 0
    assert {r.rowkey for r in c.prefix_scan(wide, ["p", "a"]).collect()} == {"anna"}
    assert c.get_row(wide, "boris").first().company == "Zeta"


def test_point_and_prefix_tests_reach_the_file_scan(spark, plan, tmp_path):
    path = str(tmp_path / "wide")
    spark.createDataFrame(PEOPLE, WIDE).write.parquet(path)
    stored = spark.read.parquet(path)
    assert "EqualTo(rowkey,boris)" in plan(c.get_row(stored, "boris"))
    prefix = plan(c.prefix_scan(stored, ["p", "a"]))
    assert "StringStartsWith(rowkey,p)" in prefix and "StringStartsWith(rowkey,a)" in prefix
    scan = plan(c.column_scan(stored, "company"))
    assert "IsNotNull(company)" in scan and "ReadSchema: struct<rowkey:string,company:string>" in scan


cell = st.tuples(
    st.sampled_from(["a", "b", None]), st.sampled_from(["info", None]), st.sampled_from("xy"), st.integers(0, 3),
    st.sampled_from("mn"),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(cell, max_size=12), st.lists(cell, max_size=8))
def test_upsert_equals_brute_force_on_both_ways(spark, old, new):
    """Bases with repeated versions and null keys."""
    named = {x[:3] for x in new}
    kept = {}
    for x in old + new:
        if x[:3] in named:
            kept[x[:3]] = max(kept.get(x[:3], x[3:]), x[3:])
    expected = sorted([x for x in old if x[:3] not in named] + [(*k, *v) for k, v in kept.items()], key=str)
    base, changes = (spark.createDataFrame(x, CELL_SCHEMA) for x in (old, new))
    for limit in (1 << 20, -1):
        found = [tuple(r) for r in c.upsert_cells(base, changes, broadcast_bytes=limit).collect()]
        assert sorted(found, key=str) == expected


def test_a_qualifier_in_two_families_is_two_cells(spark):
    rows = spark.createDataFrame([("r", "A")], "rowkey string, name string")
    cells = c.to_cells(rows, {"info": ("name",), "address": ("name",)})
    assert sorted(r.family for r in cells.collect()) == ["address", "info"]
    both = spark.createDataFrame([("r", "info", "name", 1, "A"), ("r", "address", "name", 1, "B")], CELL_SCHEMA)
    wide = c.from_cells(both, [("info", "name"), ("address", "name")], ["name", "address_name"])
    assert [tuple(r) for r in wide.collect()] == [("r", "A", "B")]


def test_wide_rows_are_ranged_before_they_are_cut(spark, plan):
    rows = spark.createDataFrame([(f"r{i % 97:02}{i}", "x", "y") for i in range(300)], "rowkey string, b string, a string")
    cells = c.sort_rows_for_bulk_load(rows, {"i": ("b", "a")}, 1, 4)
    text = plan(cells)
    assert text.index("Generate") < text.index("Exchange rangepartitioning")
    parts = cells.select("rowkey", "family", "qualifier", F.spark_partition_id().alias("p")).collect()
    keys = [tuple(r)[:3] for r in sorted(parts, key=lambda r: r.p)]
    assert keys == sorted(keys) and len(keys) == 600


def test_small_changes_leave_the_base_where_it_is(spark, plan, tmp_path, people):
    people.write.parquet(str(tmp_path / "cells"))
    stored = spark.read.schema(CELL_SCHEMA).parquet(str(tmp_path / "cells"))
    change = spark.createDataFrame([("boris", "info", "age", 2, "20")], CELL_SCHEMA)
    text = plan(c.upsert_cells(stored, change))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    # Above each scan of the base there is a broadcast join before any shuffle.
    lines = text.splitlines()
    for scan in (n for n, line in enumerate(lines) if "FileScan" in line):
        above = lines[:scan][::-1]
        assert "BroadcastHashJoin" in next(x for x in above if "Join" in x or "hashpartitioning" in x)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.text("abc", min_size=1, max_size=3), st.lists(st.none() | st.text(max_size=3), min_size=6, max_size=6), max_size=5))
def test_rows_to_cells_and_back_is_the_identity(spark, data):
    rows = [(k, *v) for k, v in data.items() if any(x is not None for x in v)]
    back = c.from_cells(c.to_cells(spark.createDataFrame(rows, WIDE), FAMILIES), COLUMNS)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)


def test_bulk_order_holds_inside_and_across_files_even_for_one_huge_row(spark, tmp_path):
    cells = spark.range(3000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('r', id) END AS rowkey", "'info' AS family",
        "lpad(id, 6, '0') AS qualifier", "0L AS ts", "string(id) AS value",
    )
    path = str(tmp_path / "bulk")
    c.sort_for_bulk_load(cells, 6).write.parquet(path)
    files = {}
    for r in spark.read.parquet(path).selectExpr("*", "_metadata.file_name AS f", "_metadata.row_index AS i").collect():
        files.setdefault(r.f, []).append((r.i, (r.rowkey, r.family, r.qualifier)))
    spans = []
    for rows in files.values():
        keys = [k for _, k in sorted(rows)]
        assert keys == sorted(keys)
        spans.append((keys[0], keys[-1], len(keys)))
    spans.sort()
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert len(spans) == 6 and max(n for *_, n in spans) < 3000 / 3
