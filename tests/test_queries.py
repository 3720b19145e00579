from __future__ import annotations

import ast
from pathlib import Path

import pytest
from check_oracle import connect, difference

from footfall.plans.oracle import ORACLE
from footfall.plans.queries import QUERIES

ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def duck():
    return connect("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql_twin(spark, duck, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) is None


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    import __spark_entry__ as entry

    rows = entry.entry(spark)
    assert rows.columns == ["country", "province", "cnt"] and rows.count() == 10
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["visits_by_region", "visit_cells", "order_stats_all_grains", "cells_to_row"])
def test_plans_stay_in_the_jvm_without_cross_joins(spark, plan, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for word in ("Python", "Cartesian", "NestedLoop", "SinglePartition"):
        assert word not in text


def test_scans_read_only_needed_columns(spark, plan, sf_dir):
    assert "ReadSchema: struct<c_name:string,c_mktsegment:string>" in plan(QUERIES["column_scan"](spark, sf_dir))
    get = plan(QUERIES["rowkey_get"](spark, sf_dir))
    assert "EqualTo(c_name,Customer#000000042)" in get and "EqualTo(s_name,Customer#000000042)" in get
    prefix = plan(QUERIES["rowkey_prefix_scan"](spark, sf_dir))
    assert "StringStartsWith(c_name,Customer#0000001)" in prefix


def test_stored_visits_are_read_three_columns_wide(spark, plan, sf_dir):
    text = plan(QUERIES["visit_scan_projected"](spark, sf_dir))
    assert "ReadSchema: struct<country:string,province:string,browsername:string>" in text


def test_code_uses_no_rdd_transformations_and_no_local_checkpoint():
    for path in (p for p in (ROOT / "footfall").rglob("*.py") if "llm" not in p.parts):
        names = {n.attr for n in ast.walk(ast.parse(path.read_text())) if isinstance(n, ast.Attribute)}
        assert not names & {"localCheckpoint", "mapPartitions", "toPandas", "udf", "pandas_udf", "crossJoin"}, path
