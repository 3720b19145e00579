from __future__ import annotations

from pyspark.sql import functions as F

from footfall.operators.ordering import sort_products, sort_products_by_price, with_position
from footfall.sources.products import parse_products

LINES = ["desk 900 40", "lamp  70 5", "shelf 70 60", "hook 3 800"]


def products(spark):
    return parse_products(spark.createDataFrame([(x,) for x in LINES], "value string"))


def test_price_then_stock(spark):
    rows = sort_products(products(spark)).collect()
    assert [r.name for r in rows] == ["desk", "shelf", "lamp", "hook"]
    assert rows[2].asDict() == {"name": "lamp", "price": 70, "store": 5}


def test_price_only(spark):
    names = [r.name for r in sort_products_by_price(products(spark), F.col("name")).collect()]
    assert names == ["desk", "lamp", "shelf", "hook"]


def test_unreadable_numbers_become_null(spark):
    rows = parse_products(spark.createDataFrame([("a b c",), ("one",)], "value string")).collect()
    assert {tuple(r) for r in rows} == {("a", None, None), ("one", None, None)}


def test_positions_follow_the_order_without_one_task_for_all(spark, plan):
    rows = spark.range(0, 5000, 1, 7).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 1 ELSE id % 50 END AS price")
    numbered = with_position(rows.orderBy(F.desc("price"), "id"))
    expected = sorted(((i, 1 if i % 3 == 0 else i % 50) for i in range(5000)), key=lambda r: (-r[1], r[0]))
    found = {(r.id, r.price): r.position for r in numbered.collect()}
    assert found == {row: i for i, row in enumerate(expected, 1)}


def test_positions_of_nothing(spark):
    empty = spark.createDataFrame([], "price int")
    assert with_position(empty.orderBy("price")).collect() == []
