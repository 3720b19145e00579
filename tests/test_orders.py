from __future__ import annotations

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from footfall.operators import order_stats as s
from footfall.schemas import ORDER_FIELDS
from footfall.sources.orders import accepted_orders, kafka_options, parse_orders, rejected_orders, to_messages


def message(**changes) -> str:
    order = {"time": "20240101093015", "userid": "7", "courseid": "3", "fee": "12", "flag": "1", "orderid": "o"}
    order.update(changes)
    return json.dumps({k: v for k, v in order.items() if v != "absent"})


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_good_orders(spark):
    values = [
        message(),
        message(flag=1, fee=12),  # numbers instead of quoted text
        message(flag=None),
        message(flag="absent"),
        message(flag="0", fee="abc"),
        message(flag="0", fee=None),
        message(time="202401010930"),
        message(extra="field"),
    ]
    parsed = parse_orders(frame(spark, *values))
    assert rejected_orders(parsed).collect() == []
    rows = accepted_orders(parsed).collect()
    assert len(rows) == len(values)
    assert {(r.day, r.hour, r.minute) for r in rows} == {("20240101", "09", "30")}
    assert s.order_stats(accepted_orders(parsed), "day").first().asDict() == {
        "day": "20240101", "total": 8, "success": 4, "fee": 48,
    }


def test_bad_orders_are_set_aside(spark):
    bad = {
        "not json": "json",
        '{"time": "20240101093015", "fee": ': "json",
        message(time="202401"): "time",
        message(time=None): "time",
        message(time="absent"): "time",
        message(time="not a time at all"): "time",
        message(time="2024-01-01 10:00:00"): "time",
        message(time="20241301093015"): "time",
        message(time="20240230093015"): "time",
        message(time="20240101243015"): "time",
        message(time="20240101096015"): "time",
        message(fee="abc"): "fee",
        message(fee="12.5"): "fee",
        message(fee=None): "fee",
    }
    parsed = parse_orders(frame(spark, *bad, message()))
    assert {r.value: r.reject_reason for r in rejected_orders(parsed).collect()} == bad
    assert accepted_orders(parsed).count() == 1
    assert rejected_orders(parse_orders(frame(spark, None))).first().reject_reason == "json"


def test_a_day_without_paid_orders_still_counts(spark):
    rows = accepted_orders(parse_orders(frame(spark, message(flag="0"), message(time="20240102000000"))))
    assert {tuple(r) for r in s.paid_count_per_day(rows).collect()} == {("20240101", 0), ("20240102", 1)}
    assert {tuple(r) for r in s.paid_fee_per_day(rows).collect()} == {("20240101", 0), ("20240102", 12)}


def test_keys_and_fields(spark):
    rows = accepted_orders(parse_orders(frame(spark, message(), message(flag="0", time="20240101103000"))))
    counters = {r.key: r.value for r in s.to_counters(s.order_stats(rows, "day")).collect()}
    assert counters == {"ImoocCount-20240101": 1, "ImoocFee-20240101": 12}
    fields = {(r.key, r.field): r.value for r in s.to_hash_fields(s.order_stats_all_grains(rows)).collect()}
    key = "Imooc-20240101"
    assert fields == {
        (key, "total"): 2, (key, "success"): 1, (key, "fee"): 12,
        (key, "total09"): 1, (key, "success09"): 1, (key, "fee09"): 12,
        (key, "total10"): 1, (key, "success10"): 0, (key, "fee10"): 0,
    }


orders = st.lists(
    st.tuples(
        st.sampled_from(["20240101", "20240102"]), st.integers(0, 2), st.integers(0, 3), st.integers(0, 399), st.booleans()
    ),
    min_size=1,
    max_size=30,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(orders)
def test_grains_add_up_and_equal_the_single_ones(spark, data):
    texts = [message(time=f"{d}{h:02}{m:02}00", fee=str(f), flag="01"[p]) for d, h, m, f, p in data]
    rows = accepted_orders(parse_orders(frame(spark, *texts)))
    rolled = sorted(map(tuple, s.order_stats_all_grains(rows).collect()), key=str)
    for grain in ("day", "hour", "minute"):
        single = {tuple(r) for r in s.order_stats(rows, grain).collect()}
        assert single == {tuple(x for x in r[1:] if x is not None) for r in rolled if r[0] == grain}
        part = [r for r in rolled if r[0] == grain]
        assert sum(r[4] for r in part) == len(data)
        assert sum(r[5] for r in part) == sum(p for *_, p in data)
        assert sum(r[6] for r in part) == sum(f for *_, f, p in data if p)


def test_messages_round_trip(spark):
    rows = accepted_orders(parse_orders(frame(spark, message(), message(fee="3", flag="0")))).select(*ORDER_FIELDS)
    again = accepted_orders(parse_orders(to_messages(rows))).select(*ORDER_FIELDS)
    assert sorted(rows.collect()) == sorted(again.collect())


def test_json_is_parsed_once_and_in_the_jvm(spark, plan):
    text = plan(s.order_stats_all_grains(accepted_orders(parse_orders(frame(spark, message())))))
    assert text.count("from_json(") == 1
    assert "Python" not in text


def test_kafka_options():
    assert kafka_options("h:9092", ["a", "b-c"], maxOffsetsPerTrigger="10") == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "a,b-c",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "10",
    }
