from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from footfall.operators import geo

RANGES = "lo bigint, hi bigint, country string, province string, city string"


def dotted(n: int) -> str:
    return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))


def random_ranges(seed: int, spread: int, count: int, base: int = 0):
    """Disjoint ranges between ``count`` pairs of random points, every third one left out."""
    cuts = sorted(random.Random(seed).sample(range(base, base + spread), 2 * count))
    pairs = list(zip(cuts[::2], cuts[1::2]))
    return [(lo, hi, f"C{i % 7}", f"P{i}", f"T{i}") for i, (lo, hi) in enumerate(pairs) if i % 3]


def brute(ips, ranges):
    answer = []
    for ip in ips:
        hit = [r for r in ranges if ip is not None and r[0] <= ip <= r[1]]
        answer.append((dotted(ip), *(hit[0][2:] if hit else ("unknown",) * 3)))
    return sorted(answer)


def probes(seed, ranges, spread, base=0):
    r = random.Random(seed)
    edges = [p for lo, hi, *_ in ranges for p in (lo - 1, lo, hi, hi + 1) if 0 <= p < 2**32]
    return edges + [r.randrange(base, base + spread) for _ in range(500)]


CASES = {
    "wide": (random_ranges(1, 2**32, 60), 2**32, 0),
    "one /16, dense": (random_ranges(2, 65536, 900, 10 << 24), 65536, 10 << 24),
    "mixed": (
        random_ranges(3, 65536, 900, (10 << 24) + 65536) + [((10 << 24) + 131072, (11 << 24), "W", "W", "W")],
        1 << 24,
        10 << 24,
    ),
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("limit", [128 << 20, 0], ids=["broadcast", "shuffled"])
def test_lookup_equals_brute_force(spark, plan, name, limit):
    ranges, spread, base = CASES[name]
    ips = probes(7, ranges, spread, base)
    table = spark.createDataFrame(ranges, RANGES)
    rows = spark.createDataFrame([(dotted(i),) for i in ips], "ip string")
    found = geo.with_geo(rows, table, broadcast_bytes=limit, salts=3)
    assert sorted(tuple(r) for r in found.collect()) == brute(ips, ranges)
    text = plan(found)
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_dense_blocks_keep_candidates_few(spark):
    ranges, _, _ = CASES["one /16, dense"]
    table = spark.createDataFrame(ranges, RANGES)
    assert geo.profile(table).densest > geo.DENSE
    lookup = geo._lookup(table, geo._dense_blocks(table))
    assert lookup.groupBy("_near").count().agg({"count": "max"}).first()[0] <= 256


def test_facts_do_not_shuffle_when_ranges_are_broadcast(spark, plan, tmp_path):
    spark.range(1000).selectExpr("concat('10.0.0.', id % 256) AS ip").write.parquet(str(tmp_path / "ips"))
    rows = spark.read.parquet(str(tmp_path / "ips"))
    text = plan(geo.with_geo(rows, spark.createDataFrame(CASES["wide"][0], RANGES)))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_unmatched_and_unreadable_addresses_stay(spark):
    rows = spark.createDataFrame([("10.0.0.1",), ("::1",), (None,), ("9.9.9.9",)], "ip string")
    table = spark.createDataFrame([(10 << 24, (10 << 24) + 5, "C", "P", "T")], RANGES)
    found = {r.ip: r.country for r in geo.with_geo(rows, table).collect()}
    assert found == {"10.0.0.1": "C", "::1": "unknown", None: "unknown", "9.9.9.9": "unknown"}
    assert {r.country for r in geo.with_geo(rows, table, unknown=None).collect()} == {"C", None}


@pytest.mark.parametrize(
    "ranges",
    [
        [(5, 10), (10, 20)],
        [(0, 2**31), (70000, 70001)],
        [(5, 10), (5, 10)],
        [(10, 5)],
        [(None, 5)],
        [(-1, 5)],
        [(5, 2**32)],
    ],
)
def test_bad_ranges_are_refused(spark, ranges):
    table = spark.createDataFrame([(*r, "C", "P", "T") for r in ranges], RANGES)
    with pytest.raises(ValueError, match="range table"):
        geo.with_geo(spark.createDataFrame([("1.1.1.1",)], "ip string"), table)


def test_no_ranges_at_all(spark):
    rows = spark.createDataFrame([("1.1.1.1",)], "ip string")
    assert geo.with_geo(rows, spark.createDataFrame([], RANGES)).first().country == "unknown"


def test_a_hot_address_is_shared_by_several_tasks(spark):
    """Beyond the broadcast limit, with a third of all rows on one address and no other column."""
    rows = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN '10.0.0.7' ELSE concat('10.0.', id % 200, '.9') END AS ip")
    table = spark.createDataFrame(
        [(10 << 24, (10 << 24) + 65535, "C", "P", "T")],
        "lo bigint, hi bigint, country string, province string, city string",
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = geo.with_geo(rows, table, broadcast_bytes=0, salts=16).withColumn("p", F.spark_partition_id())
        hot = found.where("ip = '10.0.0.7'").groupBy("p").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["count"] for r in hot) == 1000
    assert len(hot) >= 4 and max(r["count"] for r in hot) < 500
