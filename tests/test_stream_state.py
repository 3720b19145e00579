"""State store totals, repeated messages, and streams that go on without their checkpoint."""

from __future__ import annotations

import json
import os
import shutil
import time

import pytest
from pyspark.sql import functions as F
from test_streaming import BATCHES, batch_twin, message, rejects, rejects_twin, run, totals
from test_streaming import arrive as arrive_now

from footfall.sources.orders import from_topic, read_files
from footfall.streaming import order_stream as o


def arrive(folder, number, lines):
    """Files are taken in the order of their times, which must differ."""
    arrive_now(folder, number, lines)
    os.utime(folder / f"{number:03}.txt", (1_700_000_000 + number,) * 2)


def windows(spark, tmp_path, **options):
    query = o.start_window_stream(
        read_files(spark, str(tmp_path / "in"), maxFilesPerTrigger="1"), str(tmp_path / "windows"), str(tmp_path / "state"),
        every=None, **options,
    )
    query.awaitTermination()
    rows = o.read_windows(spark, str(tmp_path / "windows")).collect()
    return query, {r.day + r.hour + r.minute: (r.total, r.success, r.fee) for r in rows}


def test_windows_equal_the_batch_and_are_dropped_from_the_state(spark, tmp_path):
    hour = [[message(f"20240101{h:02}{m:02}00", 1) for m in range(60)] for h in range(6)]
    for number, lines in enumerate(hour):
        arrive(tmp_path / "in", number, lines + ["broken"])
    query, found = windows(spark, tmp_path, watermark="30 minutes")
    assert found == {f"20240101{h:02}{m:02}": (1, 1, 1) for h in range(6) for m in range(60)}
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(kept) < 180 and kept[-1] < 100
    # An open window grows, a closed one does not.
    arrive(tmp_path / "in", 6, [message("20240101055500", 5), message("20240101000000", 7)])
    query, found = windows(spark, tmp_path, watermark="30 minutes")
    assert found["202401010555"] == (2, 2, 6) and found["202401010000"] == (1, 1, 1)
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress if p["stateOperators"]) == 1


def test_windows_survive_one_wrong_clock_and_folds(spark, tmp_path):
    arrive(tmp_path / "in", 0, [message("99990101000000", 1), message("20240101000000", 2)])
    windows(spark, tmp_path, watermark="20000 days", compact_every=1)
    arrive(tmp_path / "in", 1, [message("20240101000001", 3), message("20240101000100", 4, paid=False)])
    _, found = windows(spark, tmp_path, watermark="20000 days", compact_every=1)
    assert found == {"999901010000": (1, 1, 1), "202401010000": (2, 2, 5), "202401010001": (1, 0, 0)}


def tasks_of(spark, group, work):
    """Numbers of tasks of the stages that ``work`` runs under a job group."""
    jobs = spark.sparkContext.statusTracker()
    work()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = [s for j in jobs.getJobIdsForGroup(group()) for s in jobs.getJobInfo(j).stageIds]
    return [info.numTasks for info in map(jobs.getStageInfo, stages) if info]


@pytest.fixture
def three_parts(spark):
    """Three shuffle partitions, which stay as they are, as in a stream with a state."""
    changed = {"spark.sql.shuffle.partitions": "3", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    yield
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for key, value in before.items():
        spark.conf.set(key, value)


def test_no_task_holds_all_windows_of_the_state(spark, tmp_path, three_parts):
    arrive(tmp_path / "in", 0, [message(f"202401{d:02}00{m:02}00", 1) for d in (1, 2) for m in range(60)])
    held = []
    assert 3 in tasks_of(spark, lambda: str(held[0][0].runId), lambda: held.append(windows(spark, tmp_path)))
    assert len(held[0][1]) == 120


def test_no_task_holds_all_totals_of_a_batch(spark, tmp_path, three_parts):
    arrive(tmp_path / "in", 0, [message(f"202401{d:02}00{m:02}00", 1) for d in (1, 2) for m in range(60)])
    write = o.batch_writer(str(tmp_path / "totals"), str(tmp_path / "rejects"))
    batch = o.parse_orders(spark.read.text(str(tmp_path / "in")))
    spark.sparkContext.setJobGroup("one batch", "one batch")
    assert 3 in tasks_of(spark, lambda: "one batch", lambda: write(batch, 0))
    assert o.read_minutes(spark, str(tmp_path / "totals")).count() == 120


def order(number, fee=1):
    return json.dumps({"time": "20240101090000", "userid": "1", "courseid": "2", "fee": str(fee), "flag": "1", "orderid": number})


def test_orders_sent_twice_count_once(spark, tmp_path):
    nameless = message("20240101090000", 100).replace('"x"', "null")
    arrive(tmp_path / "in", 0, [order("a"), order("b"), order("a"), nameless, nameless, "broken", "broken"])
    arrive(tmp_path / "in", 1, [order("b"), order("c")])
    run(spark, tmp_path, distinct="1 hour")
    arrive(tmp_path / "in", 2, [order("a"), order("d"), nameless])
    run(spark, tmp_path, distinct="1 hour")
    assert [r[4:] for r in totals(spark, tmp_path) if r[0] == "day"] == [(7, 7, 304)]
    assert rejects(spark, tmp_path) == [("broken", "json")] * 2


def test_ids_are_forgotten(spark, tmp_path):
    arrive(tmp_path / "in", 0, [order(str(i)) for i in range(50)])
    run(spark, tmp_path, distinct="1 second")
    for number in (1, 2, 3):
        arrive(tmp_path / "in", number, [order(f"later {number}")])
        query = run(spark, tmp_path, distinct="1 second")
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert states[-1] < 50


@pytest.mark.parametrize("compact_every", [0, 1, 2])
def test_a_stream_without_its_checkpoint_loses_and_doubles_nothing(spark, tmp_path, compact_every):
    seen = []
    for number, lines in enumerate([*BATCHES, BATCHES[0], ["broken"]]):
        arrive(tmp_path / "in", number, lines)
        seen += lines
        run(spark, tmp_path, compact_every=compact_every)
        run(spark, tmp_path, compact_every=compact_every)
        assert totals(spark, tmp_path) == batch_twin(spark, seen)
        assert rejects(spark, tmp_path) == rejects_twin(spark, seen)
        if number != 1:
            shutil.rmtree(tmp_path / "checkpoint")


def test_a_replay_after_a_lost_checkpoint_counts_once(spark, tmp_path):
    arrive(tmp_path / "in", 0, BATCHES[0])
    run(spark, tmp_path)
    shutil.rmtree(tmp_path / "checkpoint")
    arrive(tmp_path / "in", 1, BATCHES[1])
    run(spark, tmp_path)
    for name in ("commits/0", "commits/.0.crc"):
        (tmp_path / "checkpoint" / name).unlink(missing_ok=True)
    run(spark, tmp_path)
    assert totals(spark, tmp_path) == batch_twin(spark, BATCHES[0] + BATCHES[1])


def test_an_unfinished_batch_is_not_in_the_ledger(spark, tmp_path):
    arrive(tmp_path / "in", 0, BATCHES[0])
    arrive(tmp_path / "in", 1, BATCHES[1])
    run(spark, tmp_path)
    shutil.rmtree(tmp_path / "totals" / "batch-000000000001")
    shutil.rmtree(tmp_path / "checkpoint")
    run(spark, tmp_path)
    assert totals(spark, tmp_path) == batch_twin(spark, BATCHES[0] + BATCHES[1])


def test_offsets_of_topic_partitions(spark, tmp_path):
    rows = [(b"{}", "my-topic", 0, 4), (b"{}", "my-topic", 0, 9), (b"{}", "my-topic", 3, 1), (b"{}", "other", 0, 0)]
    records = spark.createDataFrame(rows, "value binary, topic string, partition int, offset bigint")
    store = o.batch_writer(str(tmp_path / "totals"), str(tmp_path / "rejects"))
    assert o.starting_offsets(spark, str(tmp_path / "totals")) is None
    store(o.parse_orders(from_topic(records)), 0)
    found = json.loads(o.starting_offsets(spark, str(tmp_path / "totals")))
    assert found == {"my-topic": {"0": 10, "3": 2}, "other": {"0": 1}}


def test_one_wrong_clock_does_not_close_all_days(spark, tmp_path):
    arrive(tmp_path / "in", 0, [message("99990101000000", 1), message("20240105000000", 2)])
    arrive(tmp_path / "in", 1, [message("20240104120000", 4), message("20240101000000", 8)])
    run(spark, tmp_path, watermark="2 days")
    run(spark, tmp_path, watermark="2 days")
    assert [r[4:] for r in totals(spark, tmp_path) if r[0] == "day"] == [(1, 1, 4), (1, 1, 2)]
    assert sorted(reason for _, reason in rejects(spark, tmp_path)) == ["future", "late"]


def test_rejects_are_folded_and_empty_ones_not_written(spark, tmp_path):
    lines = [["broken"], [message("20240101000000", 1)], ["worse", message("20240101000000", 1)], [message("20240101000000", 1)]]
    for number, batch in enumerate(lines):
        arrive(tmp_path / "in", number, batch)
    run(spark, tmp_path, compact_every=0)
    root = tmp_path / "totals_rejects"
    assert sorted(p.name for p in root.iterdir()) == ["batch-000000000000", "batch-000000000002"]
    o.compact_rejects(spark, str(tmp_path / "totals"), str(root))
    arrive(tmp_path / "in", 4, ["last"])
    run(spark, tmp_path, compact_every=1)
    assert sorted(r[0] for r in rejects(spark, tmp_path)) == ["broken", "last", "worse"]
    assert sorted(p.name.split("-")[0] for p in root.iterdir()) == ["batch", "fold", "fold"]
    assert spark.read.parquet(str(root / "fold*")).where(F.col("value") == "worse").count() == 1


def test_batches_are_counted_as_they_pass(spark, tmp_path):
    seen = []
    listener = o.add_counts(spark, lambda *counts: seen.append(counts))
    try:
        arrive(tmp_path / "in", 0, BATCHES[0])
        arrive(tmp_path / "in", 1, BATCHES[1])
        run(spark, tmp_path)
        deadline = time.time() + 20
        while len(seen) < 2 and time.time() < deadline:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert seen == [(0, 2, 1), (1, 2, 0)]
