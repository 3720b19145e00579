from __future__ import annotations

import json
import shutil

from footfall.operators import order_stats as s
from footfall.sources.orders import accepted_orders, parse_orders, read_files, rejected_orders
from footfall.streaming import order_stream as o

SCHEMA = "value string"


def message(time, fee, paid=True):
    return json.dumps({"time": time, "userid": "1", "courseid": "2", "fee": str(fee), "flag": "01"[paid], "orderid": "x"})


BATCHES = [
    [message("20240101090000", 10), message("20240101090500", 5, paid=False), "broken"],
    [message("20240101100000", 7), message("20240102000000", 1)],
    [message("20240101090059", 100), message("20240103000000", 2, paid=False), message("2024", 3)],
]


def arrive(folder, number, lines):
    folder.mkdir(exist_ok=True)
    (folder / f"{number:03}.txt").write_text("\n".join(lines) + "\n")


def run(spark, tmp_path, **options):
    query = o.start_order_stream(
        read_files(spark, str(tmp_path / "in"), maxFilesPerTrigger="1"),
        str(tmp_path / "totals"), str(tmp_path / "checkpoint"), every=None, **options,
    )
    query.awaitTermination()
    return query


def totals(spark, tmp_path):
    return sorted((tuple(r) for r in o.read_totals(spark, str(tmp_path / "totals")).collect()), key=str)


def rejects(spark, tmp_path):
    return sorted(tuple(r) for r in o.read_rejects(spark, str(tmp_path / "totals_rejects")).collect())


def rejects_twin(spark, lines):
    parsed = parse_orders(spark.createDataFrame([(x,) for x in lines], SCHEMA))
    return sorted(tuple(r) for r in rejected_orders(parsed).collect())


def batch_twin(spark, lines):
    rows = accepted_orders(parse_orders(spark.createDataFrame([(x,) for x in lines], SCHEMA)))
    return sorted(map(tuple, s.order_stats_all_grains(rows).collect()), key=str)


def test_stream_equals_batch_over_restarts(spark, tmp_path):
    seen = []
    for number, lines in enumerate(BATCHES):
        arrive(tmp_path / "in", number, lines)
        seen += lines
        run(spark, tmp_path)
        assert totals(spark, tmp_path) == batch_twin(spark, seen)
        assert rejects(spark, tmp_path) == rejects_twin(spark, seen)
    run(spark, tmp_path)
    assert totals(spark, tmp_path) == batch_twin(spark, seen)


def test_late_orders_count_towards_their_own_day(spark, tmp_path):
    for number, lines in enumerate(BATCHES):
        arrive(tmp_path / "in", number, lines)
    query = run(spark, tmp_path)
    day = {r[1]: r[4:] for r in totals(spark, tmp_path) if r[0] == "day"}
    assert day == {"20240101": (4, 3, 117), "20240102": (1, 1, 1), "20240103": (1, 0, 0)}
    assert o.offset_ranges(query)[0]["end"] is not None


def test_a_replayed_batch_is_not_counted_twice(spark, tmp_path):
    arrive(tmp_path / "in", 0, BATCHES[0])
    arrive(tmp_path / "in", 1, BATCHES[1])
    run(spark, tmp_path)
    expected = totals(spark, tmp_path)
    # Forget that batch 1 was finished, as after a crash between sink and commit.
    for name in ("commits/1", "commits/.1.crc"):
        (tmp_path / "checkpoint" / name).unlink(missing_ok=True)
    query = run(spark, tmp_path)
    assert query.lastProgress["batchId"] == 1
    assert rejects(spark, tmp_path) == rejects_twin(spark, BATCHES[0] + BATCHES[1])
    assert totals(spark, tmp_path) == expected == batch_twin(spark, BATCHES[0] + BATCHES[1])


def test_a_batch_lost_after_its_offsets_were_logged_is_done_again(spark, tmp_path):
    arrive(tmp_path / "in", 0, BATCHES[0])
    run(spark, tmp_path)
    (tmp_path / "checkpoint" / "commits" / "0").unlink()
    (tmp_path / "checkpoint" / "commits" / ".0.crc").unlink(missing_ok=True)
    shutil.move(tmp_path / "totals" / "batch-000000000000", tmp_path / "lost")
    run(spark, tmp_path)
    assert totals(spark, tmp_path) == batch_twin(spark, BATCHES[0])


def test_folding_batches_keeps_the_totals_and_open_readers(spark, tmp_path):
    arrive(tmp_path / "in", 0, BATCHES[0])
    arrive(tmp_path / "in", 1, BATCHES[1])
    run(spark, tmp_path, compact_every=2)
    root = str(tmp_path / "totals")
    early = o.read_minutes(spark, root)
    expected = sorted(map(tuple, early.collect()))
    arrive(tmp_path / "in", 2, BATCHES[2])
    run(spark, tmp_path, compact_every=0)
    everything = [line for lines in BATCHES for line in lines]
    assert totals(spark, tmp_path) == batch_twin(spark, everything)
    o.compact_totals(spark, root)
    o.compact_totals(spark, root)
    assert totals(spark, tmp_path) == batch_twin(spark, everything)
    # The fold before and what came after it are still there.
    assert sorted(map(tuple, early.collect())) == expected
    names = sorted(p.name.split("-")[0] for p in (tmp_path / "totals").iterdir() if p.is_dir())
    assert names == ["batch", "fold", "fold"]


def test_an_unfinished_folder_is_not_read(spark, tmp_path):
    arrive(tmp_path / "in", 0, BATCHES[0])
    run(spark, tmp_path)
    shutil.copytree(tmp_path / "totals" / "batch-000000000000", tmp_path / "totals" / "fold-000000000000-x")
    (tmp_path / "totals" / "fold-000000000000-x" / "_SUCCESS").unlink()
    assert totals(spark, tmp_path) == batch_twin(spark, BATCHES[0])
    assert o.read_totals(spark, str(tmp_path / "nothing")).count() == 0


def test_counters_and_hash_fields_are_stored(spark, tmp_path):
    arrive(tmp_path / "in", 0, BATCHES[0])
    run(spark, tmp_path)
    o.store_lookups(spark, str(tmp_path / "totals"), str(tmp_path / "lookups"))
    counters = {r.key: r.value for r in spark.read.parquet(str(tmp_path / "lookups" / "counters")).collect()}
    assert counters == {"ImoocCount-20240101": 1, "ImoocFee-20240101": 10}
    assert spark.read.parquet(str(tmp_path / "lookups" / "hash_fields")).where("field = 'total09'").first().value == 2


def test_a_watermark_closes_old_days(spark, tmp_path):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        batches = [
            [message("20240101003000", 1), message("20240101233000", 2)],
            [message("20240110120000", 4)],
            [message("20240101120000", 8), message("20240110000000", 16)],
        ]
        for number, lines in enumerate(batches):
            arrive(tmp_path / "in", number, lines)
            run(spark, tmp_path, watermark="2 days")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    day = {r[1]: r[4:] for r in totals(spark, tmp_path) if r[0] == "day"}
    assert day == {"20240101": (2, 2, 3), "20240110": (2, 2, 20)}
    assert rejects(spark, tmp_path) == [(message("20240101120000", 8), "late")]


def test_interval_trigger_starts_and_stops(spark, tmp_path):
    arrive(tmp_path / "in", 0, BATCHES[0])
    query = o.start_order_stream(
        read_files(spark, str(tmp_path / "in")), str(tmp_path / "totals"), str(tmp_path / "checkpoint"), every="1 second"
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert totals(spark, tmp_path) == batch_twin(spark, BATCHES[0])
