"""Stored tables with several writers, puts as runs, and upserts into loaded days."""

from __future__ import annotations

import os
import random
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from footfall.functions.keys import region_of
from footfall.operators.cells import upsert_cells
from footfall.operators.visits import dedup_visits
from footfall.schemas import CELL_SCHEMA
from footfall.sinks import tables, versions

TABLE = "rowkey string, formattime string, value string, day string"


@pytest.fixture
def split(spark):
    """One file per shuffle partition, however small."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def cells(spark, *rows):
    return spark.createDataFrame(list(rows), CELL_SCHEMA)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def files_of(root):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in Path(root).rglob("part-*.parquet")}


def test_regions_of_keys(spark):
    r = random.Random(3)
    for n in (0, 1, 2, 7, 30):
        bounds = sorted(r.sample([f"k{i:03d}" for i in range(200)], n))
        keys = [*(f"k{i:03d}" for i in range(200)), "", "z", None]
        rows = spark.createDataFrame([(k,) for k in keys], "key string").select("key", region_of("key", bounds).alias("n"))
        assert {x.key: x.n for x in rows.collect()} == {k: sum(b <= k for b in bounds) if k is not None else 0 for k in keys}


def test_two_puts_from_one_state_are_both_kept(spark, tmp_path, monkeypatch):
    """The second writer begins and ends between the first one's look at the table and its commit."""
    root = str(tmp_path / "cells")
    tables.write_cells(cells(spark, ("anna", "info", "a", 1, "1")), root)
    whole, calls = versions.commit, []

    def interleaved(*args):
        if not calls:
            calls.append(1)
            tables.put_cells(spark, root, cells(spark, ("boris", "info", "a", 2, "B")))
        return whole(*args)

    monkeypatch.setattr(versions, "commit", interleaved)
    tables.put_cells(spark, root, cells(spark, ("anna", "info", "a", 2, "A")))
    assert found(tables.read_cells(spark, root)) == [("anna", "info", "a", 2, "A"), ("boris", "info", "a", 2, "B")]


def test_one_of_two_equal_numbers_wins(spark, tmp_path):
    root = str(tmp_path / "t")
    base = versions.current(spark, root, "d")
    versions.commit(spark, root, "d", base, [versions.File("day=d/version=x")], {})
    with pytest.raises(versions.Conflict):
        versions.commit(spark, root, "d", base, [versions.File("day=d/version=y")], {})
    assert [f.path for f in versions.current(spark, root, "d").files] == ["day=d/version=x"]


def test_a_put_during_a_fold_stays(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "cells")
    tables.write_cells(cells(spark, ("anna", "info", "a", 1, "1")), root)
    tables.put_cells(spark, root, cells(spark, ("anna", "info", "a", 2, "2")))
    whole, calls = tables._store_cells, []

    def interleaved(*args):
        made = whole(*args)
        if not calls:
            calls.append(1)
            tables.put_cells(spark, root, cells(spark, ("anna", "info", "a", 3, "3"), ("cy", "info", "a", 3, "c")))
        return made

    monkeypatch.setattr(tables, "_store_cells", interleaved)
    tables.fold_cells(spark, root)
    version = versions.current(spark, root, tables.CELLS)
    assert version.runs() == [2]
    assert found(tables.read_cells(spark, root)) == [("anna", "info", "a", 3, "3"), ("cy", "info", "a", 3, "c")]


def test_a_put_writes_its_own_rows_only(spark, tmp_path):
    root = tmp_path / "cells"
    rows = [(f"k{i:04d}", "info", "a", 1, str(i)) for i in range(3000)]
    tables.write_cells(cells(spark, *rows), str(root))
    before = files_of(root)
    tables.put_cells(spark, str(root), cells(spark, ("k0007", "info", "a", 2, "x"), ("new", "other fam%", "a", 2, "y")))
    after = files_of(root)
    assert before.items() <= after.items()
    added = spark.read.schema(CELL_SCHEMA).parquet(*[str(root / f) for f in after.keys() - before.keys()])
    assert added.count() == 2
    assert found(tables.read_cells(spark, str(root), key="new")) == [("new", "other fam%", "a", 2, "y")]
    assert tables.read_cells(spark, str(root)).count() == 3001


@pytest.mark.parametrize("seed", [1, 2])
def test_puts_and_folds_equal_upserts(spark, tmp_path, seed):
    r, root = random.Random(seed), str(tmp_path / "cells")

    def drawn(n):
        rows = {(r.choice("abcdef"), r.choice(["f", "g"]), r.choice("pq"), r.randint(0, 5), str(r.randint(0, 9))) for _ in range(n)}
        return cells(spark, *sorted(rows))

    table = drawn(12)
    tables.write_cells(table, root)
    for k in range(4):
        changes = drawn(5)
        table = upsert_cells(table, changes)
        tables.put_cells(spark, root, changes, fold_after=2 if k == 2 else 0)
        assert found(tables.read_cells(spark, root)) == found(table)
    for key in "abz":
        assert found(tables.read_cells(spark, root, key=key)) == found(table.where(F.col("rowkey") == key))
    assert found(tables.read_cells(spark, root, "f")) == found(table.where("family = 'f'"))


def test_a_lookup_opens_the_files_that_may_hold_the_key(spark, tmp_path, split):
    root = str(tmp_path / "cells")
    tables.write_cells(cells(spark, *[(f"k{i:04d}", "info", "a", 1, str(i)) for i in range(4000)]), root)
    tables.put_cells(spark, root, cells(spark, ("k3999", "info", "a", 2, "x")))
    every = tables.read_cells(spark, root).inputFiles()
    one = tables.read_cells(spark, root, key="k0100")
    assert len(every) >= 8 and len(one.inputFiles()) == 1
    assert found(one) == [("k0100", "info", "a", 1, "100")]
    assert found(tables.read_cells(spark, root, key="k3999")) == [("k3999", "info", "a", 2, "x")]
    some = tables.read_cells(spark, root, prefix="k00")
    assert some.count() == 100 and len(some.inputFiles()) == 1
    assert tables.read_cells(spark, root, key="nobody").count() == 0
    assert tables.read_cells(spark, root, prefix="").count() == 4000


def merge(rows):
    return dedup_visits(rows, ["value"])


def table_rows(spark, rows):
    return spark.createDataFrame(rows, TABLE)


def test_upserts_equal_one_load(spark, tmp_path):
    r = random.Random(5)
    rows = [(f"k{r.randint(0, 60):02d}", str(r.randint(0, 3)), str(r.randint(0, 3)), r.choice("de")) for _ in range(300)]
    root = str(tmp_path / "t")
    tables.write_days(merge(table_rows(spark, rows[:100])), root, "rowkey")
    for part in (rows[100:110], rows[110:200] + [("k99", "1", "1", "new day")], rows[200:]):
        tables.upsert_days(table_rows(spark, part), root, merge)
    expected = merge(table_rows(spark, rows + [("k99", "1", "1", "new day")]))
    columns = ["rowkey", "formattime", "value", "day"]
    assert found(tables.read_days(spark, root, TABLE).select(columns)) == found(expected.select(columns))
    assert tables.read_days(spark, root, TABLE, key="k99").count() == 1


def test_an_upsert_rewrites_the_files_it_touches(spark, tmp_path, split):
    root = tmp_path / "t"
    rows = [(f"k{i:04d}", "1", "old", "d") for i in range(0, 8000, 2)]
    tables.write_days(table_rows(spark, rows), str(root), "rowkey")
    before = {f.path: f for f in versions.current(spark, str(root), "d").files}
    times = files_of(root)
    tables.upsert_days(table_rows(spark, [("k3001", "1", "new", "d"), ("k3002", "2", "new", "d")]), str(root), merge)
    after = {f.path for f in versions.current(spark, str(root), "d").files}
    touched = [f for f in before.values() if f.low <= "k3001" and (f.high >= "k3002")]
    assert len(before) == 8 and len(touched) == 1 and before.keys() - after == {touched[0].path}
    assert all(files_of(root)[path] == times[path] for path in before.keys() & after)
    stored = tables.read_days(spark, str(root), TABLE)
    assert stored.count() == 4001 and stored.where("value = 'new'").count() == 2
    tables.upsert_days(table_rows(spark, [("a", "1", "new", "d"), ("z", "1", "new", "d")]), str(root), merge)
    assert [r.rowkey for r in tables.read_days(spark, str(root), TABLE, key="z").collect()] == ["z"]
    assert [r.rowkey for r in tables.read_days(spark, str(root), TABLE, prefix="a").collect()] == ["a"]


def test_an_upsert_meets_another(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    tables.write_days(table_rows(spark, [("a", "1", "x", "d"), ("a", "1", "x", "e")]), root, "rowkey")
    whole, calls = versions.commit, []

    def interleaved(spark_, root_, day, *rest):
        if day == "d" and not calls:
            calls.append(1)
            tables.upsert_days(table_rows(spark, [("b", "1", "other", "d")]), root, merge)
        return whole(spark_, root_, day, *rest)

    monkeypatch.setattr(versions, "commit", interleaved)
    tables.upsert_days(table_rows(spark, [("c", "1", "mine", "d"), ("c", "1", "mine", "e")]), root, merge)
    stored = {(r.day, r.rowkey) for r in tables.read_days(spark, root, TABLE).collect()}
    assert stored == {("d", "a"), ("d", "b"), ("d", "c"), ("e", "a"), ("e", "c")}


def test_dead_writers_folders_go(spark, tmp_path, monkeypatch):
    root = tmp_path / "t"
    rows = table_rows(spark, [("a", "1", "x", "d")])

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(versions, "commit", dies)
        with pytest.raises(KeyboardInterrupt):
            tables.write_day(rows, str(root), "d")
    dead = next((root / "day=d").iterdir())
    for _ in range(3):
        tables.write_day(rows, str(root), "d")
    assert dead.exists() and len(list((root / "day=d").iterdir())) == 3  # it might still be at work
    os.utime(dead, (time.time() - 2 * versions.DEAD_AFTER,) * 2)
    tables.write_day(rows, str(root), "d")
    assert not dead.exists() and len(list((root / "day=d").iterdir())) == 2


def test_a_writer_that_died_in_its_commit(spark, tmp_path, monkeypatch):
    root = tmp_path / "t"
    tables.write_day(table_rows(spark, [("a", "1", "x", "d")]), str(root), "d")
    (root / versions.VERSIONS / f"d~{1:012d}").write_text('{"files": [')
    monkeypatch.setattr(versions, "UNFINISHED", 0.1)
    assert [r.value for r in tables.read_days(spark, str(root), TABLE).collect()] == ["x"]
    tables.write_day(table_rows(spark, [("a", "1", "y", "d")]), str(root), "d")
    assert [r.value for r in tables.read_days(spark, str(root), TABLE).collect()] == ["y"]


def test_many_days_are_listed_by_spark(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = [("k", "1", "x", f"d{i:02d}") for i in range(40)]
    tables.write_days(table_rows(spark, rows), root, "rowkey")
    assert tables.read_days(spark, root, TABLE).count() == 40
    assert tables.read_days(spark, root, TABLE, "d07").count() == 1


def test_the_catalog_reads_what_was_written(spark, tmp_path):
    root = str(tmp_path / "cells")
    tables.create_cell_table(spark, "people", root, ["info", "address"])
    try:
        tables.write_cells(cells(spark, ("anna", "info", "age", 1, "31"), ("anna", "it's 50%", "x", 1, "y")), root)
        tables.publish_cells(spark, "people", root)
        named = lambda: found(spark.table("people").select(*CELL_SCHEMA.names))
        assert named() == found(tables.read_cells(spark, root)) and len(named()) == 2
        families = {tuple(r) for r in tables.list_families(spark).collect()}
        assert families == {("people", f) for f in ("info", "address", "it's 50%")}
        tables.put_cells(spark, root, cells(spark, ("anna", "info", "age", 2, "32"), ("boris", "address", "city", 2, "z")))
        assert ("anna", "info", "age", 1, "31") in named()  # SQL stays at what was published
        tables.publish_cells(spark, "people", root)
        assert named() == found(tables.read_cells(spark, root)) and len(named()) == 3
        tables.write_cells(cells(spark, ("cy", "info", "age", 3, "1")), root)
        tables.publish_cells(spark, "people", root)
        assert named() == [("cy", "info", "age", 3, "1")]
        assert spark.sql("SELECT value FROM people WHERE family = 'info'").count() == 1
    finally:
        spark.sql("DROP TABLE people")
