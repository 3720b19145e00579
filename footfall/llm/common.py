"""What several operators of this subpackage share."""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.session import materialize, scratch_path

# A word: a run of anything but blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD)

MIX = 0x9E3779B97F4A7C15


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole(text: str | None) -> str:
    """A null text counts as an empty one."""
    return "" if text is None else text


_HELD: dict[str, object] = {}


def worker_cache(owner: str, make: Callable[[], object]) -> object:
    """What a Python worker keeps between tasks, for one owner at a time: what another one kept is let go.

    Workers live on from one operator to the next, so caches that only grew would add up. Arrow keeps the memory of
    freed batches too; it is asked to give that back when the owner changes.
    """
    if owner not in _HELD:
        _HELD.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        _HELD[owner] = make()
    return _HELD[owner]


class Tables:
    """Tables that an operator writes on its way, in the shared folder; each is dropped once nothing reads it.

    After each write the driver's JVM is asked to collect garbage: Spark drops the shuffle files of a finished step
    only then, and they would otherwise stay on the executors' disks until the operator ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def store(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        df.write.parquet(path)
        self.paths[label] = path
        self.spark._jvm.System.gc()
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *labels: str) -> None:
        for label in labels:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(label))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def n_words(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice has about ``most`` bytes of ``column``, one row at least."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def with_running_total(ordered: DataFrame, value: Column, name: str, position: str | None = None) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all rows before this one in a globally sorted DataFrame.

    ``position``, if given, is added as the number of rows before. The sorted rows are stored once, numbered inside
    their partition. A window per block of a partition adds up inside it, a second one adds up block totals inside a
    partition, and the partition totals, one row each, are added up by a third; so a window sees one block of 65,536
    rows, or one row per block of a partition, or one row per partition.
    """
    block_bits, row_bits = 16, 33
    number = F.monotonically_increasing_id().alias("id")
    stored = materialize(ordered.select(F.struct("*").alias("row"), value.cast("long").alias("v"), number), "sorted")
    block = F.shiftright("id", block_bits)
    sums = [F.sum("v").alias("v"), F.sum("n").alias("n")]
    totals = stored.withColumn("n", F.lit(1).cast("long")).groupBy(block.alias("block")).agg(*sums)
    totals = totals.withColumn("part", F.shiftright("block", row_bits - block_bits))

    def before(window):
        over = window.rowsBetween(Window.unboundedPreceding, -1)
        return {c: F.coalesce(F.sum(c).over(over), F.lit(0)) for c in ("v", "n")}

    parts = totals.groupBy("part").agg(*sums)
    parts = parts.select("part", *[c.alias(f"part_{k}") for k, c in before(Window.orderBy("part")).items()])
    in_part = before(Window.partitionBy("part").orderBy("block"))
    blocks = totals.withColumns({f"in_{k}": c for k, c in in_part.items()}).join(F.broadcast(parts), "part")
    blocks = blocks.select("block", *[(F.col(f"in_{k}") + F.col(f"part_{k}")).alias(f"block_{k}") for k in "vn"])
    rows = stored.withColumns({"n": F.lit(1).cast("long"), "block": block})
    rows = rows.withColumns({f"row_{k}": c for k, c in before(Window.partitionBy("block").orderBy("id")).items()})
    rows = rows.join(blocks, "block")
    found = [(F.col("block_v") + F.col("row_v")).alias(name)]
    if position:
        found.append((F.col("block_n") + F.col("row_n")).alias(position))
    return rows.select("row.*", *found)
