"""Token-id files: every document compressed on its own against one shared zstandard dictionary.

A folder holds two tables. ``blocks`` has a row per run of consecutive documents: their keys, token counts and frame
ends (the offset index), the dictionary's hash and the concatenated frames. ``dictionary`` has the one dictionary,
its hash and the width of an id in bytes. A short document is read by its key's block, its frame's place and the
dictionary alone (``lookup``); readers refuse a dictionary whose hash is not the block's.

The dictionary is trained on serialized id arrays of at most ``SAMPLE`` documents of up to ``SAMPLE_CHARS`` characters,
those with the least hash of their key. Everything else covers all documents. Files go to a folder that all executors
reach, written and read by Spark. Where too few samples exist to train, the samples themselves serve as dictionary.

Defined results: keys ascend, null keys first, ties in the order in which they are read; null and empty texts are the end id alone; repeated rows
are documents of their own; an empty table gives an empty table. Only key and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import partitions, slices, whole
from footfall.llm.tokens import Encoder, checksum, encoder, vocabulary
from footfall.session import scratch_path

END = 0
SAMPLE = 2000
SAMPLE_CHARS = 16384
DICTIONARY = 1 << 16  # bytes
LEVEL = 3
BLOCK = 1 << 21  # compressed bytes, about
BLOCK_DOCS = 4096


def train(docs: DataFrame, coder: Encoder) -> bytes:
    """The dictionary, from a bounded sample of ``docs`` (key, text)."""
    short = docs.where(F.length("text") <= SAMPLE_CHARS).withColumn("h", F.xxhash64("key"))
    last = short.select("h").orderBy("h").limit(SAMPLE).agg(F.max("h")).first()[0]
    if last is None:
        return b""
    rows = short.where(F.col("h") <= last).select("text").orderBy("h", F.xxhash64("text")).limit(SAMPLE)
    texts = [r["text"] for r in rows.toLocalIterator()]
    samples = [s for s in coder.encode(sorted(texts)) if s]
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY]


def _dictionary(held: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(held) if held else None


def write(docs: DataFrame, folder: str, path: str, key: str = "doc_id", text: str = "text", end: int = END) -> None:
    """Encode all documents with the vocabulary file at ``path`` and write them to ``folder`` in key order."""
    spark = docs.sparkSession
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    words = vocabulary(path)
    coder = encoder(words)
    held = train(docs, coder)
    name, width = sha256(held).hexdigest(), coder.width
    spark.createDataFrame([(name, held, width)], "hash string, bytes binary, width int").coalesce(1).write.parquet(
        f"{folder}/dictionary"
    )
    shared = spark.sparkContext.broadcast((words, held))
    kind = docs.schema["key"].dataType
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("block", T.LongType()),
            T.StructField("first_key", kind),
            T.StructField("last_key", kind),
            T.StructField("keys", T.ArrayType(kind)),
            T.StructField("counts", T.ArrayType(T.LongType())),
            T.StructField("ends", T.ArrayType(T.LongType())),
            T.StructField("dictionary", T.StringType()),
            T.StructField("frames", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, part, number = to_arrow_schema(schema), TaskContext.get().partitionId(), 0
        coder = encoder(shared.value[0])
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(shared.value[1]), write_dict_id=False)
        last = np.array([end], f"<u{width}").tobytes()
        keys, counts, frames, size = [], [], [], 0

        def block():
            row = {
                "part": part, "block": number, "first_key": keys[0], "last_key": keys[-1], "keys": keys, "counts": counts,
                "ends": np.cumsum([len(f) for f in frames]).tolist(), "dictionary": name, "frames": b"".join(frames),
            }
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for batch in slices(batches, "text"):
            coded = coder.encode([whole(t) for t in batch.column("text").to_pylist()])
            for one, ids in zip(batch.column("key").to_pylist(), coded):
                frame = press.compress(ids + last)
                keys.append(one)
                counts.append(len(ids) // width + 1)
                frames.append(frame)
                size += len(frame)
                if size >= BLOCK or len(keys) >= BLOCK_DOCS:
                    yield block()
                    keys, counts, frames, size, number = [], [], [], 0, number + 1
        if keys:
            yield block()

    # The row number splits a key that very many rows share. No text is read to place the ranges.
    order = [F.col("key").asc_nulls_first(), "number"]
    ranged = docs.withColumn("number", F.monotonically_increasing_id()).repartitionByRange(partitions(spark), *order)
    ordered = ranged.sortWithinPartitions(*order).select("key", "text")
    ordered.mapInArrow(run, schema).write.option("compression", "none").parquet(f"{folder}/blocks")


def _held(spark: SparkSession, folder: str):
    """The dictionary row, broadcast: DICTIONARY bytes at most."""
    row = spark.read.parquet(f"{folder}/dictionary").first()
    return spark.sparkContext.broadcast((row["hash"], bytes(row["bytes"]), row["width"]))


def _decoded(blocks: DataFrame, held, schema: T.StructType, rows) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        name, raw, width = held.value
        expand = zstandard.ZstdDecompressor(dict_data=_dictionary(raw))
        arrow = to_arrow_schema(schema)
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.slice(i, 1).to_pylist()[0]
                if block["dictionary"] != name:
                    raise ValueError(f"block needs dictionary {block['dictionary']}, the folder has {name}")
                starts = [0, *block["ends"][:-1]]
                ids = lambda k, b=block, s=starts: np.frombuffer(
                    expand.decompress(b["frames"][s[k] : b["ends"][k]]), f"<u{width}"
                )
                if found := rows(block, ids):
                    yield pa.RecordBatch.from_pylist(found, schema=arrow)

    return blocks.mapInArrow(run, schema)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document in the files: key, start (ids of all documents before it), n_tokens, ids_crc32."""
    blocks = spark.read.parquet(f"{folder}/blocks")
    kind = blocks.schema["first_key"].dataType
    longs = [T.StructField(c, T.LongType()) for c in ("block", "inside", "n_tokens", "ids_crc32")]
    schema = T.StructType([T.StructField("key", kind), T.StructField("part", T.IntegerType()), *longs])

    def rows(block, ids):
        before, found = 0, []
        for k, key in enumerate(block["keys"]):
            got = ids(k)
            found.append(
                {"key": key, "part": block["part"], "block": block["block"], "inside": before, "n_tokens": len(got), "ids_crc32": checksum(got)}
            )
            before += len(got)
        return found

    decoded = _decoded(blocks, _held(spark, folder), schema, rows)
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    sums = blocks.select("part", "block", total.alias("n"))
    earlier = (Window.unboundedPreceding, -1)
    # One row per sort partition, then one row per block of a partition.
    parts = sums.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*earlier)), F.lit(0)).alias("before"))
    in_part = Window.partitionBy("part").orderBy("block").rowsBetween(*earlier)
    starts = sums.withColumn("in_part", F.coalesce(F.sum("n").over(in_part), F.lit(0))).join(F.broadcast(parts), "part")
    starts = starts.select("part", "block", (F.col("before") + F.col("in_part")).alias("first"))
    joined = decoded.join(starts, ["part", "block"])
    return joined.select("key", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def lookup(spark: SparkSession, folder: str, key) -> DataFrame:
    """(key, ids) of the documents with a key, which may be null: only their blocks are read, only their frames expanded."""
    # Null keys come first, so a block that begins with one may go on with any.
    begins = F.col("first_key").isNull()
    holds = begins if key is None else (begins | (F.col("first_key") <= key)) & (F.col("last_key") >= key)
    blocks = spark.read.parquet(f"{folder}/blocks").where(holds)
    schema = T.StructType(
        [T.StructField("key", blocks.schema["first_key"].dataType), T.StructField("ids", T.ArrayType(T.LongType()))]
    )

    def rows(block, ids):
        return [{"key": key, "ids": ids(k).tolist()} for k, one in enumerate(block["keys"]) if one == key]

    return _decoded(blocks, _held(spark, folder), schema, rows)


def round_trip(docs: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """Write all documents to a fresh shared folder and read them back: key, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token_files")
    write(docs, folder, path, key)
    return documents(spark, folder).withColumnRenamed("key", key)
