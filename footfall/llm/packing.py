"""Best-fit packing of token sequences by minimum bin slack.

Documents are encoded, an end id is appended, and only those longer than a sequence are cut. Pieces are packed in
groups of about ``GROUP``, dealt by a hash of their row number, so the groups are even whatever the documents are and
cost at most one part-filled sequence each. Inside a group a sequence starts with the longest piece left; a subset-sum
search over bit sets of reachable lengths, longest pieces first, then finds the fullest combination that still fits,
which is taken out (as often as the supply allows) before the next sequence is filled.

Defined results: null and empty texts are the end id alone; repeated rows and ties are pieces of their own; null keys
stay null; an empty table gives an empty table. Only key and text are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import slices, whole
from footfall.llm.tokens import checksum, encoder, vocabulary
from footfall.session import materialize

CAPACITY = 4096
END = 1
GROUP = 16384
SLICE = 1 << 18  # bytes of text encoded at a time


def fullest(counts: dict[int, int], lengths: list[int], room: int) -> list[int]:
    """The lengths, at most as many of each as counts has, with the greatest sum up to ``room``.

    ``lengths`` is descending. Bit v of ``reach`` says that sum v can be made; the search ends once ``room`` can.
    """
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in lengths:
        if length > room:
            continue
        left, size = min(counts[length], room // length), 1
        while left and not reach >> room & 1:  # multiplicities by binary splitting
            size = min(size, left)
            steps.append((length, size, reach))
            reach |= reach << (length * size) & mask
            left, size = left - size, size * 2
        if reach >> room & 1:
            break
    at, found = reach.bit_length() - 1, []
    for length, size, before in reversed(steps):
        if not before >> at & 1:
            at -= length * size
            found += [length] * size
    return found


def pack(lengths: list[int], capacity: int = CAPACITY) -> tuple[list[int], list[int]]:
    """(bin, offset) of every piece."""
    places = defaultdict(list)
    for i, length in enumerate(lengths):
        places[length].append(i)
    counts = {length: len(p) for length, p in places.items()}
    order = sorted(counts, reverse=True)
    bins, offsets, number = [0] * len(lengths), [0] * len(lengths), 0
    while order:
        first = order[0]
        counts[first] -= 1
        chosen = [first, *fullest(counts, order, capacity - first)]
        counts[first] += 1
        need = {length: chosen.count(length) for length in set(chosen)}
        for _ in range(min(counts[length] // n for length, n in need.items())):
            offset = 0
            for length in chosen:
                i = places[length].pop()
                bins[i], offsets[i] = number, offset
                offset += length
            number += 1
        for length in need:
            counts[length] = len(places[length])
        order = [length for length in order if counts[length]]
    return bins, offsets


def pieces(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    remembered: int | None = None,
) -> DataFrame:
    """(key, piece, start, length, ids_crc32): each document's ids and end id, cut where longer than a sequence.

    ``remembered`` bounds what a worker's encoder remembers, in bytes; it changes time and memory, never a row.
    """
    words = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    kind = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(words.value, remembered)
        for batch in slices(batches, "text", SLICE):
            rows, source = [], []
            for i, coded in enumerate(coder.encode([whole(t) for t in batch.column("text").to_pylist()])):
                ids = np.append(coder.ids(coded), np.uint32(END))
                for piece, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    rows.append((piece, start, len(part), checksum(part)))
                    source.append(i)
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            names = ["key", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(source)), *columns], names)

    schema = T.StructType(
        [T.StructField("key", kind), T.StructField("piece", T.IntegerType())]
        + [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")]
    )
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, schema)


def packed(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    remembered: int | None = None,
) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset."""
    cut = pieces(docs, path, key, text, capacity, remembered).withColumn("number", F.monotonically_increasing_id())
    cut = materialize(cut, "pieces")
    groups = max(1, -(-cut.count() // GROUP))
    dealt = cut.withColumn("group", F.pmod(F.xxhash64("number"), F.lit(groups)))

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = pack(group["length"].tolist(), capacity)
        first = int(group["group"].iloc[0]) << 32
        return group.assign(sequence_id=np.array(bins, np.int64) + first, offset=np.array(offsets, np.int64)).drop(
            columns=["group", "number"]
        )

    fields = [f for f in cut.schema.fields if f.name != "number"]
    schema = T.StructType([*fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return dealt.groupBy("group").applyInPandas(fill, schema).withColumnRenamed("key", key)
