"""Token counts of fields and sections, from one encoding of the whole document.

A document is its fields joined by a blank each (a blank belongs to the field before it); the last field is split
further into lines, a line with its line feed. It is encoded once, as a whole, since cutting first would change the
tokens at the cuts. Token spans are then joined to the sections' character ranges: pieces of text that lie in one
section are counted there at once, and only in pieces that touch several are single tokens placed. A token that
crosses a boundary counts wholly for the section with most of its characters, the earlier one if equal; it is also
reported as crossing there. Tokens that are bytes of one character have that character's span.

Defined results: null fields are empty but keep their section and blank; an empty last field has one empty line;
repeated rows are documents of their own; null keys stay null; only key and fields are read, whatever other columns
are called; an empty table gives an empty table. Positions count code points, ends are exclusive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import slices, whole
from footfall.llm.tokens import Encoder, encoder, pieces_of, vocabulary


def sections(fields: list[str], names: list[str]) -> tuple[str, list[str], list[int], list[int]]:
    """(whole text, section names, ordinals inside the field, starts)."""
    text = " ".join(fields)
    labels, ordinals, starts, at = [], [], [], 0
    for name, field in zip(names[:-1], fields[:-1]):
        labels.append(name)
        ordinals.append(0)
        starts.append(at)
        at += len(field) + 1
    lines = fields[-1].split("\n")
    for i, line in enumerate(lines):
        labels.append(names[-1])
        ordinals.append(i)
        starts.append(at)
        at += len(line) + 1
    if len(lines) > 1 and not lines[-1]:  # nothing follows the last line feed
        labels.pop(), ordinals.pop(), starts.pop()
    return text, labels, ordinals, starts


def owner(start: int, end: int, starts: np.ndarray, ends: np.ndarray) -> tuple[int, bool]:
    """Section of a token with most of its characters, the earlier if equal; whether it crosses a boundary."""
    first = max(int(np.searchsorted(starts, start, side="right")) - 1, 0)
    last = max(int(np.searchsorted(starts, max(end - 1, start), side="right")) - 1, first)
    shares = [min(end, ends[s]) - max(start, starts[s]) for s in range(first, last + 1)]
    return first + int(np.argmax(shares)), last > first


def counts(text: str, starts: list[int], coder: Encoder, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing tokens) of every section."""
    begin = np.array(starts)
    end = np.append(begin[1:], len(text))
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    numbers = np.fromiter((len(coder.known_or_coded(p)) // coder.width for p in parts), np.int64, len(parts))
    at = np.cumsum(sizes) - sizes
    # Where sections of no characters share a start, the last of them holds what begins there.
    first = np.maximum(np.searchsorted(begin, at, side="right") - 1, 0)
    last = np.maximum(np.searchsorted(begin, np.maximum(at + sizes - 1, at), side="right") - 1, first)
    tokens, crossing = np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
    inside = first == last
    np.add.at(tokens, first[inside], numbers[inside])
    several = np.flatnonzero(~inside)
    spans = coder.spans([parts[i] for i in several])
    if spans:
        a, b = (np.array([int(at[i]) + s[k] for i, own in zip(several, spans) for s in own]) for k in (0, 1))
        head = np.maximum(np.searchsorted(begin, a, side="right") - 1, 0)
        tail = np.maximum(np.searchsorted(begin, np.maximum(b - 1, a), side="right") - 1, head)
        np.add.at(tokens, head[head == tail], 1)
        for i in np.flatnonzero(head < tail):
            section, crosses = owner(int(a[i]), int(b[i]), begin, end)
            tokens[section] += 1
            crossing[section] += crosses
    return tokens, crossing


def attributed(docs: DataFrame, path: str, fields: tuple[str, ...], key: str = "doc_id") -> DataFrame:
    """One row per section: key, field, ordinal, start, end, n_tokens, n_crossing."""
    words = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    kind = docs.schema[key].dataType
    names = [f"f{i}" for i in range(len(fields))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(words.value)
        for batch in slices(batches, names[-1]):
            texts = zip(*(map(whole, batch.column(n).to_pylist()) for n in names))
            cut = [sections(list(t), list(fields)) for t in texts]
            parts = [pieces_of(c[0]) for c in cut]
            coder.learn(parts)
            rows, source = [], []
            for i, ((text, labels, ordinals, starts), pieces) in enumerate(zip(cut, parts)):
                tokens, crossing = counts(text, starts, coder, pieces)
                rows += zip(labels, ordinals, starts, [*starts[1:], len(text)], tokens.tolist(), crossing.tolist())
                source += [i] * len(labels)
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
            heads = ["key", "field", "ordinal", "start", "end", "n_tokens", "n_crossing"]
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(source)), *columns], heads)

    schema = T.StructType(
        [T.StructField("key", kind), T.StructField("field", T.StringType()), T.StructField("ordinal", T.IntegerType())]
        + [T.StructField(c, T.LongType()) for c in ("start", "end", "n_tokens", "n_crossing")]
    )
    chosen = docs.select(F.col(key).alias("key"), *[F.col(f).alias(n) for f, n in zip(fields, names)])
    return chosen.mapInArrow(run, schema).withColumnRenamed("key", key)
