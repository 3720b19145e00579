"""Ranked lexical search: every text is scanned by an Aho-Corasick automaton of all terms of the items.

A term is a run of characters other than the ASCII ones that are neither letter nor digit; A to Z count as a to z. The
automaton holds each term of an item between two guards, and a text is scanned with every run of separators between
its terms as one guard, so it reports whole terms only, adjacent ones included. Nothing is stored per document: one
scan counts documents, terms and the documents that hold each term of an item, a second one scores and keeps the best
``top`` documents of each item, per task first.

Items are cut into batches of at most ``BATCH_ITEMS`` items and ``BATCH_BYTES`` of text (or one longer item), each with
an automaton of its own that is broadcast, so neither it nor the scores of one document grow with the number of items;
every batch scans the documents again.

The score of a document for an item sums w * ((1000000000 * tf) div (1000 * tf + 8 * m)) over the item's terms, repeats
included: w = floor(1000 * ln((2N + 2) / (2df + 1))), m = 100 - 75 + (75 * n * N) div L, with N documents that hold a
term, L terms in all, df documents with the term, n terms of the document and tf of them this one.

Defined results: a null or empty text has no term, neither as a document nor as an item, and such items have no row;
rows that repeat count each as a document; equal scores go by document id, null last; equal items (id and text) count
once, different texts under one id are ranked each for itself; a very long text is scanned whole, in time and memory
in proportion to its length; empty tables give an empty table; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache, lru_cache
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm.common import partitions, slices, with_running_total
from footfall.session import discard, materialize

TOP = 10
BATCH_BYTES = 4 << 20
BATCH_ITEMS = 1024
LONG_TERM = 512  # bytes
SCORED = 512  # documents whose scores are held before the best are picked

Terms = dict[str, int]
# Per item: its term numbers and how often each occurs in it.
Items = list[tuple[int | None, list[tuple[int, int]]]]


@cache
def _guards() -> bytes:
    """Byte by byte: what is no part of a term becomes a blank, A to Z become a to z."""
    return bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def guarded(text: str | None) -> tuple[str, int]:
    """The terms of a text, one blank before, between and after them, and their number.

    Characters stand for the bytes of the text's UTF-8 form: no character's bytes occur inside another's. A term of over
    ``LONG_TERM`` bytes stands as its digest, so that the automaton's depth is bounded.
    """
    terms = (text or "").encode("utf-8", "replace").translate(_guards()).split()
    if terms and len(max(terms, key=len)) > LONG_TERM:
        terms = [t if len(t) <= LONG_TERM else b"\0" + sha256(t).hexdigest().encode() for t in terms]
    return f" {b' '.join(terms).decode('latin-1')} ", len(terms)


def automaton(terms: Iterable[str]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for number, term in enumerate(terms):
        found.add_word(f" {term} ", number)
    found.make_automaton()
    return found


@lru_cache(maxsize=1)
def _automaton_of(terms: Broadcast) -> ahocorasick.Automaton:
    """One automaton at a time is kept by a Python worker."""
    return automaton(terms.value)


def frequencies(scanner: ahocorasick.Automaton, text: str) -> Counter[int]:
    """How often each term of the automaton occurs in a guarded text."""
    return Counter(number for _, number in scanner.iter(text))


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    for part in slices(batches, "text"):
        yield part, part.column("text").to_pylist()


def statistics(docs: DataFrame, terms: Broadcast) -> DataFrame:
    """(term, n) from (text): documents with each term that any holds; as -1 documents with a term, as -2 their terms."""

    def count(batches):
        scanner, held, documents, length = _automaton_of(terms), Counter(), 0, 0
        for _, texts in _texts(batches):
            for text in texts:
                text, n = guarded(text)
                documents, length = documents + (n > 0), length + n
                held.update({number for _, number in scanner.iter(text)})
        numbers, counts = list(held.keys()), list(held.values())
        yield pa.record_batch({"term": pa.array([-1, -2, *numbers], pa.int64()), "n": pa.array([documents, length, *counts], pa.int64())})

    return docs.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


class Best:
    """The ``top`` best documents of each item so far."""

    def __init__(self, top: int):
        self.top = top
        self.item, self.key, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.null = np.zeros(0, bool)

    def add(self, keys: list[int | None], scores: np.ndarray) -> None:
        """Documents with their scores, one row each and one column per item."""
        row, of = np.nonzero(scores > 0)
        key = np.array([0 if k is None else k for k in keys], np.int64)
        null = np.array([k is None for k in keys])
        item = np.concatenate((self.item, of))
        key, null = np.concatenate((self.key, key[row])), np.concatenate((self.null, null[row]))
        score = np.concatenate((self.score, scores[row, of]))
        order = np.lexsort((key, null, -score, item))
        first = np.searchsorted(item[order], item[order])  # where the rows of the item begin
        order = order[np.arange(len(order)) - first < self.top]
        self.item, self.key, self.null, self.score = item[order], key[order], null[order], score[order]

    def rows(self) -> pa.RecordBatch:
        keys = pa.array(self.key, pa.int64(), mask=self.null)
        return pa.record_batch({"item": pa.array(self.item, pa.int64()), "doc_id": keys, "score": pa.array(self.score, pa.int64())})


def best_of_tasks(docs: DataFrame, terms: Broadcast, plan: Broadcast, top: int) -> DataFrame:
    """(item, doc_id, score) from (doc_id, text): what may be among the ``top`` of an item, per task."""

    def search(batches):
        weights, items, documents, length = plan.value
        scanner = _automaton_of(terms)
        # Which items hold a term, and how often.
        held: list[list[tuple[int, int]]] = [[] for _ in weights]
        for item, bag in enumerate(items):
            for number, times in bag:
                held[number].append((item, times))
        where = [np.array([i for i, _ in h], np.int64) for h in held]
        times = [np.array([t for _, t in h], np.int64) * w for h, w in zip(held, weights)]
        best = Best(top)
        for part, texts in _texts(batches):
            ids = part.column("doc_id").to_pylist()
            for start in range(0, len(texts), SCORED):
                own, scores = [], []
                for key, text in zip(ids[start : start + SCORED], texts[start : start + SCORED]):
                    text, n = guarded(text)
                    if not n:
                        continue
                    m = 25 + 75 * n * documents // length
                    score = np.zeros(len(items), np.int64)
                    for number, tf in frequencies(scanner, text).items():
                        score[where[number]] += times[number] * (1000000000 * tf // (1000 * tf + 8 * m))
                    own.append(key)
                    scores.append(score)
                if own:
                    best.add(own, np.stack(scores))
        yield best.rows()

    return docs.mapInArrow(search, "item long, doc_id long, score long")


def batches_of(items: DataFrame) -> DataFrame:
    """(batch, item_id, text), stored: distinct items with a text, dealt to batches of bounded size."""
    rows = items.where("text IS NOT NULL").select("item_id", "text").distinct()
    order = [F.col("item_id").asc_nulls_last(), F.col("text")]
    ordered = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    placed = with_running_total(ordered, F.octet_length("text"), "before", "place")
    # Both parts never go down, and one of them goes up before a batch has too much.
    batch = F.expr(f"(before + octet_length(text)) DIV {BATCH_BYTES} + place DIV {BATCH_ITEMS}")
    return materialize(placed.select(batch.alias("batch"), "item_id", "text"), "items")


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def search(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", top: int = TOP,
) -> DataFrame:
    """Columns item_id, rank (from 1), doc_id, score: the best documents with a score above 0 of each item."""
    spark = docs.sparkSession
    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    dealt = batches_of(items.select(F.col(item_key).cast("long").alias("item_id"), F.col(item_text).alias("text")))
    found = None
    for batch in sorted(r.batch for r in dealt.select("batch").distinct().collect()):
        numbers: Terms = {}
        bags: Items = []
        # At most BATCH_BYTES of text, or one item.
        for item in dealt.where(F.col("batch") == batch).select("item_id", "text").orderBy("item_id", "text").collect():
            bag = Counter(guarded(item.text)[0].split(" "))
            del bag[""]
            bags.append((item.item_id, [(numbers.setdefault(t, len(numbers)), times) for t, times in bag.items()]))
        if not numbers:
            continue
        terms = spark.sparkContext.broadcast(list(numbers))
        counted = {r.term: r.n for r in statistics(narrow.select("text"), terms).collect()}
        documents, length = counted.get(-1, 0), counted.get(-2, 0)
        if not documents:
            continue
        weights = [weight(counted.get(k, 0), documents) for k in range(len(numbers))]
        plan = spark.sparkContext.broadcast((weights, [bag for _, bag in bags], documents, length))
        best = best_of_tasks(narrow, terms, plan, top)
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        names = spark.createDataFrame([(k, i) for k, (i, _) in enumerate(bags)], "item long, item_id long")
        ranked = best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        found = ranked if found is None else found.unionByName(ranked)
    discard(dealt)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found
