"""Ranked lexical search against brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from footfall.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, top=10):
    held = [(key, Counter(terms(text))) for key, text in docs]
    held = [(key, bag) for key, bag in held if bag]
    n_docs, n_terms = len(held), sum(bag.total() for _, bag in held)
    found = []
    for item, text in set(items):
        scored = []
        for key, bag in held:
            m = 100 - 75 + (75 * bag.total() * n_docs) // n_terms
            score = 0
            for term in terms(text):
                tf, df = bag[term], sum(term in other for _, other in held)
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                score += w * ((1000000000 * tf) // (1000 * tf + 8 * m)) if tf else 0
            if score > 0:
                scored.append((-score, key is None, key or 0))
        for rank, (score, null, key) in enumerate(sorted(scored)[:top], 1):
            found.append((item, rank, None if null else key, -score))
    return sorted(found, key=str)


def ranked(spark, docs, items, **options):
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, lexical_search.search(docs, items, **options).collect()), key=str)


def drawn(seed):
    r = random.Random(seed)
    words = ["a", "A1", "été", "ÉTÉ", "漢字", "x y", "İ", "ß", "the", "then", "hen", "\U0001f600", "_", "9", "K"]
    gaps = [" ", ", ", "\n", "--", "_", "\0", "'", "{}", "\x7f"]

    def text(most):
        return "".join(r.choice(words) + r.choice(gaps) for _ in range(r.randint(0, most)))

    docs = [(i, text(60)) for i in range(60)] + [(7, "the hen"), (7, "the hen"), (None, "the hen"), (90, None), (91, ""), (92, " - ")]
    items = [(i, text(8)) for i in range(12)] + [(3, "the the hen"), (50, None), (51, "??"), (None, "ß 9"), (60, "the hen"), (60, "the hen")]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_ranks_equal_brute_force(spark, seed):
    docs, items = drawn(seed)
    items = [(i, t) for i, t in items if (i, t) != (3, "the the hen")]
    assert ranked(spark, docs, items) == brute(docs, items)


def test_batches_of_items_do_not_change_the_result(spark, monkeypatch):
    docs, items = drawn(3)
    whole = ranked(spark, docs, items, top=4)
    assert whole == brute(docs, items, top=4)
    monkeypatch.setattr(lexical_search, "BATCH_ITEMS", 5)
    monkeypatch.setattr(lexical_search, "BATCH_BYTES", 40)
    dealt = lexical_search.batches_of(spark.createDataFrame(items, "item_id long, text string"))
    assert dealt.select("batch").distinct().count() > 4
    assert ranked(spark, docs, items, top=4) == whole


def test_ties_long_texts_and_empty_tables(spark):
    docs = [(i, "same words here") for i in range(40, 0, -1)] + [(100, "words " * 300_000), (101, "x" * 2_000_000)]
    found = ranked(spark, docs, [(1, "words"), (2, "x" * 2_000_000)])
    assert found == brute(docs, [(1, "words"), (2, "x" * 2_000_000)])
    assert ranked(spark, [], [(1, "words")]) == [] == ranked(spark, docs, [])
    assert ranked(spark, [(1, None), (2, "")], [(1, "words")]) == []


def test_other_columns_may_clash(spark):
    docs = spark.createDataFrame([(1, "a b", "x", "y")], "doc_id long, text string, item_id string, score string")
    items = spark.createDataFrame([(5, "B", "z", "z")], "item_id long, text string, batch string, doc_id string")
    assert [tuple(r)[:3] for r in lexical_search.search(docs, items).collect()] == [(5, 1, 1)]
