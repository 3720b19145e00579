"""Mixing and shards against brute force, document by document."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from footfall.llm import hilbert, mixing

SCHEMA = "doc_id long, text string, source string, lang string"


def drawn(seed, n):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        size = r.choice([0, 1, 2, 3, 5, 8, 9])
        text = None if i % 97 == 0 else " ".join(r.choice(["w", "été", "漢"]) + str(r.randint(0, 99)) for _ in range(size))
        rows.append((None if i % 211 == 0 else i, text, r.choice(["b", "a", "ä", "Z", None]), r.choice(["en", "de", None])))
    return rows


def level_of(total, least, most):
    """The x between 0 and most at which total(x), which grows, reaches ``least``."""
    low, high = 0.0, most
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if total(mid) < least else (low, mid)
    return high


def mixed_by_hand(rows):
    """[(row, source size, target, words taken)], for sources without a document of a hundredth of their words."""
    size = [len((t or "").split()) for _, t, _, _ in rows]
    names = sorted({s for _, _, s, _ in rows if s is not None}) + [None] * any(s is None for _, _, s, _ in rows)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    words = {s: sum(z for z, row in zip(size, rows) if row[2] == s) for s in names}
    share = 1.5 * sum(words.values())
    level = level_of(lambda x: sum(min(2 * words[s], x * weight[s]) for s in names), share, 1e9)
    out = []
    for s in names:
        target = min(2.0 * words[s], level * weight[s])
        mine = [(row, z) for row, z in zip(rows, size) if row[2] == s]
        expected = lambda rate, z: min(2.0, rate * z.bit_length())
        rate = level_of(lambda x: sum(expected(x, z) * z for _, z in mine), target - 1e-7, 1e4)
        drawn_ = []
        for row, z in mine:
            key = [] if row[0] is None else [str(row[0])]  # concat_ws leaves nulls out
            text = "|".join(["1", *key, hashlib.md5((row[1] or "").encode()).hexdigest()])
            u = (int(hashlib.md5(text.encode()).hexdigest()[:13], 16) + 0.5) / (1 << 52)
            e = expected(rate, z)
            whole = int(e + 1e-9)
            p = e - whole
            drawn_.append((u / (1 - u) / (p / (1 - p)) if z and p > 1e-9 else None, row, z, whole))
        due = target - sum(whole * z for _, _, z, whole in drawn_)
        before = 0
        for rank, row, z, whole in sorted(drawn_, key=lambda d: (d[0] is None, d[0] or 0, d[2])):
            more = rank is not None and before + z / 2 <= due
            before += z if rank is not None else 0
            out.append((row[0], z, words[s], target, (whole + more) * z))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_equals_brute_force(spark, seed):
    rows = drawn(seed, 3000)
    found = mixing.report(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *map(float, r[1:3]), r[4])
    expected = sorted(mixed_by_hand(rows), key=key)
    found = sorted(((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in found), key=key)
    assert [x[:3] for x in found] == [x[:3] for x in expected]
    assert [x[3] for x in found] == pytest.approx([x[3] for x in expected], rel=1e-6)
    assert [x[4] for x in found] == [x[4] for x in expected]


def shards_by_hand(rows, shards=8):
    body = [(t or "").encode() for _, t, _, _ in rows]
    size = [len(b) + 1 for b in body]
    classes = [z >> max(z.bit_length() - 4, 0) << max(z.bit_length() - 4, 0) for z in size]
    points = []
    for values in ([r[2] for r in rows], [r[3] for r in rows], classes):
        order = lambda v: (v is not None, v.encode() if isinstance(v, str) else v)
        below = {v: sum(order(w) < order(v) for w in values) for v in set(values)}
        points.append([32 * below[v] // len(values) for v in values])
    curve = hilbert.hilbert_index(np.array(points).T, 5)
    held = sorted(
        ((int(c), zlib.crc32(b), r[0] is not None, r[0] or 0, z) for c, b, r, z in zip(curve, body, rows, size)), key=lambda x: x[:4]
    )
    out = []
    for position, (_, crc, there, key, z) in enumerate(held):
        shard = position * shards // len(held)
        first = next(p for p in range(len(held)) if p * shards // len(held) == shard)
        out.append((key if there else None, z, crc, shard, position - first))
    return out


def test_shards_equal_brute_force(spark):
    rows = drawn(3, 1003)
    found = hilbert.report(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    assert {r.law for r in found} == {"rows"} and {r.grown_shard for r in found} == {None}
    found = [(r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in found]
    assert sorted(found, key=str) == sorted(shards_by_hand(rows), key=str)
