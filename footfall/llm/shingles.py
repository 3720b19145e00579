"""Sets of word shingles as sorted 64-bit hashes, computed for many documents at once."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa

from footfall.llm.common import worker_cache

BASE = np.uint64(0xD6E8FEB86659FD93)
STEP = np.uint64(0x9E3779B97F4A7C15)
BLOCK = 1 << 18


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _made_block() -> tuple[np.ndarray, np.ndarray]:
    """Powers 1 to BLOCK of BASE and of its inverse."""
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(BLOCK, BASE)), np.cumprod(np.full(BLOCK, inverse))


def _block() -> tuple[np.ndarray, np.ndarray]:
    """The only powers that a worker keeps."""
    return worker_cache("powers", _made_block)


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 1 to ``size`` of BASE and of its inverse."""
    if size <= BLOCK:
        up, down = _block()
        return up[:size], down[:size]
    found = []
    for block in _block():
        with np.errstate(over="ignore"):
            shifts = np.cumprod(np.concatenate(([np.uint64(1)], np.full(-(-size // BLOCK) - 1, block[-1]))))
            found.append((shifts[:, None] * block).ravel()[:size])
    return found[0], found[1]


def word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every word of UTF-8 texts that lie one after another; text i ends before ends[i].

    Words are runs of bytes other than 9 to 13 and 32, with A to Z in lower case.
    """
    space = (data == 32) | ((data >= 9) & (data <= 13))
    low = data + np.uint8(32) * ((data >= 65) & (data <= 90))
    first = np.zeros(len(data) + 1, bool)  # a text begins here
    first[ends] = True
    first[0] = True
    solid = ~space
    before = np.concatenate(([False], solid[:-1])) & ~first[:-1]
    starts = np.flatnonzero(solid & ~before)
    after = np.concatenate((solid[1:], [False])) & ~first[1:]
    stops = np.flatnonzero(solid & ~after) + 1
    up, down = _powers(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[: len(low)])))
        hashes = _mixed((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64) * STEP)
    return hashes, np.searchsorted(ends, starts, side="right")


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets): the distinct shingles of text i, ascending, are values[offsets[i]:offsets[i + 1]].

    A text with fewer words than ``width``, but one at least, has its whole sequence as the one shingle. Values are
    64-bit hashes: two shingles of a pair of texts with n shingles in all share one with probability n**2 / 2**65.
    """
    n = len(texts)
    texts = texts.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]] if raw is not None else np.zeros(0, np.uint8)
    hashes, doc = word_hashes(data, bounds[1:] - bounds[0]) if len(data) else (np.zeros(0, np.uint64), np.zeros(0, int))
    counts = np.bincount(doc, minlength=n)
    with np.errstate(over="ignore"):
        chain = hashes
        for k in range(1, width):
            chain = _mixed(chain[: max(len(hashes) - k, 0)] * STEP + hashes[k:])
        whole_docs = doc[: len(chain)]
        inside = whole_docs == doc[width - 1 :][: len(chain)]
        values, owners = [chain[inside]], [whole_docs[inside]]
        firsts = np.concatenate(([0], np.cumsum(counts)))
        for i in np.flatnonzero((counts > 0) & (counts < width)):
            short = blake2b(hashes[firsts[i] : firsts[i + 1]].tobytes(), digest_size=8).digest()
            values.append(np.frombuffer(short, np.uint64))
            owners.append(np.array([i]))
    value, owner = np.concatenate(values), np.concatenate(owners)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[fresh], owner[fresh]
    return value, np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n))))


def digest(values: np.ndarray) -> bytes:
    return blake2b(values.tobytes(), digest_size=16).digest()


def lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64), pa.int64()))
