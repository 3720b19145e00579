"""Token ids of whole texts with a public tokenizer's vocabulary file, a word at a time."""

from __future__ import annotations

import os
import re
import zlib
from array import array
from itertools import islice

import numpy as np
from tokenizers import Tokenizer

from footfall.llm.common import worker_cache

# Memory for the encoded pieces that a Python worker remembers if not told otherwise, and what one takes besides
# characters and ids.
KNOWN_BYTES = 224 << 20
ENTRY_BYTES = 160
# Pieces that are encoded as one text.
JOINED = 256

# White space besides the blank.
_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]
_ASCII_SPACES = [c for c in _SPACES if c.isascii()]
_CUT = re.compile(r"(?<=\S)(?= \S)")


def pieces_of(text: str) -> list[str]:
    """The text cut before every blank that stands between two characters other than white space."""
    if "\0" in text or "  " in text:
        return _CUT.split(text)
    for c in _ASCII_SPACES if text.isascii() else _SPACES:
        if c in text and (f" {c}" in text or f"{c} " in text):
            return _CUT.split(text)
    return text.replace(" ", "\0 ").split("\0")


class Encoder:
    """Encodes texts; ids come as little-endian bytes of ``width`` bytes each.

    Texts are cut before every blank between two other characters, where the vocabularies used here never join
    anything (their patterns begin a match there, and no special token holds a blank or takes one in), so each distinct
    piece needs encoding once. Strings of special tokens in a text are those tokens, as by the library's default.
    Pieces are remembered in at most ``remembered`` bytes of memory (``KNOWN_BYTES`` by default); later ones are encoded
    again. Many new pieces are encoded as one text with a special token between them, at which the library cuts before
    all else.
    """

    def __init__(self, vocabulary: str, remembered: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        self.known: dict[str, bytes] = {}
        self.fresh: dict[str, bytes] = {}
        self.room = KNOWN_BYTES if remembered is None else remembered
        added = self.tokenizer.get_added_tokens_decoder()
        exact = [n for n, t in added.items() if t.special and not (t.lstrip or t.rstrip or t.single_word or t.normalized)]
        # A mark's first character tells whether a piece could take part in an added token; see _coded.
        fit = (m for m in exact if all(added[m].content[0] not in t.content[1:] for t in added.values()))
        fit = (m for m in fit if not any(t.content.startswith(added[m].content) for n, t in added.items() if n != m))
        self.mark = next(fit, None)
        self.between = None if self.mark is None else added[self.mark].content

    def _coded(self, new: list[str]) -> dict[str, bytes]:
        """Ids of each of the pieces."""
        joint = [] if self.between is None else [p for p in new if self.between[0] not in p]
        groups = [joint[i : i + JOINED] for i in range(0, len(joint), JOINED)]
        found = {}
        texts = [self.between.join(group) for group in groups]
        for group, c in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = array(self.code, c.ids)
            ends = np.flatnonzero(np.frombuffer(ids, self.code) == self.mark).tolist()
            if len(ends) == len(group) - 1:
                coded, size = ids.tobytes(), ids.itemsize
                starts = [0, *[(e + 1) * size for e in ends]]
                found.update(zip(group, [coded[a : b * size] for a, b in zip(starts, [*ends, len(ids)])]))
        alone = [p for p in new if p not in found]
        for piece, c in zip(alone, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)):
            found[piece] = array(self.code, c.ids).tobytes()
        return found

    def learn(self, docs: list[list[str]]) -> list[list[bytes]]:
        """Ids of every piece of the documents, in place; see the class for what is remembered."""
        look = self.known.get
        found, gaps = [], []
        for d in docs:
            f = list(map(look, d))
            found.append(f)
            at = -1
            try:
                while True:
                    at = f.index(None, at + 1)
                    gaps.append((f, at, d[at]))
            except ValueError:
                continue
        self.fresh = self._coded(list({piece for _, _, piece in gaps}))
        for f, at, piece in gaps:
            f[at] = self.fresh[piece]
        self._remember()
        return found

    def _remember(self) -> None:
        """Keep what was learned last, as far as there is room."""
        if self.room <= 0:
            return
        # Up to two bytes a character; four in few texts.
        size = sum(map(len, self.fresh)) * 2 + sum(map(len, self.fresh.values())) + ENTRY_BYTES * len(self.fresh)
        kept = self.fresh
        if size > self.room:
            kept = dict(islice(kept.items(), int(len(kept) * self.room / size)))
        self.known.update(kept)
        self.room -= size

    def known_or_coded(self, piece: str) -> bytes:
        """Ids of a piece of the documents that were learned last."""
        return self.fresh[piece] if piece in self.fresh else self.known[piece]

    def spans(self, pieces: list[str]) -> list[list[tuple[int, int]]]:
        """Start and end of each token of the pieces, in code points."""
        return [c.offsets for c in self.tokenizer.encode_batch(pieces, add_special_tokens=False)] if pieces else []

    def encode(self, texts: list[str]) -> list[bytes]:
        return list(map(b"".join, self.learn([pieces_of(t) for t in texts])))

    def ids(self, coded: bytes) -> np.ndarray:
        return np.frombuffer(coded, f"<u{self.width}").astype("<u4")


def encoder(vocabulary: str, remembered: int | None = None) -> Encoder:
    """The worker's encoder for a vocabulary, given as the text of its file."""
    owner = f"encoder {zlib.crc32(vocabulary.encode())} {remembered}"
    return worker_cache(owner, lambda: Encoder(vocabulary, remembered))


def vocabulary(path: str) -> str:
    """Read on the driver and sent along, so that executors need no copy of the file (a few MB)."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def checksum(ids: np.ndarray) -> int:
    """CRC-32 of the ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
