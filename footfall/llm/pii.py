"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds what they miss.

The patterns give the base spans of each kind; these stay. Where a text has digits or at signs that no base span
covers, for instance two numbers run together so that neither passes its check, the random field segments the region:
candidate segments of up to ``MOST_TOKENS`` tokens are scored as wholes (shape, number of digits, checksum, number
range, what stands beside them), and a dynamic program over segment ends and kinds chooses boundaries and kinds
together. A segment is a candidate only for kinds whose pattern and check it passes as a whole. A segment found there that overlaps no base span
is added. Candidates are made and decoded a stretch at a time, where no candidate reaches over the gap between two
stretches, so a region of any length takes time in proportion to it and little memory.

The weights are learned by conditional likelihood on the driver from the base spans of at most ``SAMPLE`` distinct
texts of up to ``SAMPLE_CHARS`` characters with a digit or at sign: a fifth of them for each kind, those of the least
hash that give an example of it, a fifth without an example of any, and the rest of the least hash whatever they hold.
Regions in which a match has more digits than one entity can have are left out as undecided; one that fails its check
otherwise is an example of what is no entity. Pairs of regions are joined by a blank as further examples. With no
examples nothing is added. Every candidate holds a digit or an at sign and does not split a run of letters and digits; regions
end at white space between words without either.

Defined results: null and empty texts have no spans; repeated rows are tagged alike; null keys stay null; an empty
table gives an empty table; other columns are kept by ``redacted`` and not read by ``report``. Positions count code
points, ends are exclusive.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import whole
from footfall.session import discard, materialize

KINDS = ("email", "ip", "card", "phone")
# None of them looks at a run of characters again from each of its places.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
PATTERNS = {
    "ip": re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    "card": re.compile(r"[0-9]++(?:[\x20-][0-9]++)*+"),  # a single digit fails its check anyway
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
MOST_DIGITS = {"card": 19, "phone": 15}
ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
MARK = re.compile(r"[0-9@]+")
TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.S)
MOST_TOKENS = 16
SAMPLE = 300
SAMPLE_CHARS = 16384
ROUNDS = 5
RATE = 0.5

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def valid(kind: str, found: str) -> bool:
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))
    if kind == "card":
        digits = _digits(found)
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(_digits(found)) <= 15
    return True


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the address pattern, leftmost first: around each at sign, the run before it and the domain after."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def matches(kind: str, text: str) -> Iterator[tuple[int, int]]:
    return emails(text) if kind == "email" else (m.span() for m in PATTERNS[kind].finditer(text))


def base_spans(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """Base spans by kind as listed, then start; and the places of matches too long to be one entity."""
    spans, failed = [], []
    if not MARK.search(text):
        return spans, failed
    for kind in KINDS:
        if kind == "email" and "@" not in text or kind == "phone" and "+" not in text:
            continue
        for a, b in matches(kind, text):
            if valid(kind, text[a:b]):
                spans.append((kind, a, b))
            elif len(_digits(text[a:b])) > MOST_DIGITS.get(kind, b - a):
                failed.append((a, b))
    return spans, failed


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Runs of words that hold a digit or an at sign, merged over single blanks."""
    start = end = -1
    for m in MARK.finditer(text):
        if m.start() < end:
            continue
        a = m.start()
        while a > 0 and not text[a - 1].isspace() and a > end:
            a -= 1
        b = m.end()
        while b < len(text) and not text[b].isspace():
            b += 1
        # A phone number may have words between blanks such as "(0)"; a plus sign before is part of the word.
        if start >= 0 and a - end <= 1:
            end = b
            continue
        if start >= 0:
            yield start, end
        start, end = a, b
    if start >= 0:
        yield start, end


def _side(c: str) -> str:
    return "edge" if not c else "space" if c.isspace() else "word" if c.isalnum() else c


def features(text: str, start: int, end: int) -> list[str]:
    found = text[start:end]
    digits = _digits(found)
    shape = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", found))
    out = ["bias", f"digits={min(len(digits), 20)}", f"left={_side(text[start - 1 : start])}"]
    out += [f"right={_side(text[end : end + 1])}", f"first={shape[:1]}", f"last={shape[-1:]}"]
    if len(shape) <= 24:
        out.append(f"shape={re.sub(r'(a9|9a)+[a9]?', 'm', shape)}")
    out.append(f"runs={'-'.join(str(len(r)) for r in re.findall('[0-9]+', found)[:6])}")
    if "@" in found:
        out += [f"ats={min(found.count('@'), 2)}", f"dot={'.' in found[found.rfind('@') :]}"]
    if 13 <= len(digits) <= 19:
        out.append(f"luhn={luhn(digits)}")
    if re.fullmatch(r"[0-9]+(\.[0-9]+){3}", found):
        out.append(f"octets={valid('ip', found)}")
    if " " in found:
        out.append(f"blanks={min(found.count(' '), 4)}")
    return out


def kinds_of(found: str, digits: int, dots: int, ats: int) -> list[str]:
    """The kinds whose pattern and check a segment passes as a whole, given how many digits, dots and at signs it has."""
    out = []
    if ats == 1 and dots and ADDRESS.fullmatch(found):
        out.append("email")
    if ats:
        return out
    if dots == 3 and digits <= 12 and PATTERNS["ip"].fullmatch(found) and valid("ip", found):
        out.append("ip")
    if 13 <= digits <= 19 and not dots and PATTERNS["card"].fullmatch(found) and valid("card", found):
        out.append("card")
    if 9 <= digits <= 15 and PATTERNS["phone"].fullmatch(found):
        out.append("phone")
    return out


def token_ends(text: str, start: int, end: int) -> list[int]:
    return [start, *(m.end() for m in TOKEN.finditer(text, start, end))]


def candidates(text: str, ends: list[int]) -> Iterator[tuple[int, int, list[str]]]:
    """Segments (first token, token after, features) that may be an entity, by first token."""
    for i in range(len(ends) - 1):
        a = ends[i]
        if text[a].isspace() or a and text[a - 1].isalnum() and text[a].isalnum():
            continue
        digits = dots = ats = 0
        for j in range(i + 1, min(i + MOST_TOKENS, len(ends) - 1) + 1):
            b = ends[j]
            token = text[ends[j - 1] : b]
            if "0" <= token[0] <= "9":
                digits += len(token)
            dots += token == "."
            ats += token == "@"
            if ats > 1:
                break
            if not ats and (digits < 4 or digits > 19 or digits < 9 and dots != 3):
                continue
            if text[b - 1].isspace() or b < len(text) and text[b - 1].isalnum() and text[b].isalnum():
                continue
            if kinds := kinds_of(text[a:b], digits, dots, ats):
                yield i, j, features(text, a, b) + [f"not={k}" for k in KINDS if k not in kinds]


def lattice(text: str, start: int, end: int) -> tuple[list[int], list[tuple[int, int, list[str]]]]:
    """Token boundaries of a region, and its candidate segments."""
    ends = token_ends(text, start, end)
    return ends, list(candidates(text, ends))


def stretches(text: str, start: int, end: int) -> Iterator[tuple[list[int], list[tuple[int, int, list[str]]]]]:
    """The lattice of a region in parts: before and after each, a token lies outside every candidate."""
    ends = token_ends(text, start, end)
    first, reach, held = 0, -1, []

    def part():
        return ends[first : reach + 2], [(i - first, j - first, f) for i, j, f in held]

    for i, j, found in candidates(text, ends):
        if held and i > reach:
            yield part()
            held = []
        if not held:
            first, reach = i, j
        reach = max(reach, j)
        held.append((i, j, found))
    if held:
        yield part()


def _added(x: float, y: float) -> float:
    if x < y:
        x, y = y, x
    return x if y == -math.inf else x + math.log1p(math.exp(y - x))


class SemiMarkov:
    """Weights of (kind, feature) and (kind before, kind); kind "" is a single token outside all entities."""

    def __init__(self, weights: dict[tuple[str, str], float] | None = None):
        self.weights = weights or {}

    def _edges(self, segments) -> dict[int, list[tuple[int, str, float, list[str]]]]:
        """Segments with their scores by the token they begin at."""
        out = defaultdict(list)
        for i, j, found in segments:
            for kind in KINDS:
                if f"not={kind}" not in found:
                    out[i].append((j, kind, sum(self.weights.get((kind, f), 0.0) for f in found), found))
        return out

    def best(self, n: int, segments) -> list[tuple[int, int, str]]:
        """The segmentation of n tokens with the highest score: its entities."""
        edges, turn = self._edges(segments), self.weights.get
        score = [{} for _ in range(n + 1)]
        score[0][""] = (0.0, None)
        for i in range(n):
            for before, (s, _) in score[i].items():
                for j, kind, own, _ in [(i + 1, "", 0.0, ()), *edges[i]]:
                    total = s + own + turn((before, ">" + kind), 0.0)
                    if kind not in score[j] or total > score[j][kind][0]:
                        score[j][kind] = (total, (i, before))
        out, at = [], n
        kind = max(score[n], key=lambda k: score[n][k][0])
        while at:
            i, before = score[at][kind][1]
            if kind:
                out.append((i, at, kind))
            at, kind = i, before
        return out[::-1]

    def gradient(self, n: int, segments, gold: set[tuple[int, int, str]]) -> dict[tuple[str, str], float]:
        """Of the log likelihood of the gold segmentation."""
        edges, turn = self._edges(segments), self.weights.get
        steps = [
            [(j, kind, own, found) for j, kind, own, found in [(i + 1, "", 0.0, []), *edges[i]]] for i in range(n)
        ]
        ahead = [defaultdict(lambda: -math.inf) for _ in range(n + 1)]
        ahead[0][""] = 0.0
        for i in range(n):
            for before, s in list(ahead[i].items()):
                for j, kind, own, _ in steps[i]:
                    ahead[j][kind] = _added(ahead[j][kind], s + own + turn((before, ">" + kind), 0.0))
        back = [defaultdict(lambda: -math.inf) for _ in range(n + 1)]
        for kind in ahead[n]:
            back[n][kind] = 0.0
        for i in range(n - 1, -1, -1):
            for before in ahead[i]:
                for j, kind, own, _ in steps[i]:
                    back[i][before] = _added(back[i][before], own + turn((before, ">" + kind), 0.0) + back[j][kind])
        total, out = back[0][""], defaultdict(float)
        for i in range(n):
            for before, s in ahead[i].items():
                for j, kind, own, found in steps[i]:
                    p = math.exp(min(0.0, s + own + turn((before, ">" + kind), 0.0) + back[j][kind] - total))
                    if p > 1e-9:
                        out[before, ">" + kind] -= p
                        for f in found:
                            out[kind, f] -= p
        by_start, at, before = {i: (j, kind) for i, j, kind in gold}, 0, ""
        known = {(i, j): found for i, j, found in segments}
        while at < n:
            j, kind = by_start.get(at, (at + 1, ""))
            out[before, ">" + kind] += 1
            for f in known.get((at, j), []) if kind else []:
                out[kind, f] += 1
            at, before = j, kind
        return out

    def fit(self, examples) -> SemiMarkov:
        """Adaptive gradient ascent over (n, segments, gold) in their order."""
        squares: dict[tuple[str, str], float] = defaultdict(float)
        weights = defaultdict(float, self.weights)
        self.weights = weights
        for _ in range(ROUNDS):
            for n, segments, gold in examples:
                for f, g in self.gradient(n, segments, gold).items():
                    squares[f] += g * g
                    weights[f] += RATE * g / math.sqrt(squares[f] + 1e-8)
        self.weights = {f: w for f, w in weights.items() if abs(w) > 1e-4}
        return self


def _example(text: str, start: int, end: int, spans: list[Span]):
    ends, segments = lattice(text, start, end)
    place = {e: i for i, e in enumerate(ends)}
    inside = [(place.get(a), place.get(b), kind) for kind, a, b in spans if start <= a and b <= end]
    if any(i is None or j is None for i, j, _ in inside):
        return None
    inside.sort()
    if any(x[1] > y[0] for x, y in zip(inside, inside[1:])):
        return None
    known = {(i, j) for i, j, _ in segments}
    if any((i, j) not in known for i, j, _ in inside):
        return None
    return len(ends) - 1, segments, set(inside)


def decided(text: str, spans: list[Span], failed: list[tuple[int, int]]) -> Iterator[tuple[int, int, list[Span]]]:
    """Regions to learn from, with the base spans inside."""
    for start, end in regions(text):
        if end - start <= 200 and not any(a < end and b > start for a, b in failed):
            yield start, end, [(k, a, b) for k, a, b in spans if start <= a and b <= end]


def example_kinds(text: str) -> int:
    """The kinds that ``text`` has an example of, as bits in the order of KINDS."""
    spans, failed = base_spans(text)
    found, every = set(), {k for k, _, _ in spans}
    for start, end, own in decided(text, spans, failed) if spans else ():
        new = {k for k, _, _ in own} - found
        if new and _example(text, start, end, own):
            found |= new
            if found == every:
                break
    return sum(1 << i for i, k in enumerate(KINDS) if k in found)


def trained(texts: list[str]) -> SemiMarkov:
    examples, clean = [], []
    for text in texts:
        for start, end, own in decided(text, *base_spans(text)):
            if example := _example(text, start, end, own):
                examples.append(example)
                if own:
                    left = text[:start][-1:] if start else ""
                    clean.append((left + text[start:end], [(k, a - start + len(left), b - start + len(left)) for k, a, b in own]))
    for (a, spans_a), (b, spans_b) in zip(clean[::2], clean[1::2]):
        shift = len(a.rstrip()) + 1
        b_text = b.lstrip()
        moved = [(k, x + shift - (len(b) - len(b_text)), y + shift - (len(b) - len(b_text))) for k, x, y in spans_b]
        joined = f"{a.rstrip()} {b_text} "
        first = len(joined) - len(joined.lstrip())
        if example := _example(joined, first, len(joined) - 1, spans_a + moved):
            examples.append(example)
    return SemiMarkov().fit(examples) if any(gold for _, _, gold in examples) else SemiMarkov()


def find(text: str, model: SemiMarkov) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by kind as listed, then start."""
    base, _ = base_spans(text)
    if not model.weights or not MARK.search(text):
        return base, base
    held: list[list[int]] = []  # what base spans cover, apart and in order
    for a, b in sorted((a, b) for _, a, b in base):
        if held and a <= held[-1][1]:
            held[-1][1] = max(held[-1][1], b)
        else:
            held.append([a, b])
    starts = [a for a, _ in held]

    def touched(a: int, b: int) -> bool:
        place = bisect_left(starts, b) - 1
        return place >= 0 and held[place][1] > a

    def covered(a: int, b: int) -> bool:
        place = bisect_right(starts, a) - 1
        return place >= 0 and held[place][1] >= b

    extra = []
    for start, end in regions(text):
        if all(covered(*m.span()) for m in MARK.finditer(text, start, end)):
            continue
        for ends, segments in stretches(text, start, end):
            for i, j, kind in model.best(len(ends) - 1, segments):
                if not touched(ends[i], ends[j]):
                    extra.append((kind, ends[i], ends[j]))
    every = sorted(base + extra, key=lambda s: (KINDS.index(s[0]), s[1]))
    return base, every


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def learn(docs: DataFrame, text: str = "text") -> SemiMarkov:
    """Fit the model on a bounded sample of ``docs``."""
    some = docs.select(F.col(text).alias("t")).where(F.col("t").rlike("[0-9@]") & (F.length("t") <= SAMPLE_CHARS))
    some = some.withColumn("h", F.xxhash64("t"))
    # Copies share a hash, so distinct hashes stand for distinct texts.
    marked = materialize(some.select("h", _example_kinds("t").alias("kinds")).distinct(), "kinds")
    part = SAMPLE // (len(KINDS) + 1)
    chosen: set[int] = set()
    for wanted in [*(f"kinds & {1 << i} != 0" for i in range(len(KINDS))), "kinds = 0"]:
        chosen |= {r["h"] for r in marked.where(wanted).select("h").orderBy("h").limit(part).collect()}
    for r in marked.select("h").orderBy("h").limit(SAMPLE).collect():
        if len(chosen) < SAMPLE:
            chosen.add(r["h"])
    discard(marked)
    if not chosen:
        return SemiMarkov()
    rows = some.where(F.col("h").isin(sorted(chosen))).select("t").distinct().limit(SAMPLE).toLocalIterator()
    return trained(sorted(r["t"] for r in rows))


@F.pandas_udf(T.IntegerType())
def _example_kinds(texts: pd.Series) -> pd.Series:
    return pd.Series([example_kinds(t) for t in texts], dtype="int32")


_FOUND = T.StructType(
    [T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
    + [T.StructField(c, T.StringType()) for c in ("base_sha256", "spans", "redacted")]
)


def redact(text: str, spans: list[Span]) -> str:
    """Spans replaced by their kind in angle brackets, overlapping spans by that of the first."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def tagged(docs: DataFrame, text: str = "text") -> DataFrame:
    """Columns row (the document) and found (struct: base counts, base_sha256, spans, redacted text if it changes)."""
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, text))

    @F.pandas_udf(_FOUND)
    def tag(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for one in map(whole, texts):
            base, every = find(one, model.value)
            counts = [sum(s[0] == k for s in base) for k in KINDS]
            digest = sha256(written(base).encode()).hexdigest()
            rows.append((*counts, digest, written(every), redact(one, every) if every else None))
        return pd.DataFrame(rows, columns=_FOUND.names)

    return docs.select(F.struct("*").alias("row"), F.col(text).alias("t")).select("row", tag("t").alias("found"))


def report(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    names = [n for n in _FOUND.names if n != "redacted"]
    return tagged(docs).select(F.col("row")[key].alias(key), *[F.col("found")[n].alias(n) for n in names])


def redacted(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """The documents with their spans replaced, and their length, if they have that column, counted anew."""
    new = F.coalesce(F.col("found")["redacted"], F.col("row")[text])
    columns = {text: new}
    if length in docs.columns:
        counted = F.length(F.col("found")["redacted"]).cast(docs.schema[length].dataType)
        columns[length] = F.coalesce(counted, F.col("row")[length])
    return tagged(docs, text).select(*[columns.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
