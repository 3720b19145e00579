"""HTML as a tree of boxes with blocks of text, in one pass and in time in proportion to the page.

Markup may be broken: what an element leaves open is closed where HTML closes it (a paragraph before the next block, a
list item before the next one, anything inside an element that ends), unknown end tags are skipped, a tag or comment
without an end reaches to the end of the page. Inline elements make no box unless ``reject`` names a reason for one.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable
from html import unescape

# HTML's element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody "
    "td tfoot th thead tr ul".split()
)
# A start tag of the left ends an open one of the middle, unless one of the right has begun since.
ENDS = (
    (BLOCK - {"option", "tbody", "td", "tfoot", "th", "thead", "tr", "body", "html"}, ("p",), ("td", "th", "caption", "table")),
    ({"li"}, ("li",), ("ul", "ol", "menu", "dir")),
    ({"dd", "dt"}, ("dd", "dt"), ("dl",)),
    ({"td", "th"}, ("td", "th"), ("table",)),
    ({"tr", "tbody", "thead", "tfoot"}, ("tr",), ("table",)),
    ({"option"}, ("option",), ("select",)),
    ({"article", "main"}, ("nav", "header"), ("article", "main", "aside")),
)
CELLS = ("td", "th", "caption", "table")  # an end tag inside one of these ends nothing outside

_ENDED_BY = {tag: [(ended, bounds) for starts, ended, bounds in ENDS if tag in starts] for tag in BLOCK}
_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z) | <[!?][^>]*+(?:>|\Z) | </(?![a-zA-Z])[^>]*+(?:>|\Z)
      | <(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)> | <(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)""",
    re.S | re.X,
)
_ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+(?:>|\Z)|\Z", re.I) for tag in RAW}

Reject = Callable[[str, dict[str, str]], object]


def attributes(text: str) -> dict[str, str]:
    """Attributes of a start tag by lower-case name; of repeated ones the first."""
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape("".join(values)))
    return found


class Tree:
    """Boxes in page order: ``above`` is the box around each, ``tag``, ``attributes`` and ``reason`` (of its rejection).

    ``blocks`` holds, in page order, the box of each block of text and its pieces (box, text, inside a link).
    """

    def __init__(self, html: str, reject: Reject):
        self.above, self.tag, self.attributes, self.reason = [-1], ["body"], [{}], [None]
        self.blocks: list[tuple[int, list[tuple[int, str, bool]]]] = []
        self._reject = reject
        self._open: list[tuple[str, int]] = []  # tag and box of the elements that are open
        self._at: defaultdict[str, list[int]] = defaultdict(list)  # where in _open each tag is
        self._pieces: list[tuple[int, str, bool]] = []
        at = 0
        while at < len(html):
            mark = _MARKUP.search(html, at)
            if mark is None:
                break
            self._text(html[at : mark.start()])
            at = mark.end()
            end, tag, rest = mark.group(1, 2, 3) if mark.group(2) else mark.group(4, 5, 6)
            if tag:
                tag = tag.lower()
                if end:
                    self._end(tag)
                else:
                    self._start(tag, rest)
                    if tag in RAW:
                        at = _RAW_END[tag].search(html, at).end()
        self._text(html[at:])
        self._cut()

    def _box(self) -> int:
        return self._open[-1][1] if self._open else 0

    def _text(self, text: str) -> None:
        if text:
            self._pieces.append((self._box(), unescape(text) if "&" in text else text, bool(self._at["a"])))

    def _cut(self) -> None:
        """The block so far ends here."""
        if any(not text.isspace() for _, text, _ in self._pieces):
            # The box of a block is that of its first text: inline boxes lie inside it.
            box = next(box for box, text, _ in self._pieces if not text.isspace())
            while self.tag[box] not in BLOCK:
                box = self.above[box]
            self.blocks.append((box, self._pieces))
        self._pieces = []

    def _close(self, to: int) -> None:
        """Close the elements from this place of _open on."""
        while len(self._open) > to:
            tag, _ = self._open.pop()
            self._at[tag].pop()
            if tag in BLOCK:
                self._cut()

    def _last(self, tags: tuple[str, ...]) -> int:
        return max((self._at[t][-1] for t in tags if self._at[t]), default=-1)

    def _start(self, tag: str, rest: str) -> None:
        for ended, bounds in _ENDED_BY.get(tag, ()):
            if (place := self._last(ended)) > self._last(bounds):
                self._close(place)
        if tag == "br":
            self._pieces.append((self._box(), "\n", False))
        if tag in BLOCK:
            self._cut()
        if tag in VOID or tag in RAW:
            return
        box = self._box()
        known = attributes(rest) if "=" in rest or "hidden" in rest else {}
        reason = self._reject(tag, known)
        if tag in BLOCK or reason:
            self.above.append(box)
            self.tag.append(tag)
            self.attributes.append(known)
            self.reason.append(reason)
            box = len(self.above) - 1
        self._at[tag].append(len(self._open))
        self._open.append((tag, box))

    def _end(self, tag: str) -> None:
        if tag in BLOCK:
            self._cut()
        place = self._last((tag,))
        if place >= 0 and (place >= self._last(CELLS) or tag in ("tr", "tbody", "thead", "tfoot", *CELLS)):
            self._close(place)
