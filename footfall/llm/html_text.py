"""Main text of web pages by scoring a tree of containers.

Scripts, styles, menus, page headers, footers, sidebars, notices, adverts, forms, hidden parts and reader comments are
told by element, role, class and id and left out with all they hold. Every other block of text is worth one point, one
more per comma and one per hundred characters, less its share of link text. Points go up to all containers around it:
in full through paragraphs, lists and tables, halved at each container. A container's score is its points, less its
share of link text; the best one is the article, and what lies beside it stays if it is alike, scores a fifth of it or
is the page's heading. Where the page marks an article (or a main part), only what lies in one is scored, and the marked
element around the best container is kept whole.

A page is one row and is handled inside its task, in time and memory in proportion to its length; nothing is shuffled.
Defined results: a null or empty page has an empty text; a page without markup is its own text; character references
without a meaning stay as they are; a reference cut short counts as HTML reads it; repeated rows have each their row; a
very long page is read whole; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import slices
from footfall.llm.page_tree import Tree

# How pages name what is not their article.
REJECTED_ELEMENTS = frozenset("aside button canvas dialog dir footer head iframe input menu nav object select svg template".split())
REJECTED_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar tooltip".split()
)
REJECTED_NAMES = frozenset(
    "ad ads adbox adsense adslot adv advert advertisement advertisements advertising adverts affiliate alert alerts announcement "
    "banner banners breadcrumb breadcrumbs colophon comment commentary commentbox commentlist comments consent cookie cookies "
    "copyright disclaimer discussion disqus feedback follow foot footer gdpr guestbook header masthead menu menubar menus modal "
    "nav navbar navi navigation newsletter notice notices notification outbrain overlay pager paging pagination paywall popup "
    "promo promoted promos promotion rail reactions recommendation recommendations recommended registration related replies "
    "reply respond responses search share sharebar sharing sidebar sidebars sidenav signup skyscraper social sponsor sponsored "
    "sponsors subscribe subscription taboola teaser teasers toolbar topbar trending widget widgets".split()
)
CONTENT_NAMES = frozenset("article articlebody entry post postbody posting story storybody".split())
NOT = frozenset("has have hide no non not show with without".split())  # before a name: the name tells nothing
# Points go through these in full; other boxes are containers.
WITHIN = frozenset(
    "blockquote caption dd details dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup header legend li ol option p pre summary "
    "table tbody tfoot thead tr ul".split()
)
COMMAS = re.compile("[,،、，;；]")

BY_ELEMENT, BY_NAME, IN_HEADER = "element", "name", "header"
BESIDE = 0.2  # of the best score, for what lies beside the best container
LINKED = 0.5  # share of link text from which on a list outside an article is a menu

_NAMES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def names(attributes: dict[str, str]) -> list[str]:
    """Words of class and id, lower-case, without those whose word before says not or with."""
    found = []
    for part in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        words = [w.lower() for w in _NAMES.findall(part)]
        found += [w for before, w in zip(["", *words], words) if before not in NOT]
    return found


def reject(tag: str, attributes: dict[str, str]) -> str | None:
    """Why an element is no part of an article: by its element, or by its name or role."""
    if tag in REJECTED_ELEMENTS:
        return BY_ELEMENT
    if tag == "header":
        return IN_HEADER
    if tag == "form":
        return BY_NAME
    if not attributes:
        return None
    style = attributes.get("style", "").replace(" ", "").lower()
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style:
        return BY_ELEMENT
    if tag in ("body", "html", "main"):
        return None
    if attributes.get("role", "").lower() in REJECTED_ROLES or not REJECTED_NAMES.isdisjoint(names(attributes)):
        return BY_NAME
    return None


@dataclass
class Scores:
    """Of each box: whether it is left out, its points, letters, letters in links, and the blocks of text."""

    out: list[bool]
    points: list[float]
    letters: list[int]
    linked: list[int]
    texts: list[tuple[int, str]]

    def density(self, box: int) -> float:
        return self.linked[box] / self.letters[box] if self.letters[box] else 0.0

    def score(self, box: int) -> float:
        return self.points[box] * (1 - self.density(box))


def left_out(tree: Tree) -> list[bool]:
    """Whether each box, or one around it, is no part of an article.

    A name does not count against a box around the heading of the page or its main part (a frame that names what it
    also holds). Inside an article a header gives its headings.
    """
    boxes = range(len(tree.tag))
    leads = [t in ("h1", "main") for t in tree.tag]
    for box in reversed(boxes[1:]):
        leads[tree.above[box]] = leads[tree.above[box]] or leads[box]
    out, marked, header = [False], [False], [False]
    for box in boxes[1:]:
        above, tag, reason = tree.above[box], tree.tag[box], tree.reason[box]
        marked.append(marked[above] or is_marked(tree, box))
        header.append(header[above] or reason == IN_HEADER)
        gone = reason == BY_ELEMENT or reason == BY_NAME and not leads[box] or reason == IN_HEADER and not marked[box]
        # A header around the article's heading still has what stands beside the heading left out.
        gone = gone or header[box] and marked[box] and not tag.startswith("h") and not leads[box]
        out.append(out[above] or gone)
    return out


def is_marked(tree: Tree, box: int) -> bool:
    attributes = tree.attributes[box]
    return (
        tree.tag[box] in ("article", "main") or attributes.get("role", "").lower() in ("article", "main")
        or attributes.get("itemprop", "").lower() == "articlebody"
    )


def scored(tree: Tree) -> Scores:
    n = len(tree.tag)
    found = Scores(left_out(tree), [0.0] * n, [0] * n, [0] * n, [])
    for box, pieces in tree.blocks:
        if found.out[box]:
            continue
        kept = [(text, link) for at, text, link in pieces if not found.out[at]]
        text = " ".join("".join(t for t, _ in kept).split())
        if not text:
            continue
        linked = min(len(text), sum(len(" ".join(t.split())) for t, link in kept if link))
        found.texts.append((box, text))
        found.letters[box] += len(text)
        found.linked[box] += linked
        found.points[box] += (1 + len(COMMAS.findall(text)) + len(text) / 100) * (1 - linked / len(text))
    for box in range(n - 1, 0, -1):
        above = tree.above[box]
        found.letters[above] += found.letters[box]
        found.linked[above] += found.linked[box]
        found.points[above] += found.points[box] * (1.0 if tree.tag[box] in WITHIN else 0.5)
    return found


def chosen(tree: Tree, scores: Scores) -> tuple[list[int], bool]:
    """The best container and what is kept beside it; whether the page marks it."""
    boxes = [b for b in range(len(tree.tag)) if scores.letters[b] and not scores.out[b]]
    for kind in ("article", ""):
        inside = [False] * len(tree.tag)
        for b in range(1, len(tree.tag)):
            inside[b] = inside[tree.above[b]] or (tree.tag[b] == kind if kind else is_marked(tree, b))
        within = [b for b in boxes if inside[b]]
        if within:
            break
    containers = [b for b in within or boxes if tree.tag[b] not in WITHIN] or [0]
    best = max(containers, key=lambda b: (scores.score(b), -b))
    marked, box = False, best
    while box > 0:
        if is_marked(tree, box) if within else not CONTENT_NAMES.isdisjoint(names(tree.attributes[box])):
            best, marked = box, bool(within)
            if not within or tree.tag[box] == "article":
                break
        box = tree.above[box]
    if best == 0:
        return [0], marked
    like = lambda b: (tree.tag[b], tree.attributes[b].get("class"))
    kept = [best]
    for b in boxes:
        if tree.above[b] != tree.above[best] or b == best or scores.density(b) > LINKED:
            continue
        alike = like(b) == like(best) and (marked or tree.tag[b] != "div" or "class" in tree.attributes[b])
        strong = scores.score(b) >= BESIDE * scores.score(best) and (not marked or is_marked(tree, b) or tree.tag[b] == "section")
        if alike or strong or tree.tag[b] == "h1":
            kept.append(b)
    return kept, marked


def main_text(html: str | None) -> str:
    """The blocks of the article in page order, one line each."""
    tree = Tree(html or "", reject)
    scores = scored(tree)
    if not scores.texts:
        return ""
    roots, marked = chosen(tree, scores)
    keep, menu = [False] * len(tree.tag), [False] * len(tree.tag)
    for b in range(len(tree.tag)):
        above = tree.above[b]
        keep[b] = b in roots or above >= 0 and keep[above]
        is_menu = not marked and tree.tag[b] in ("ul", "ol", "dl") and scores.density(b) > LINKED
        menu[b] = is_menu or above >= 0 and menu[above]
    return "\n".join(text for box, text in scores.texts if keep[box] and not menu[box])


def extracted(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Columns page_id, url, text, n_chars (code points of the text): one row per page."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts = [main_text(h) for h in part.column("html").to_pylist()]
            yield pa.record_batch(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    narrow = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    kind = narrow.schema["page_id"].dataType.simpleString()
    return narrow.mapInArrow(read, f"page_id {kind}, url string, text string, n_chars long")
