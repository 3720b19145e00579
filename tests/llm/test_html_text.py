"""Main text of pages: known articles in many frames, and the tree and its points against brute force."""

from __future__ import annotations

import random
import re
import time
from html import escape, unescape

import pytest
from pyspark.sql import functions as F

from footfall.llm import html_text
from footfall.llm.html_text import WITHIN, extracted, main_text
from footfall.llm.page_tree import BLOCK, Tree

HEADING = "A heading of the page"
PARAGRAPHS = [
    "The first paragraph, which is long enough, has commas, and says what the page is about.",
    "Short.",
    "A third one with a link in it, and some more words, so that it counts, as one would expect of it.",
]
ARTICLE = f"<h1>{HEADING}</h1><p>{PARAGRAPHS[0]}</p><p>{PARAGRAPHS[1]}</p><p>" + PARAGRAPHS[2].replace("a link", '<a href="/x">a link</a>') + "</p>"
TEXT = "\n".join([HEADING, *PARAGRAPHS])
MENU = '<ul><li><a href="/a">Home</a></li><li><a href="/b">News, sport, weather</a></li><li><a href="/c">About</a></li></ul>'
LONG = "Somebody says a lot here, more than the article does, again and again, with many commas, too. " * 12
FRAMES = {
    "article": "<nav>{menu}</nav><article>{article}</article><footer>{long}</footer>",
    "no marks": '<div id="top">{menu}</div><div id="c1">{article}</div><div>{menu}</div>',
    "names": '<div class="site-header">{long}</div><div class="entry-content">{article}</div><div id="sidebar">{long}</div>',
    "main": '<header><h2>Site</h2><p>{long}</p></header><main>{article}</main><aside>{long}</aside>',
    "role": '<div role="banner">{long}</div><div role="main">{article}</div><div role="complementary">{long}</div>',
    "comments": '<article>{article}</article><section id="comments"><p>{long}</p><p>{long}</p></section>',
    "comments inside": '<article>{article}<div class="commentList"><div class="comment"><p>{long}</p></div></div></article>',
    "comments of a list": '<div class="post">{article}</div><ol class="comment-list"><li><p>{long}</p></li><li>{long}</li></ol>',
    "article comments": '<article>{article}</article><section class="comments"><article><p>{long}</p></article></section>',
    "adverts": '<div class="ad">{long}</div><article>{article}<div class="ad-slot"><p>{long}</p></div></article><div id="AdBanner">{long}</div>',
    "notices": '<div class="cookie-notice"><p>{long}</p></div><article>{article}</article><div role="alertdialog">{long}</div>',
    "forms": "<article>{article}<form><p>{long}</p><input><textarea>{long}</textarea></form></article><form>{long}</form>",
    "scripts": '<script>var t="</p><p>{long}";</script><style>p{{}}</style><article>{article}<script>if (a < b) "<p>"</script></article>',
    "hidden": '<article>{article}<div hidden>{long}</div><p style="display: none">{long}</p><template>{long}</template></article>',
    "header of an article": "<header>{long}</header><article><header><p>By Somebody</p></header>{article}</article>",
    "sections": '<div id="a"><section>{article}</section></div><div class="related">{long}</div>',
    "table": "<table><tr><td>{menu}</td><td>{article}</td></tr></table>",
    "frame named after its parts": '<body class="has-sidebar with-comments"><div class="page-header-wrapper"><article>{article}</article></div></body>',
    "no ends": "<body><nav>{menu}<article>{article}<footer>{long}",
    "comment tags": "<!-- <p>{long} --><article><!-- x > y -->{article}</article><!-- never ends {long}",
    "flat": "{article}<footer>{long}</footer>",
}


@pytest.mark.parametrize("name", FRAMES)
def test_the_article_of_a_frame(name):
    page = FRAMES[name].format(menu=MENU, article=ARTICLE, long=LONG)
    whole = page if "<body" in page else f"<!DOCTYPE html><html><head><title>{LONG}</title></head><body>{page}</body></html>"
    assert main_text(whole) == TEXT


def test_blocks_and_references():
    page = "<article><h1>A&nbsp;&amp;\n B</h1><p><b>One<br>two &lt;b&gt; &am &amp<p>three  &#8364;&#x20ac;<div>a<span>b</span> c</div>d<ul><li>x<li>y</ul></article>"
    assert main_text(page).split("\n") == ["A & B", "One two <b> &am &", "three €€", "ab c", "d", "x", "y"]
    assert main_text("just text, no markup &amp; so") == "just text, no markup & so"
    assert main_text("a < b and 3 <4 > 2") == "a < b and 3 <4 > 2"
    assert main_text("<p title='a > b' x>in</p><p>next") == "in\nnext"
    assert main_text("<p>in</p><p class=") == "in" and main_text('<p>in</p><p class="') == "in"
    assert main_text("") == main_text(None) == main_text("<nav>only a menu</nav>") == ""


def drawn(r, depth=0):
    """Well-formed markup as nested lists: text, or [tag, children]."""
    found = []
    for _ in range(r.randint(1, 4)):
        if depth == 5 or r.random() < 0.5:
            text = " ".join(r.choices(["word", "a, b", "x < y", "&", "été", "  "], k=r.randint(1, 6)))
            if found and isinstance(found[-1], str):
                found[-1] += text
            else:
                found.append(text)
        else:
            tags = ["div", "section", "p", "ul", "blockquote", "b", "a", "span", "article"]
            tag = r.choice(["b", "a", "span"] if depth and r.random() < 0.3 else tags)
            found.append([tag, drawn(r, depth + 1)])
    return found


def written(nodes):
    return "".join(escape(n) if isinstance(n, str) else f"<{n[0]}>{written(n[1])}</{n[0]}>" for n in nodes)


def fits(nodes, inside=()):
    """Whether HTML nests these elements as they are written."""
    for node in nodes:
        if isinstance(node, list):
            tag, below = node
            if tag in BLOCK and ("p" in inside or set(inside) & {"b", "a", "span"}) or tag == "a" and "a" in inside:
                return False
            if not fits(below, (*inside, tag)):
                return False
    return True


def brute(nodes):
    """Points of each block-level element in page order, the page first, by walking up from every block."""
    boxes, blocks, pieces, path = [None], [], [], [0]
    tags = ["body"]

    def cut():
        text = " ".join("".join(t for t, _ in pieces).split())
        if text:
            linked = min(len(text), sum(len(" ".join(t.split())) for t, link in pieces if link))
            blocks.append((tuple(path), text, linked))
        pieces.clear()

    def walk(nodes, link):
        for node in nodes:
            if isinstance(node, str):
                pieces.append((node, link))
            elif node[0] in BLOCK:
                cut()
                boxes.append(None)
                tags.append(node[0])
                path.append(len(boxes) - 1)
                walk(node[1], link)
                cut()
                path.pop()
            else:
                walk(node[1], link or node[0] == "a")

    walk(nodes, False)
    cut()
    points = [0.0] * len(boxes)
    for up, text, linked in blocks:
        worth = (1 + len(re.findall(",", text)) + len(text) / 100) * (1 - linked / len(text))
        for box in reversed(up):
            points[box] += worth
            if tags[box] not in WITHIN:
                worth /= 2
    return points, [t for _, t, _ in blocks]


def test_points_equal_brute_force():
    r, done = random.Random(4), 0
    while done < 150:
        nodes = drawn(r)
        if not fits(nodes):
            continue
        done += 1
        points, texts = brute(nodes)
        tree = Tree(written(nodes), lambda tag, attributes: None)
        scores = html_text.scored(tree)
        assert [t for _, t in scores.texts] == texts
        assert scores.points == pytest.approx(points)


def test_pages_as_a_table(spark):
    rows = [(1, "u", FRAMES["adverts"].format(menu=MENU, article=ARTICLE, long=LONG)), (2, None, None), (None, "v", ""), (3, "w", "<p>é😀")]
    pages = spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string")
    for name in ("text", "n_chars"):
        pages = pages.withColumn(name, F.lit("clash"))
    found = sorted(map(tuple, extracted(pages).collect()), key=str)
    assert found == sorted([(1, "u", TEXT, len(TEXT))] * 2 + [(2, None, "", 0), (None, "v", "", 0), (3, "w", "é😀", 2)], key=str)
    assert extracted(pages.where("false")).collect() == []


def test_every_given_page_gives_its_article(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    held = {p.page_id: p.html for p in pages.collect()}
    for row in extracted(pages).collect():
        inner = re.search("<article>(.*?)</article>", held[row.page_id], re.S).group(1)
        blocks = (" ".join(unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inner))
        assert row.text == "\n".join(b for b in blocks if b) and row.n_chars == len(row.text)


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 200_000 + "x", "<p>word " * 200_000, "<b><p>" * 100_000, '<a href="' * 100_000, "<p><table><td>" * 60_000,
        "</div>" * 200_000, "<" * 1_000_000, "<!--" * 200_000, "<script>" * 100_000, "&amp" * 300_000, "<li><ul>" * 100_000,
        "<article>" * 100_000 + "x", "<nav><article>" * 60_000,
    ],
)
def test_time_follows_the_length_of_a_hostile_page(page):
    start = time.process_time()
    main_text(page)
    assert time.process_time() - start < 20
