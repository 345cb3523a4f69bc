from __future__ import annotations

import random
from html.parser import HTMLParser
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tideline.llm import html_extraction as S
from tideline.llm.page_blocks import parse
from tideline.llm.queries import QUERIES

PRIOR = list(S.PRIOR.values())


class ArticleText(HTMLParser):
    """The text of <article>, cut at paragraphs and headings."""

    def __init__(self, html: str):
        super().__init__()
        self.inside, self.blocks = False, [""]
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in ("p", "h1"):
            self.blocks.append("")
        elif tag == "br":
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        if tag in ("p", "h1", "article"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data

    def text(self) -> str:
        return "\n".join(b for b in (" ".join(x.split()) for x in self.blocks) if b)


def test_query_against_a_parser_that_knows_the_article(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op11_html_extraction"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        want = ArticleText(pages[r.page_id].html).text()
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, want, len(want))


PAGE = """<!DOCTYPE html><html><head><title>No &amp; title</title><style>p > a {}</style></head>
<body class="has-sidebar no-js"><div id="cookie-notice">We use cookies. <button>Accept</button></div>
<header><h1>The Site</h1><nav><a href="/">Home</a> <a href="/x">More</a></nav></header>
<div class="wrap"><aside class="side">Words beside the text, a whole sentence of them.</aside>
<main><h1>A caf&eacute;&nbsp;&lt;story&gt;</h1><p>First   paragraph,
with <b>bold</b>ness and <a href="/y" title="a > b">a link</a>.<p>Second&#33; &amp unclosed<br>over lines
<ul><li>one point<li>another <i>point</i></ul><div class="advertisement">Buy now, it is cheap. Really, it is.</div>
<table><tr><td>a cell<td>and another</table><blockquote>Quoted.</blockquote>
<form action="/s"><label>Search</label><input value="x"><select><option>One</select></form>
<script>if (a < b) document.write("<p>not this</p>")</script><!-- nor > this <p> -->
<p hidden>Not shown.</p><noscript>Nor this.</noscript>
<section id="comments"><article class="comment"><p>I read this, and liked it very much indeed.</p></article></section>
</main></div><footer>&copy; The Site. All rights, and wrongs, reserved.</footer></body></html>"""
TEXT = [
    "A café <story>",
    "First paragraph, with boldness and a link.",
    "Second! & unclosed over lines",
    "one point",
    "another point",
    "a cell",
    "and another",
    "Quoted.",
]


def test_main_text_without_the_rest():
    assert S.main_text(PAGE, PRIOR).split("\n") == TEXT


def test_a_page_cut_off_anywhere():
    whole = S.main_text(PAGE, PRIOR)
    for end in range(0, len(PAGE), 7):
        assert all(ord(c) >= 32 or c == "\n" for c in S.main_text(PAGE[:end], PRIOR))
    assert S.main_text(PAGE[: PAGE.index("<footer>")], PRIOR) == whole


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<article><p>a<p>b</article>", ["a", "b"]),
        ("<article>a<div>b</div>c</article>", ["a", "b", "c"]),
        ("<article><p>a</b>b</i></p></p>c", ["ab", "c"]),
        ("<article><h2>a<h3>b</h3>c", ["a", "b", "c"]),
        ("<article>a<span>b</span> c<wbr>d<img alt='x > y'>e", ["ab cde"]),
        ("<article><p>x &lt;b&gt; &notit; &#x41;&#65 &unknown; &am</p>", ["x <b> ¬it; AA &unknown; &am"]),
        ("<article>1 < 2 and <3 a</article>", ["1 < 2 and <3 a"]),
        ("<form><main><p>The page is a form.</p></main><p>Sign up</p></form>", ["The page is a form."]),
        ("<main><nav><p>Not <div>this</div></p></nav><p>but this</p></main>", ["but this"]),
        ("<main><div class='shareBar social'>Share</div><div class='mainContent'>text</div></main>", ["text"]),
        ("<article><svg><text>no</text></svg>yes<textarea><p>no</textarea></article>", ["yes"]),
        ("<ARTICLE><P>Upper</P><SCRIPT>x</SCRIPT ></ARTICLE><FOOTER>f</FOOTER>", ["Upper"]),
        ("<article>a<!-- <p> -- > --><!---->b<!-- never ends", ["ab"]),
        ("<article>a <p title='never ends>b</p> c", ["a", "b", "c"]),
        ("<article><script>never ends <p>b", []),
    ],
)
def test_markup(html, want):
    assert S.main_text(html, PRIOR) == "\n".join(want)


def test_every_block_is_found():
    blocks = [b.text for b in parse(PAGE).blocks]
    assert [t for t in TEXT if t not in blocks] == [] and "Buy now, it is cheap. Really, it is." in blocks
    assert not any("not this" in t or "nor" in t for t in blocks)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class='ad'>", "</div>", "<b>", "<td>", "<ul><li>", "</ul>", "<a href=x>", "</a>", "<!--", "-->", "<", "&", "'", '"', "é w ", "<script>", "</script>", "<article>"]), max_size=40))
def test_any_markup_parses(pieces):
    page = parse("".join(pieces))
    assert all(b.text == " ".join(b.text.split()) != "" for b in page.blocks)
    assert len(S.label_blocks(page, PRIOR)) == len(page.blocks)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 9), st.integers(0, 10**6))
def test_cut_is_the_cheapest(size, seed):
    rng = random.Random(seed)
    lean = [rng.randint(-9, 9) for _ in range(size)]
    links = [(rng.randrange(size), rng.randrange(size), rng.randint(0, 6)) for _ in range(2 * size)]
    cut = S.Cut(size)
    cut.lean = list(lean)
    for a, b, cost in links:
        cut.link(a, b, cost)

    def price(label) -> int:
        apart = sum(c for a, b, c in links if label[a] != label[b])
        return apart + sum(max(x, 0) if not kept else max(-x, 0) for x, kept in zip(lean, label, strict=True))

    every = list(product([False, True], repeat=size))
    least = min(map(price, every))
    found = cut.content()
    assert price(found) == least
    assert sum(found) == max(sum(x) for x in every if price(x) == least)


def test_a_long_page_of_undecided_blocks():
    rng = random.Random(5)
    cut = S.Cut(20_000)
    cut.lean = [rng.randint(-700, 700) for _ in range(20_000)]
    for k in range(1, 20_000):
        cut.link(k - 1, k, 350)
    assert 0 < sum(cut.content()) < 20_000


def test_classifier_on_pages_whose_elements_say_nothing(spark, sf_dir):
    """Fitted on marked pages, it finds the main text of others without any mark."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    weights = S.fit(pages)
    assert len(weights) == len(S.FEATURES) and weights != PRIOR
    right = total = 0
    for r in pages.collect():
        if (r.page_id or 0) % 2:
            continue
        want = set(ArticleText(r.html).text().split("\n"))
        bare = r.html
        for name in ("article", "nav", "footer"):
            bare = bare.replace(f"<{name}>", "<div>").replace(f"</{name}>", "</div>")
        page = parse(bare.replace(' class="ad"', ""))
        assert not any(n.mark for n in page.nodes)
        for block, kept in zip(page.blocks, S.label_blocks(page, weights), strict=True):
            right += len(block.text) * (kept == (block.text in want))
            total += len(block.text)
    assert right / total > 0.97


def test_fit_without_examples(spark):
    frame = spark.createDataFrame([("<p>a</p>",), (None,), ("",)], "html string")
    assert S.fit(frame) == PRIOR and S.fit(frame.limit(0)) == PRIOR
    assert S.fit_weights(np.zeros((0, len(PRIOR))), np.zeros(0)).tolist() == PRIOR


def test_odd_pages(spark):
    long = "<article>" + "<p>Some words, and a number: 12.</p>" * 40_000 + "</article><footer>foot</footer>"
    rows = [(1, "u", None), (2, None, ""), (None, "u", " \n "), (3, "u", PAGE), (3, "u", PAGE), (None, None, long), (4, "u", "<<>&<p"), (5, "u", "\x00<article>\x00x")]
    frame = spark.createDataFrame([(*r, "t", "n", "k", "o") for r in rows], "page_id long, url string, html string, text string, n_chars string, key string, one string")
    found = S.extract_main_text(frame).collect()
    want = {PAGE: "\n".join(TEXT), long: "\n".join(["Some words, and a number: 12."] * 40_000)}
    got = sorted(((r.page_id, r.url, r.n_chars) for r in found), key=repr)
    texts = {(r.page_id, r.url): r.text for r in found}
    assert texts[3, "u"] == want[PAGE] and texts[None, None] == want[long] and texts[1, "u"] == texts[2, None] == texts[None, "u"] == ""
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in found)
    assert S.extract_main_text(frame.limit(0)).count() == 0


def test_a_deep_and_a_wide_page():
    deep = "<article>" + "<div>" * 20_000 + "deep" + "</div>" * 20_000 + "<p>wide</p>" * 20_000
    assert S.main_text(deep, PRIOR) == "\n".join(["deep"] + ["wide"] * 20_000)
