"""Main text of pages whose main text is known, and odd inputs."""

from __future__ import annotations

import html
import re

import pytest
from pyspark.sql import functions as F

from creditledger.llm import html_text as h


@pytest.fixture(scope="module")
def tree():
    return h.trained()


def article(page):
    """The text of a given page's article element, by its known build."""
    body = re.search(r"<article>(.*)</article>", page, re.S).group(1)
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", body)).split())


def test_given_pages(spark, tree):
    folder = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = h.op5_html_extraction(spark, folder).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == article(pages[r.page_id].html)
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


P1 = "A paragraph of the article that is long enough to be read as running text by anyone."
P2 = "Another one, with a <a href='/x'>link</a>, some <b>bold</b>face and an &eacute; for good measure."
P2_TEXT = "Another one, with a link, some boldface and an é for good measure."

AROUND = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body class="page">
<header><h1><a href="/">Site</a></h1><p>A slogan of the site that goes on for some words here</p></header>
<nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
<div id="cookie-banner"><p>We use cookies to improve your experience on this web site, as ever.</p></div>
{main}
<aside class="sidebar"><h3>Popular</h3><p>A teaser text about something else that readers may like.</p></aside>
<section id="comments"><h2>Comments</h2><div class="comment"><p>I do not agree with this article at all, my friend.</p></div></section>
<form><label>Mail</label><input><button>Send it</button></form>
<footer><p>&copy; 2024 The company that owns this site and all of its many texts.</p></footer>
<script>var s = "<p>not text</p>";</script></body></html>"""


@pytest.mark.parametrize(
    "main",
    [
        "<article><h1>The title</h1><p>{a}</p><p>{b}</p><p>End.</p></article>",
        "<main><h1>The title</h1><p>{a}<p>{b}<p>End.</main>",
        "<article><header><h1>The title</h1></header><p>{a}</p><div class='ad'>Buy this now</div>"
        "<p>{b}</p><div class='share-buttons'><a href='/s'>Share</a></div><p>End.</p></article>",
        "<div class='content'><h1>The title</h1><p>{a}</p><p>{b}</p><p>End.</p></div>",
        "<article><h1>The\n  title</h1><!-- a <p>comment</p> --><p>{a}</p><p hidden>Not this</p>"
        "<p class='advert'>Nor that one</p><p>{b}</p><script>x('<p>')</script><p>End.</p></article>",
    ],
)
def test_templates(tree, main):
    page = AROUND.format(main=main.format(a=P1, b=P2))
    assert h.main_text(page, tree) == f"The title {P1} {P2_TEXT} End."


def test_link_lists_are_left_out(tree):
    links = "".join(f"<li><a href='/{i}'>Story number {i}</a></li>" for i in range(8))
    page = f"<body><ul>{links}</ul><p>{P1}</p><p>{P1}</p><ul>{links}</ul></body>"
    assert h.main_text(page, tree) == f"{P1} {P1}"


def test_broken_pages(tree):
    assert h.main_text(None, tree) == h.main_text("", tree) == ""
    assert h.main_text("<article><p>Only this <b>one", tree) == "Only this one"
    assert h.main_text("<article><p>a &lt; b &amp;amp; c &nbsp; d</article>", tree) == "a < b &amp; c d"
    assert h.main_text("<article><p>x<!-- never closed <p>y", tree) == "x"
    assert h.main_text("<article><p>x</p><script>never closed <p>y", tree) == "x"
    assert h.main_text("<article><p>1 < 2 and 3 > 2</p></article>", tree) == "1 < 2 and 3 > 2"
    assert h.main_text("</div></nav><article></p><p title='a > b'>x</article>", tree) == "x"


def test_the_tree_fits_its_table(tree):
    import numpy as np

    table = np.array(h.LABELLED, float)
    assert [h.is_main(tree, row) for row in table[:, :-1]] == table[:, -1].astype(bool).tolist()


def test_odd_rows(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, "<p>x"), (2, "u", "<article><p>" + "long text " * 50000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = h.extract(pages.withColumn("text", F.lit(1))).collect()
    assert len(out) == 4
    assert [r._html_text for r in out if r.page_id == 1] == ["", ""]
    assert h.extract(pages.filter("1 = 0")).count() == 0


@pytest.mark.parametrize(
    "name",
    ["layout has-sidebar", "elementor-widget-container", "post social-studies", "popular-science", "commentary", "widget"],
)
@pytest.mark.parametrize("element", ["article", "div"])
def test_wrappers_with_a_hint_in_their_name(tree, name, element):
    long = " ".join(f"word{i}" for i in range(70))
    body = f"<h1>The title</h1><p>{long}</p><p>Short one.</p><p>{long}</p>"
    ads = "<div class='ad'>Buy this now</div><div class='related'><article>A teaser</article></div>"
    page = f"<body><nav><a href='/'>Home</a></nav><div class='{name}'><{element}>{body}</{element}>{ads}</div></body>"
    assert h.main_text(page, tree) == f"The title {long} Short one. {long}"


def test_long_text_under_part_of_a_name(tree):
    long = " ".join(f"word{i}" for i in range(70))
    page = f"<div>{f'<p>{long}</p>' * 4}</div><div class='social-studies'><p>{long}</p></div><div class='ad'><p>{long}</p></div>"
    assert h.main_text(page, tree) == " ".join([long] * 5)


def test_comments_longer_than_the_article(tree):
    long = " ".join(f"word{i}" for i in range(70))
    said = f"<section id='comments'>{f'<p>{long} indeed</p>' * 9}</section>"
    page = f"<div class='layout has-sidebar'><article><p>{long}</p></article>{said}</div>"
    assert h.main_text(page, tree) == long


LONG = " ".join(f"word{i}" for i in range(70))


def test_comments_in_list_items(tree):
    said = f"<ol><li class='comment'><p>{LONG}</p><p>{LONG}</p></li><li class='comment'><p>{LONG}<li><p>{LONG}</p></li></ol>"
    page = f"<article><p>{P1}</p></article>{said}"
    kept = h.main_text(page, tree)
    assert kept.startswith(P1) and kept.count("word1 ") <= 1
    page = f"<article><p>{P1}</p><ol><li class='comment'><p>{LONG}</p></li><li>An item.</li></ol><p>End.</p></article>"
    assert h.main_text(page, tree) == f"{P1} An item. End."


def test_inline_adverts(tree):
    page = f"<article><p>Some <span class='ad'>buy <span>this</span> now</span>text <b class='ad'>here</p><p>{P1}</p></article>"
    assert h.main_text(page, tree) == f"Some text {P1}"
    page = f"<article><p>A <span class='social-name'>name</span> <img class='ad'>stays.</p><p>{P1}</p></article>"
    assert h.main_text(page, tree) == f"A name stays. {P1}"


@pytest.mark.parametrize("name", ["cookie-banner", "user-comments", "page-sidebar", "site-notice"])
def test_long_text_under_the_last_word_of_a_name(tree, name):
    page = f"<article><p>{P1}</p><p>{LONG}</p></article><div class='{name}'><p>{LONG}</p></div>"
    assert h.main_text(page, tree) == f"{P1} {LONG}"


def test_names_of_what_a_container_has(tree):
    page = f"<body><div class='has-sidebar'><p>{P1}</p></div><div class='no-comments'><p>{P1}</p></div></body>"
    assert h.main_text(page, tree) == f"{P1} {P1}"


def test_short_pages(tree):
    assert h.main_text("<p>Hello world</p>", tree) == "Hello world"
    page = "<nav><a href='/'>Home</a></nav><div id='content'><h1>News</h1><p>One.</p><p>Two.</p><p>Three.</p></div>"
    assert h.main_text(page + "<div class='ad'>Buy</div>", tree) == "News One. Two. Three."


def test_a_line_of_copyright(tree):
    page = f"<div><p>{P1}</p><p>{LONG}</p></div><p>Copyright 2024 The company, all rights are reserved</p>"
    assert h.main_text(page, tree) == f"{P1} {LONG}"
    page = f"<article><p>Copyright law of 1976 is the topic.</p><p>{P1}</p></article>"
    assert h.main_text(page, tree) == f"Copyright law of 1976 is the topic. {P1}"


@pytest.mark.parametrize("name", ["div", "ul", "span"])
def test_deeply_nested_pages_take_linear_time(tree, name):
    import time

    page = "".join(f"<{name}>word{i} " for i in range(8000))
    started = time.monotonic()
    h.blocks_of(page)
    assert time.monotonic() - started < 1.0
