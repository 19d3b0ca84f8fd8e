import html
import re
import time

import pytest

from tests.conftest import SMALL
from tidemark.llm.html_text import extract, main_text

from .cases import clashing


def article(page):
    """The article of a generated page, by its markers."""
    body = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    body = re.sub(r"<[^>]*>", " ", re.sub(r"</?(p|h1)\b[^>]*>", "\0", body))
    return "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in body.split("\0")) if x)


def test_generated_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    got = {r.page_id: r for r in extract(pages).collect()}
    for p in pages.collect():
        assert got[p.page_id].text == article(p.html) and got[p.page_id].n_chars == len(article(p.html))


def test_boilerplate_around_the_text():
    text = "A long enough paragraph of real prose, with commas and more than a few words in it. " * 3
    page = f"""<html><head><title>t</title><style>x{{}}</style></head><body>
      <header><h1>Site</h1></header><div class="nav-bar"><a href=x>one</a> <a href=y>two</a></div>
      <div id="cookie-notice">We use cookies, lots of them, see our policy for all the details of it.</div>
      <div class="content"><h2>Title &amp; more</h2><p>{text}<p>Second&nbsp;one, {text}<ul><li>item a<li>item b</ul>
      <table><tr><td>cell</td></tr></table><pre>a
      b</pre><div class="ad">Buy now</div><form><input value=z>Search</form></div>
      <aside>Read this too</aside><section id="comments"><p>{text}</p></section>
      <script>if (a < b) document.write("<p>no</p>")</script><footer>(c) someone</footer></body></html>"""
    want = ["Title & more", text.strip(), "Second one, " + text.strip(), "item a", "item b", "cell", "a b"]
    assert main_text(page) == "\n".join(want)


def test_names_inside_other_names_and_around_the_page():
    text = "A long enough paragraph of real prose, with commas and more than a few words in it. " * 4
    more = '<div class="main-nav"><a href=x>one</a></div><div id="ad-300x250">Buy now</div><div class="footer">(c) us</div>'
    for name in ("content has-sidebar", "no-comments", "page-with-sidebar", "share-enabled", "sidebar", "content widget", "comments"):
        for tag in ("div", "section", "article"):
            page = f'<html><body><{tag} class="{name}"><p>{text}</p><p>{text}</p>{more}</{tag}></body></html>'
            assert main_text(page) == f"{text.strip()}\n{text.strip()}"
            assert main_text(f"<main>{page}</main>") == main_text(page)
    head = f'<div class="content"><div class="post-header"><h1>The title</h1></div><p>{text}</p></div>'
    assert main_text(head) == f"The title\n{text.strip()}"
    assert main_text(f'<div class="ad">{text}</div><main><article><p>Short.</p></article></main>') == "Short."
    # readers may write more than the author
    page = f'<div class="content"><p>{text}</p></div><div id="comments">{"<p>I agree with all of this, and more.</p>" * 30}</div>'
    assert main_text(page) == text.strip()


def test_broken_and_empty_pages():
    assert main_text(None) == main_text("") == main_text("<html><body></body></html>") == ""
    assert main_text("just text &lt;b&gt;") == "just text <b>"
    assert main_text("<p>one<p>two<div>three") == "one\ntwo\nthree"
    assert main_text("<p>a <b>b</p><p>c</b> d") == "a b\nc d"
    assert main_text("<p>x<br>y<!-- no <p>no</p> --> z &unknown; &amp") == "x y z &unknown; &"
    assert main_text("<div>" * 20_000 + "deep") == "deep"
    assert main_text('<p title="a > b">q</p><script>') == "q"
    assert main_text("a <") == "a <" and main_text("<p>a < b</p>") == "a < b"


def test_odd_rows(spark):
    rows = [(1, "u", "<p>a</p>"), (1, "u", "<p>a</p>"), (None, None, None), (2, "u", ""), (3, "u", "<p>" + "long text " * 200_000)]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = extract(pages).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, 0), (1, 1), (1, 1), (2, 0), (3, 1_999_999)]
    assert extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "bit",
    ["<a ", '<a x="', "<a x='", "</a ", '<div class="a b c" ', "<a\"'", "<", "<!", "<!--", "<![CDATA[", "&", "&#", "<a'\">", "<i><b></u>", "<a x='\"", "</p><p"],
)
def test_hostile_pages_of_2_mb(bit):
    for tail in ("", '"', "'", ">", "'>", '">', "</p>", "<"):
        page = f"<body><p>hello</p>{bit * (2_000_000 // len(bit))}{tail}"
        start = time.process_time()
        assert main_text(page).startswith("hello") or bit in ("&", "&#", "<")
        assert time.process_time() - start < 10


def test_deep_stacks_take_one_sweep():
    n = 100_000
    for page in (
        "<b><div>" + "<i>" * n + "</b>" * n,
        "<p><table>" + "<i><div>" * n,
        "<ul><li>" + "<i>" * n + "<li>" * n,
        '<div class="ad">' * n + "text",
        '<div class="ad">text</div>' * n,
        "<table><tr>" + "<td><b>" * n,
    ):
        start = time.process_time()
        main_text(page)
        assert time.process_time() - start < 10


def test_tags_end_where_the_quotes_do():
    assert main_text("<p title='a > b' class=\"x > y\">q</p>") == "q"
    assert main_text('<p>1</p><p a="b>2</p><p>3</p>') == '1\n<p a="b>2\n3'
    assert main_text("<p>x <a 'b\">c</p>d") == "x <a 'b\">c\nd"
    assert main_text("<p>1<!-- a --!> 2 <!-- > -- b --> 3<![CDATA[ <4> ]]></p>") == "1 2 3 <4>"
    assert main_text("<p>1<!doctype x>2<?php 3 ?>4</p>") == "124"


def test_the_densities_choose_among_named_parts():
    """No share of the text is a limit: the part that holds more of an article stays, whatever it is called."""
    line = "A sentence of real prose, with commas and more than a few words in it. " * 2
    for own, beside in ((3, 2), (9, 1), (6, 5)):
        for name in ("sidebar", "widget", "promo"):
            part = lambda n: f"<p>{line}</p>" * n
            page = f'<div class="{name}">{part(own)}</div><div class="content">{part(beside)}</div>'
            assert main_text(page).count("A sentence") // 2 == own + beside  # the rest has no such name
            page = f'<div class="{name}">{part(beside)}</div><div class="content">{part(own)}</div>'
            assert main_text(page).count("A sentence") // 2 == own
