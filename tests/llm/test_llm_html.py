"""Main text of crafted and of real pages."""

from __future__ import annotations

import html as html_module
import re
import time

import pytest
from conftest import SMALL

from quotewright.llm import registry
from quotewright.llm.html_text import main_text

PROSE = "This sentence, which has a comma or two, is long enough to count as prose on any page."
MORE = "Another paragraph, with other words in it, follows here and tells the rest of the story."

NOISE = {
    "menu": "<nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News, sports, and weather for everybody today</a></li></ul></nav>",
    "header": f"<header><h2>The Daily Site</h2><p>{PROSE[::-1]}</p></header>",
    "footer": "<footer>&copy; 2020, all rights, everywhere, reserved by the publishers of this site.</footer>",
    "sidebar": "<div class='side-bar sidebar'><p>Read also, if you like, these other fine stories from our site.</p></div>",
    "aside": "<aside><p>Read also, if you like, these other fine stories from our site, every day.</p></aside>",
    "notice": "<div id='cookie-notice'><p>We use cookies, and so do our partners, to improve your visit here.</p></div>",
    "advert": "<div class=ad>Buy now, pay later, and get one free, today only, in all shops.</div>",
    "form": "<form><p>Your name, please, and your address, to subscribe to the letter.</p><input name=q value=x></form>",
    "script": "<script>if (a < b) document.write('<p>Scripted, text, with, commas, that, is, no, text</p>')</script>",
    "style": "<style>p > a, div { color: red }</style>",
    "comments": "<div id=comments><div class=comment><p>Great article, thanks, I learned a lot, and so on, and on.</p></div></div>",
    "comment": f"<!-- <p>{MORE}</p> -->",
    "hidden": f"<div style='display: none'><p>{MORE[::-1]}</p></div>",
    "role": f"<div role=complementary><p>{MORE[::-1]}</p></div>",
}
LAYOUTS = {
    "article": "<article><h1>Title</h1>{}</article>",
    "main": "<main><h1>Title</h1><div class=content>{}</div></main>",
    "div": "<div class='post'><h1>Title</h1>{}</div>",
    "table": "<table><tr><td><h1>Title</h1>{}</td></tr></table>",
}


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("noise", [*NOISE, "all"])
def test_noise_goes_and_the_article_stays(layout, noise):
    parts = list(NOISE.values()) if noise == "all" else [NOISE[noise]]
    body = LAYOUTS[layout].format(f"<p>{PROSE}</p><p>Short.</p><ul><li>one</li><li>two</li></ul><p>{MORE}</p>")
    half = len(parts) // 2
    page = f"<!DOCTYPE html><html><head><title>T</title></head><body>{''.join(parts[:half])}{body}{''.join(parts[half:])}</body></html>"
    assert main_text(page) == "\n".join(["Title", PROSE, "Short.", "one", "two", MORE])


def test_noise_inside_the_article():
    inside = "".join(v for k, v in NOISE.items() if k != "header")
    assert main_text(f"<body><article><p>{PROSE}</p>{inside}<p>{MORE}</p></article></body>") == f"{PROSE}\n{MORE}"


def test_wrappers_and_own_headers_are_no_noise():
    page = f"""<body class="with-sidebar"><div id="page"><header><h2>Site</h2></header><div class="content-sidebar-wrap">
        <div class="post"><header class="entry-header"><h1>Title</h1></header><p>{PROSE}</p><p>{MORE}</p></div>
        <div class="sidebar widget-area"><p>{PROSE[::-1]}</p></div></div></div></body>"""
    assert main_text(page) == f"Title\n{PROSE}\n{MORE}"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("   \n", ""), ("<html></html>", ""), ("<script>x</script>", ""), ("plain text", "plain text"),
        ("<p>a &lt;b&gt; &amp;amp; &eacute;&#233;&#x1F600; &nbsp; c", "a <b> &amp; éé😀 c"),
        ("<p>one<p>two<br>three</p>four", "one\ntwo three\nfour"),
        ("<p><b>bold<br><p>next</p>", "bold\nnext"),
        ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
        ("<p>x</b></i></span> y", "x y"),
        ("<p title='a > b' data-x=\"</p>\">kept</p>", "kept"),
        ("<p>ends inside a tag <a href='x", "ends inside a tag"),
        ("<p>in<em>li</em>ne</p>\n\n<p> sp\t\n aces </p>", "inline\nsp aces"),
        ("<table><tr><td>a<td>b<tr><td>c", "a b\nc"),
        ("<p>A</p><textarea><p>not</p></textarea><p>B</p><!-- never ended <p>C</p>", "A\nB"),
    ],
)
def test_markup(page, text):
    assert main_text(page) == text


def test_very_long_and_deep_pages():
    begun = time.time()
    assert main_text(f"<article>{f'<p>{PROSE}</p>' * 20_000}</article>").count("\n") == 19_999
    assert main_text("<div>" * 50_000 + "x") == "x"
    assert main_text("<a '" * 50_000) == ""
    assert main_text("<li>" * 20_000 + "x") == "x"
    assert time.time() - begun < 60


def test_op3_whole_table(spark):
    """The test pages have one article each, of a heading and paragraphs."""
    pages = {r.page_id: r for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    rows = registry.op3_tree_scoring(spark, SMALL).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id].html, re.S)[1]
        blocks = [" ".join(html_module.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
        assert (r.url, r.text) == (pages[r.page_id].url, "\n".join(x for x in blocks if x))
        assert r.n_chars == len(r.text)


def test_odd_rows(spark):
    from quotewright.llm.html_text import extract_text

    rows = [(1, None, "t"), (None, "<p>x</p>", None), (None, "<p>x</p>", None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, raw string")
    assert [r.text for r in extract_text(pages).collect()] == ["", "x", "x"]
    assert extract_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 12_000 + "<li>x</li>" * 12_000,
        "<b>" * 20_000 + "</i>" * 20_000,
        '<div class="wrap">' * 6_000 + "<h1>a</h1>",
        "<li><ul>" + "<div>" * 12_000 + "<li>x</li>" * 12_000,
        "<p>" * 20_000 + "</div>" * 20_000,
        "<table>" * 3_000 + "<td>x" * 9_000,
    ],
)
def test_odd_pages_take_no_longer(page):
    start = time.process_time()
    main_text(page)
    assert time.process_time() - start < 5
