"""Main text of pages: those of the table against their articles, pages of other shapes, and hostile markup."""

import html as H
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import queries as Q
from millrace.llm.main_text import content_cluster, extract_pages, is_other, main_text, smoothed

SF = "/root/testdata/sf0.001"
LONG = "This paragraph has a good many words, so that the ratio of its text to its tags is high, as it is in articles."


def blocks_of_article(page):
    """What stands in <article>, cut at its h1 and p tags."""
    inside = re.search(r"<article>(.*)</article>", page, re.S)[1]
    texts = [" ".join(H.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
    return "\n\n".join(t for t in texts if t)


def test_articles_of_all_pages(spark):
    want = {r["page_id"]: (r["url"], blocks_of_article(r["html"])) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = Q.op13_main_text(spark, SF).collect()
    assert {r["page_id"]: (r["url"], r["text"]) for r in got} == want and all(r["n_chars"] == len(r["text"]) for r in got)


FURNITURE = {
    "nav": "<nav><ul><li><a href='/a'>Home of all</a></li><li><a href='/b'>News</a></li></ul></nav>",
    "header": f"<header><a href='/'>Site</a><p>{LONG} Header.</p></header>",
    "class": f"<div class='cookie-consent bar'><p>{LONG} Cookies.</p></div>",
    "id": f"<div id='leftSidebar'><p>{LONG} Sidebar.</p></div>",
    "role": f"<div role='complementary'>{LONG} Side.</div>",
    "aside": f"<aside><p>{LONG} Aside.</p></aside>",
    "ad": f"<div class='ad'>{LONG} Advert.</div>",
    "form": f"<form><p>{LONG} Form.</p><textarea>{LONG}</textarea><button>Go</button></form>",
    "script": f"<script>var x = '<p>{LONG}</p>';</script><style>p {{ margin: 0 }}</style><noscript>{LONG}</noscript>",
    "comments": f"<section class='comments'><article><p>{LONG} Reader.</p></article></section>",
    "heading": f"<section><h3>12 Comments</h3><p>{LONG} Reader.</p></section>",
    "hidden": f"<div hidden><p>{LONG} Hidden.</p></div>",
    "footer": f"<footer><p>{LONG} Footer &copy;</p></footer>",
    "links": "<ul><li><a href='/1'>Another story that you may like to read</a></li><li><a href='/2'>And one more story for you to read</a></li></ul>",
    "comment": f"<!-- <p>{LONG} comment</p> -->",
}
ARTICLE = f"<h1>A title</h1><p>{LONG}<p>Short.</p><h2>Part</h2><p>{LONG} With <a href='/x'>a link</a> &amp; <b>more</b>&nbsp;text.</p><ul><li>one<li>two</ul><blockquote>{LONG}</blockquote><p>End.</p>"
WANT = ["A title", LONG, "Short.", "Part", f"{LONG} With a link & more text.", "one", "two", LONG, "End."]


@pytest.mark.parametrize("around", ["article", "main", "div", "div class='post-content has-sidebar'", "section id='main'"])
@pytest.mark.parametrize("part", sorted(FURNITURE))
def test_furniture_is_left_out(part, around):
    end = around.split()[0]
    page = f"<html><head><title>T</title></head><body>{FURNITURE[part]}<div id=wrap><{around}>{ARTICLE}</{end}>{FURNITURE[part]}</div></body></html>"
    assert main_text(page).split("\n\n") == WANT
    if part not in ("links", "header"):  # an article may have a header of its own
        inside = f"<body><{around}>{ARTICLE.replace('<h2>', FURNITURE[part] + '<h2>')}</{end}></body>"
        assert main_text(inside).split("\n\n") == WANT


def test_pages_without_an_element_for_the_article():
    bare = f"<body><a href='/'>Home</a> | <a href='/n'>News</a><h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p><div><a href='/t'>Terms</a></div></body>"
    assert main_text(bare).split("\n\n") == ["Title", LONG, "Short.", LONG]
    assert main_text("no  markup\n &lt; at all") == "no markup < at all"
    assert main_text("<p>a<br>b<p>c&nbsp;\t d</p>") == "a b\n\nc d"
    assert main_text("<table><tr><td>a<td>b<tr><th>c</table>") == "a\n\nb\n\nc"
    teasers = "".join(f"<article><p>{LONG} {i}</p></article>" for i in range(3))
    assert main_text(f"<main>{teasers}</main>").split("\n\n") == [f"{LONG} {i}" for i in range(3)]


def test_names_of_parts():
    assert all(map(is_other, ["main-nav", "post-share", "siteHeader", "x ad", "widget_text", "cookie", "entry-footer", "commentList"]))
    assert not any(map(is_other, ["", "article-header", "has-sidebar", "no-comments", "advanced", "content", "elementor-widget-container", "add", "breads"]))


@pytest.mark.parametrize("piece", ["<!", "<", "&", "<a ", "<!-- ", "<![", "<![CDATA[", "<?", "</", "<script>", "<title>", "<svg>", "<a b='", "&#", "<p>", "<div>", "</div>", "<b><p>x", "<table><td>"])
def test_hostile_markup_takes_linear_time(piece):
    for page in (piece * 20_000, piece * 20_000 + ">", f"<p>{LONG}</p>" + piece * 2_000):
        began = time.time()
        text = main_text(page)
        assert time.time() - began < 5 and isinstance(text, str)
    assert main_text(f"<p>{LONG}</p>" + piece).startswith(LONG)


def test_smoothing_and_cluster():
    ratios = np.array([1.0, 1, 1, 200, 180, 5, 220, 1, 1, 1, 1, 1])
    kernel = np.exp(-0.5 * (np.arange(-3, 4)) ** 2)
    padded, ones = np.r_[0, 0, 0, ratios, 0, 0, 0], np.r_[0, 0, 0, np.ones(12), 0, 0, 0]
    want = [padded[i : i + 7] @ kernel / (ones[i : i + 7] @ kernel) for i in range(12)]
    assert np.allclose(smoothed(ratios, 1.0), want) and np.allclose(smoothed(ratios[:4], 1.0)[0], ratios[:4] @ kernel[3:] / kernel[3:].sum())
    assert np.flatnonzero(content_cluster(ratios)).tolist() == [2, 3, 4, 5, 6, 7]
    assert content_cluster(np.array([7.0])).all() and content_cluster(np.full(5, 3.0)).all()


def test_odd_rows(spark):
    rows = [(1, "u", None), (None, None, ""), (2, "u", "<p>é 😀</p>"), (2, "u", "<p>é 😀</p>"), (3, "", "<div>"), (4, "x", "<p>" + "word " * 300_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("text", "n_chars", "row", "lines")})
    got = sorted(((r["page_id"] or 0, r["url"], r["text"], r["n_chars"]) for r in extract_pages(df).collect()), key=repr)
    assert [g[2:] for g in got] == [("", 0), ("", 0), ("é 😀", 3), ("é 😀", 3), ("", 0), (("word " * 300_000).strip(), 1_499_999)]
    assert extract_pages(df.limit(0)).count() == 0
