from __future__ import annotations

import html
import re

import numpy as np
import pytest

from storelift.llm import htmlmain, queries
from storelift.llm.htmltree import read_page

SF = "/root/testdata/sf0.01"
PARA = "The harbour was quiet that morning, and the boats lay still. Nobody spoke, although the market had opened early. " * 2


@pytest.fixture(scope="module")
def model(spark):
    return htmlmain.fit(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html"))


def test_whole_table(spark):
    rows = {r.page_id: r for r in queries.op4_main_text(spark, SF).collect()}
    for page in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = re.search(r"<article>(.*)</article>", page.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n".join(b for b in blocks if b)
        got = rows[page.page_id]
        assert got.text == want and got.n_chars == len(want) and got.url == page.url


@pytest.mark.parametrize("source, want", [
    (f'<div class="topbar"><a href=/>Home</a></div><div id="sidebar"><ul><li><a href=1>One</a></li></ul></div><div class="content"><h1>Title</h1>'
     f'<p>{PARA}</p><p>Short end.</p></div><div id="comments"><div class=comment><p>{PARA}</p></div></div><div class="cookie-notice">We use cookies.</div>',
     ["Title", PARA, "Short end."]),
    (f'<header><h2>Site</h2></header><nav><ul><li><a href=1>A</a></li></ul></nav><main><article><h1>Title</h1><p>{PARA}</p><aside><p>Sponsored.</p></aside>'
     f'<ul><li>point one</li></ul><section class="comments"><h3>Comments</h3><p>{PARA}</p></section></article></main><footer>c 2020</footer>',
     ["Title", PARA, "point one"]),
    (f"<p>{PARA}<p>{PARA}", [PARA, PARA]),
])
def test_unseen_layouts(model, source, want):
    assert htmlmain.main_text(read_page(source), model) == "\n".join(" ".join(w.split()) for w in want)


def test_no_kept_node_under_a_dropped_one():
    page = read_page("<div><div><p>a</p><p>b</p></div><section><p>c</p></section></div>")
    rng = np.random.default_rng(0)
    for _ in range(200):
        margin = rng.normal(0, 3, len(page.tag))
        keep = htmlmain.decode(page, margin)
        assert all(keep[page.parent[i]] for i in range(1, len(keep)) if keep[i])
        # The best of all consistent choices.
        best = max((sum(margin[i] for i in range(1, len(page.tag)) if bits >> i & 1) for bits in range(2 ** len(page.tag))
                    if all(bits >> page.parent[i] & 1 or page.parent[i] == 0 for i in range(1, len(page.tag)) if bits >> i & 1)))
        assert abs(sum(margin[1:][keep[1:]]) - best) < 1e-9


def test_reader():
    page = read_page("<p>A&amp;B&nbsp; c<br>d <b>e</b>f<script>if (a</p>b) {}</script><style>x</style><!-- no > --><p>g<ul><li>h<li>i</ul><td>j")
    assert page.block_text == ["A&B c d ef", "g", "h", "i", "j"]
    assert read_page('<a href="x>y">t</a> <div class=\'q\'>u</div>v').block_text == ["t", "u", "v"]
    deep = read_page("<div>" * 3000 + "x")
    assert deep.block_text == ["x"] and max(deep.depth) == 3000
    assert read_page(None).block_text == [] and read_page("<<<>>").tag == ["#root"]
    assert read_page("<!-- open <p>x").block_text == [] and read_page("<script>never closed <p>x").block_text == []


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    t = htmlmain.Trees(x[:3000], y[:3000])
    assert ((t.margin(x[3000:]) > 0) == y[3000:]).mean() > 0.97


def test_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<nav>menu</nav>"), (None, "u", f"<article><p>{PARA}</p></article>"), (4, "u", "plain words"),
            (4, "u", f"<article><p>{PARA * 400}</p></article><footer>f</footer>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "9 AS n_chars")
    got = htmlmain.extract(pages).collect()
    assert len(got) == 6
    by = {(r.page_id, r.n_chars): r.text for r in got}
    assert by[1, 0] == by[2, 0] == by[3, 0] == ""
    assert (4, len(" ".join((PARA * 400).split()))) in by
    assert htmlmain.extract(pages.where("false")).count() == 0


@pytest.mark.parametrize("source, want", [
    ("<p>a</p><object data=x><p>b</p>", ["a", "b"]),
    ("<p>a</p><video src=x><p>b</p><video>fallback</video><p>c</p>", ["a", "b", "c"]),
    ("<p>a<svg><svg><text>drawn</text></svg><text>drawn</text></svg> b<canvas>c", ["a bc"]),
    ("<html><head><title>t</title><meta charset=u><script>s</script><body><p>a</p></body></html>", ["a"]),
    ("<html><head><title>t</title><noscript><link href=x></noscript><div>a</div>b", ["a", "b"]),
    ("<head><title>t</title>a<p>b", ["a", "b"]),
    ("<head><title>t</title><noscript>no text of the page</noscript></head><p>a", ["a"]),
    ("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds<noscript> too</noscript></p>", ["so x=2 holds too"]),
    ("<p>a<iframe src=x><p>b", ["a", "b"]),
    ("<div><noscript><div>a</noscript>b<span><noscript>c</noscript></span></div>", ["a", "bc"]),
    ("<div>a<noscript>b</noscript><object><p>c</p>d</object>e</div>", ["a", "b", "c", "d", "e"]),
])
def test_no_text_is_lost_before_the_trees(source, want):
    assert read_page(source).block_text == want


def test_noscript_and_object_are_nodes():
    page = read_page("<body><noscript>a</noscript><object>b</object></body>")
    assert page.tag == ["#root", "body", "noscript", "object"] and page.block_node == [2, 3]


def test_capitals_count_over_the_whole_block():
    at = htmlmain.FEATURES.index("upper_share")
    for low, high in (("a", "B"), ("é", "É")):
        early, late = (htmlmain.node_features(read_page(f"<p>{t}</p>"))[1, at] for t in (high * 300 + low * 300, low * 300 + high * 300))
        assert early == late > 0
