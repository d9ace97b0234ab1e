"""Main text of pages: layouts, markup rules, the tree, and the given pages against a plain reading of their one layout."""

import html
import re
import time

import pytest

from caseflow.llm.main_text import FEATURES, blocks_of, grow, labelled, main_text, with_neighbours

LONG = "It rained for the whole of the week and the river rose until the meadows near the mill were under water again."
LINKS = '<a href="/a">Home</a> <a href="/b">News from here</a> <a href="/c">About us</a>'


def decide(tree, features):
    while isinstance(tree, tuple):
        tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
    return tree


def text_of(page, tree=grow(labelled())):
    return " ".join(b[0] for b in with_neighbours(blocks_of(page)) if decide(tree, b[1:]))


def test_tree_knows_its_table():
    rows = labelled()
    tree = grow(rows)
    assert len(rows) < 200 and all(decide(tree, x) == label for x, label in rows)
    assert grow([((1.0,), 1), ((1.0,), 0)]) == 1 and grow([((float(i),), int(i > 2)) for i in range(6)]) == (0, 2.5, 0, 1)
    assert {"links", "words", "words_before", "words_after", "links_before"} <= set(FEATURES)


@pytest.mark.parametrize("before, after", [
    (f"<header><h1>The Site</h1><p>{LONG}</p></header>", ""), (f"<nav><ul><li>{LINKS}</ul></nav>", ""),
    ('<div class="cookie-notice">We use cookies. <button>Fine</button></div>', ""),
    (f'<div id="sidebar"><p>{LONG}</p></div>', ""), (f"<aside><p>{LONG}</p></aside>", f"<footer><p>{LONG}</p></footer>"),
    (f'<div class="adBox"><p>{LONG}</p></div>', ""), (f"<form><p>{LONG}</p><input></form>", ""),
    ("", f'<section id="comments"><h2>Comments</h2><article class="comment"><p>{LONG}</p></article></section>'),
    ("", f'<div class="related-posts"><p>{LONG}</p></div>'), ("", f'<div role="complementary"><p>{LONG}</p></div>'),
    ("", f'<div hidden><p>{LONG}</p></div>'), ("", f"<div style='display: none'><p>{LONG}</p></div>"),
    (f"<script>document.write('<p>{LONG}</p>')</script><style>p > b {{}}</style><noscript>{LONG}</noscript>", "")])
def test_other_matter_goes(before, after):
    article = f"<article><h1>High water</h1><p>{LONG}</p><p>Short.</p><p>{LONG} <a href='x'>More</a></p></article>"
    want = f"High water {LONG} Short. {LONG} More"
    assert text_of(f"<html><head><title>x</title></head><body class='has-sidebar'>{before}{article}{after}</body></html>") == want
    inside = article.replace("<p>Short.</p>", f"{before}<p>Short.</p>{after}")
    if "<header>" not in before:
        assert text_of(f"<body><main>{inside}</main>") == want
    loose = article.replace("article>", "div>")
    assert text_of(f"<body>{before}<div id=content>{loose}</div>{after}") == want


def test_pages_without_any_marks():
    page = (f"<body><div>{LINKS}</div><div>A flood in spring</div><div>{LONG}</div><div>{LONG}</div><div>The end came.</div>"
            f"<div>{LONG}</div><div>{LINKS}</div><div>All rights reserved 2020</div>")
    assert text_of(page) == f"A flood in spring {LONG} {LONG} The end came. {LONG}"


def test_markup_rules():
    page = ("<article><p>One&nbsp;two\n three<b>four</b><br>five a < b &amp;amp; &#233; &copy <!-- <p>no</p> --> six<wbr>seven"
            "<p>eight<p title='>'>nine<ul><li>ten<li>eleven</ul><td>twelve<td>thirteen<img alt=x>fourteen</article>")
    assert text_of(page) == (
        "One two threefour five a < b &amp; é © sixseven eight nine ten eleven twelve thirteenfourteen")
    assert text_of("<article><p>open and <b") == "open and"
    assert text_of("<article><p>a<script>x</p></article>") == "a"
    assert text_of("") == text_of("<") == text_of("   ") == text_of("<p></p>") == ""


@pytest.mark.parametrize("piece", ["<div>", "<a <a ", "<", "<a '", "<p", "&", "<!--", "<script>", "</", '<a href="', "<ul><li>",
                                   "</nothing>", "<![CDATA["])
def test_long_broken_pages_take_linear_time(piece):
    started = time.time()
    text_of("<article>" + piece * 100_000 + "</span2>" * 100_000)
    assert time.time() - started < 20


def given(page):
    """The one layout of the given pages."""
    found = re.search(r"<article>(.*?)</article>", page or "", re.S)
    plain = re.sub(r"<[^>]*>", " \0 ", re.sub(r"</?b>", "", found[1] if found else ""))
    return " ".join(html.unescape(plain).replace("\0", " ").split())


def test_given_pages_and_edge_rows(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r for r in main_text(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for row in rows:
        mine = got[row["page_id"]]
        assert mine["text"] == given(row["html"]) and mine["n_chars"] == len(mine["text"]) and mine["url"] == row["url"]
    whole = f"<article>{f'<p>{LONG}</p>' * 20_000}</article>"
    edge = spark.createDataFrame(
        [(1, "u", None, 5), (2, None, "", 5), (3, "u", whole, 5), (3, "u", whole, 5), (None, "😀", "<article>😀 x</article>", 5)],
        "page_id long, url string, html string, text int")
    got = sorted(map(tuple, main_text(edge).collect()), key=repr)
    long = " ".join([LONG] * 20_000)
    assert got == sorted([(1, "u", "", 0), (2, None, "", 0), (3, "u", long, len(long)), (3, "u", long, len(long)),
                          (None, "😀", "😀 x", 3)], key=repr)
    assert main_text(edge.limit(0)).collect() == []
