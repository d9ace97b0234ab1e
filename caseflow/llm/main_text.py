"""Main text of web pages: flat text blocks, classified by a decision tree over their size, links and neighbours.

A page is cut at the tags that are not inline into flat blocks of text. A block is told by its words, its link density (the
share of its words inside links), the same of the block before and after it, whether it stands in the marked article
of the page, and whether it stands in an element that carries other matter by its tag, role or class. A decision tree
(Gini impurity, axis-parallel splits), trained on a small table of labelled blocks, says which blocks are main
text. The tree becomes one Column expression, so Python reads markup only.

Text rules: character references are decoded once; white space inside a block is one space; blocks are joined in page
order by one space; a line break is white space; ``<`` that begins no tag is text; a tag that the page ends in is dropped.
Elements that the page leaves open end with the page.

Defined cases: a null or empty html, or a page without main text, gives the empty text with 0 characters; repeated rows
are read each; pages of any length are read whole; an empty table gives an empty result; other columns are not read.
"""

import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from caseflow.llm.common import slices

# Elements whose content is no visible text.
RAW = ("script", "style", "title", "textarea", "template", "noscript", "iframe", "noembed", "noframes", "xmp", "svg", "math")
# Elements that run inside a line of text.
INLINE = frozenset((
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
    "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
    "wbr"))
VOID = frozenset((
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
# What an opening tag ends when the page leaves it open.
CLOSES = {name: frozenset(ends.split()) for name, ends in {
    "li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th", "option": "option"}.items()}
MAIN = frozenset(("article", "main"))
OTHER = frozenset((
    "nav", "footer", "aside", "form", "dialog", "menu", "button", "select", "fieldset", "head", "object", "audio", "video", "canvas"))
OTHER_ROLES = frozenset((
    "navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu",
    "menubar", "toolbar", "tooltip", "status"))
# Words in classes and ids of elements with other matter, and how such words begin.
OTHER_WORDS = frozenset((
    "ad", "ads", "alert", "aside", "gdpr", "menu", "nav", "notice", "notices", "overlay", "pager", "reply", "replies", "share"))
OTHER_STEMS = (
    "adbox", "adsense", "adslot", "adunit", "advert", "banner", "breadcrumb", "comment", "consent", "cookie", "copyright",
    "disclaimer", "disqus", "footer", "login", "masthead", "modal", "navbar", "navig", "newsletter", "paginat", "popup",
    "promo", "recommend", "related", "respond", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "subscri",
    "toolbar", "widget")
HEAD_WORDS = frozenset(("header", "head", "topbar"))
# A word after one of these tells what an element has around it, not what it is.
NOT_ITSELF = frozenset(("has", "with", "no", "without", "not"))
MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|[^>]*>)"
    r"|<[!?/][^>]*>", re.S)
ATTRIBUTE = re.compile(r"([^\s=>/\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|(?<![^\s\"'/])(hidden)(?=[\s/>])")
SPLIT = re.compile(r"[^0-9A-Za-z]+|(?<=[a-z])(?=[A-Z])")

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "main", "other")
# The labelled blocks: features as above, then 1 for main text.
LABELLED = """
12 1.0 0 0.0 9 1.0 0 1 0
5 1.0 12 1.0 8 0.0 0 1 0
8 0.0 5 1.0 10 0.0 0 1 0
40 0.0 3 1.0 60 0.0 0 1 0
95 0.02 12 0.0 80 0.0 0 1 0
9 0.0 30 0.0 0 0.0 0 1 0
25 0.1 120 0.0 14 0.0 1 1 0
60 0.0 90 0.0 70 0.0 1 1 0
3 0.0 45 0.0 80 0.0 1 1 0
150 0.0 4 0.0 6 0.0 1 1 0
10 0.0 8 0.0 70 0.0 1 0 1
1 0.0 60 0.0 45 0.0 1 0 1
2 0.0 0 0.0 0 0.0 1 0 1
3 0.0 2 0.0 1 0.0 1 0 1
6 1.0 50 0.0 70 0.0 1 0 1
14 0.6 30 0.1 22 0.0 1 0 1
85 0.0 10 0.0 120 0.0 1 0 1
130 0.05 85 0.0 9 0.0 1 0 1
700 0.01 20 0.0 0 0.0 1 0 1
20 0.0 8 0.0 10 0.0 1 0 1
7 0.0 9 0.0 3 0.0 1 0 1
33 0.2 5 0.0 2 0.0 1 0 1
44 0.0 30 0.0 6 1.0 1 0 1
5 0.0 80 0.0 3 1.0 1 0 1
4 1.0 20 0.0 5 1.0 1 0 1
11 0.3 4 1.0 4 1.0 1 0 1
70 0.0 66 0.0 2 1.0 0 0 1
34 0.03 90 0.0 4 1.0 0 0 1
110 0.0 4 1.0 3 1.0 0 0 1
48 0.0 2 1.0 1 1.0 0 0 1
55 0.0 40 0.02 75 0.0 0 0 1
90 0.04 7 0.0 60 0.0 0 0 1
38 0.0 0 0.0 0 0.0 0 0 1
26 0.05 80 0.0 95 0.0 0 0 1
140 0.1 26 0.0 12 0.0 0 0 1
24 0.0 70 0.0 4 0.5 0 0 1
62 0.25 88 0.0 30 0.0 0 0 1
19 0.0 0 0.0 44 0.0 0 0 1
17 0.0 30 0.0 28 0.0 0 0 1
9 0.0 3 1.0 75 0.0 0 0 1
7 0.0 2 1.0 64 0.02 0 0 1
6 0.0 66 0.0 58 0.0 0 0 1
12 0.0 51 0.0 47 0.1 0 0 1
4 0.0 120 0.0 90 0.0 0 0 1
8 0.0 0 0.0 52 0.0 0 0 1
4 0.0 2 1.0 21 0.0 0 0 1
2 0.0 0 0.0 18 0.0 0 0 1
3 0.0 22 0.0 20 0.0 0 0 1
1 0.0 25 0.0 23 0.05 0 0 1
6 0.0 16 0.0 15 0.0 0 0 1
22 0.0 1 0.0 23 0.05 0 0 1
16 0.0 20 0.0 0 0.0 0 0 1
10 0.0 35 0.0 41 0.0 0 0 1
2 1.0 1 1.0 2 1.0 0 0 0
3 1.0 2 1.0 9 0.0 0 0 0
1 1.0 0 0.0 1 1.0 0 0 0
4 1.0 60 0.0 5 1.0 0 0 0
7 0.9 6 1.0 8 0.8 0 0 0
30 0.8 3 1.0 4 1.0 0 0 0
45 0.95 10 0.0 12 1.0 0 0 0
22 0.7 70 0.0 3 1.0 0 0 0
18 1.0 40 0.0 55 0.0 0 0 0
60 0.9 2 1.0 80 0.0 0 0 0
5 0.0 4 1.0 3 1.0 0 0 0
3 0.0 1 1.0 6 0.0 0 0 0
6 0.0 3 0.0 4 0.0 0 0 0
8 0.0 2 1.0 5 1.0 0 0 0
4 0.0 7 0.0 2 0.0 0 0 0
9 0.2 90 0.0 3 1.0 0 0 0
7 0.0 75 0.0 0 0.0 0 0 0
5 0.4 48 0.0 0 0.0 0 0 0
3 0.0 0 0.0 2 1.0 0 0 0
8 0.3 5 0.0 0 0.0 0 0 0
2 0.0 8 0.0 1 1.0 0 0 0
4 0.0 30 0.0 8 0.0 0 0 0
5 0.0 24 0.0 9 1.0 0 0 0
3 0.0 22 0.0 2 0.0 0 0 0
6 0.5 2 0.0 9 0.0 0 0 0
"""


def labelled(table=LABELLED):
    """[(features, label)] of the labelled blocks."""
    rows = [tuple(map(float, line.split())) for line in table.strip().splitlines()]
    return [(row[:-1], int(row[-1])) for row in rows]


def _gini(rows):
    share = sum(label for _, label in rows) / len(rows)
    return len(rows) * share * (1 - share)


def grow(rows, depth=8):
    """A decision tree: a label, or (feature, threshold, tree of values up to it, tree of larger ones)."""
    ones = sum(label for _, label in rows)
    majority = int(2 * ones >= len(rows))
    if depth == 0 or ones in (0, len(rows)):
        return majority
    best = None
    for feature in range(len(rows[0][0])):
        values = sorted({x[feature] for x, _ in rows})
        for low, high in zip(values, values[1:]):
            cut = (low + high) / 2
            left = [row for row in rows if row[0][feature] <= cut]
            right = [row for row in rows if row[0][feature] > cut]
            impurity = _gini(left) + _gini(right)
            # Ties go to the earlier feature, then to the wider gap between the values.
            key = (round(impurity, 9), feature, low - high)
            if best is None or key < best[0]:
                best = key, feature, cut, left, right
    if best is None:
        return majority
    _, feature, cut, left, right = best
    left, right = grow(left, depth - 1), grow(right, depth - 1)
    return left if left == right else (feature, cut, left, right)


def says(tree, block: Column) -> Column:
    """The tree's decision about a block as a Column."""
    if not isinstance(tree, tuple):
        return F.lit(bool(tree))
    feature, cut, low, high = tree
    return F.when(block[FEATURES[feature]] <= F.lit(cut), says(low, block)).otherwise(says(high, block))


def _is_other(name, rest, in_main):
    """Whether an opening tag begins an element with other matter than the article."""
    if name in OTHER or (name == "header" and not in_main):
        return True
    if name in ("html", "body", "main") or "=" not in rest and "hidden" not in rest:
        return False
    for key, *values, alone in ATTRIBUTE.findall(rest):
        value = next(filter(None, values), "")
        key = (key or alone).lower()
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
        if key == "role" and value.strip().lower() in OTHER_ROLES:
            return True
        if key in ("class", "id"):
            said = ["", *map(str.lower, SPLIT.split(value))]
            said = {word for before, word in zip(said, said[1:]) if before not in NOT_ITSELF}
            if said & OTHER_WORDS or not in_main and said & HEAD_WORDS or any(w.startswith(OTHER_STEMS) for w in said):
                return True
    return False


def blocks_of(html):
    """Flat blocks of a page in order: [(text, words, words in links, in the article, in other matter)]."""
    blocks, text, linked = [], [], []
    stack, opened, main, other, anchors = [], Counter(), 0, 0, 0

    def flush():
        joined = " ".join("".join(text).split())
        if joined:
            size = joined.count(" ") + 1
            blocks.append((joined, size, min(size, len("".join(linked).split())), int(main > 0), int(other > 0)))
        text.clear()
        linked.clear()

    def pop():
        nonlocal main, other
        name, was_main, was_other = stack.pop()
        opened[name] -= 1
        main -= was_main
        other -= was_other
        return name

    def say(piece):
        piece = unescape(piece) if "&" in piece else piece
        text.append(piece)
        linked.append(piece if anchors else " ")

    at, last = 0, html.rfind(">")
    while True:
        found = MARKUP.search(html, at) if at <= last else html.find("<!--", at) >= 0 and MARKUP.search(html, at)
        if not found:
            # A tag that never ends is dropped with what follows it.
            begun = re.compile(r"<[/!?]?[a-zA-Z]").search(html, at)
            say(html[at:begun.start() if begun else None])
            break
        if found.start() > at:
            say(html[at:found.start()])
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if found["end"]:
            if name == "a":
                anchors = 0
            elif name in INLINE:
                pass
            elif name in ("p", "br"):
                flush()
            else:
                flush()
                if opened[name]:
                    while pop() != name:
                        pass
            continue
        if name in RAW:
            if name not in ("svg", "math", "script", "style"):
                flush()
            if not found["rest"].endswith("/>") or name not in ("svg", "math"):
                end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(html, at)
                at = end.end() if end else len(html)
            continue
        if name == "a":
            anchors = 1
        elif name == "br":
            text.append(" ")
            linked.append(" ")
        elif name in INLINE or name in ("img", "input"):
            pass
        else:
            flush()
            anchors = 0
            if name in CLOSES:
                while stack and stack[-1][0] in CLOSES[name]:
                    pop()
            if name not in VOID and name != "p":
                is_main = int(name in MAIN)
                is_other = int(_is_other(name, found["rest"], main > 0))
                stack.append((name, is_main, is_other))
                opened[name] += 1
                main += is_main
                other += is_other
    flush()
    return blocks


def with_neighbours(blocks):
    """The blocks as (text, features in the order of FEATURES)."""
    sizes = [(0, 0.0), *((b[1], b[2] / b[1]) for b in blocks), (0, 0.0)]
    return [
        (b[0], float(here[0]), here[1], float(before[0]), before[1], float(after[0]), after[1], float(b[3]), float(b[4]))
        for b, before, here, after in zip(blocks, sizes, sizes[1:], sizes[2:])]


BLOCKS = f"array<struct<text:string,{','.join(f'{name}:double' for name in FEATURES)}>>"


def page_blocks(pages: DataFrame, page_id="page_id", url="url", html="html") -> DataFrame:
    """(page_id, url, blocks): the flat blocks of each page with their features."""
    pages = pages.select(pages[page_id].alias("page_id"), pages[url].alias("url"), pages[html].alias("text"))
    kind = pa.list_(pa.struct([("text", pa.string()), *((name, pa.float64()) for name in FEATURES)]))

    def cut(batches):
        for batch in batches:
            for part in slices(batch):
                found = [
                    [dict(zip(("text", *FEATURES), block)) for block in with_neighbours(blocks_of(html or ""))]
                    for html in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(found, kind)], ["page_id", "url", "blocks"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return pages.mapInArrow(cut, f"page_id {kinds['page_id']}, url {kinds['url']}, blocks {BLOCKS}")


def main_text(pages: DataFrame, rows=None, page_id="page_id", url="url", html="html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars. ``rows``: labelled blocks to train on."""
    tree = grow(rows or labelled())
    kept = F.filter("blocks", lambda block: says(tree, block))
    text = F.array_join(F.transform(kept, lambda block: block["text"]), " ")
    return page_blocks(pages, page_id, url, html).select(
        "page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
