import html
import re
import time

import duckdb
import pytest

from kinmatch.llm import queries
from kinmatch.llm.html_main import Page, extract, style_tree

PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/x">menu</a></li></ul></nav><!-- ad --><div class="ad">buy</div>'
    "<article><header><h1>Head &amp; tail&amp;amp;</h1></header><p><b>One <i>t</i>wo<br>three\n  <p>Four&nbsp;x</p><div class='comments'><p>first!</p><article class=comment>second!</article></div><form><input><p>send</p></form></article><footer>&copy; h</footer></body></html>"
)


def main(page):
    return Page(page).main_text()


def test_article_text():
    assert main(PAGE) == "Head & tail&amp; One two three Four x"


def test_lenient_and_empty():
    assert main(None) == "" == main("")
    assert main("<p>a < b & c <p>d") == "a < b & c d"
    assert main("<div class=\"x>broken <p>text") in ("text", "broken text")
    assert main("<!-- never closed <p>x") == ""
    assert main("</div></p>x</b>y</p>z") == "xy z"
    assert main("<article>a<p>b") == "a b"
    assert main("<b>" * 5000 + "deep") == "deep"


@pytest.mark.parametrize(
    "page",
    (
        '<body class="has-sidebar"><p>Real text here</p></body>',
        '<article class="post comments-open"><p>Real text here</p></article>',
        '<body class="sidebar"><p>Real text here</p></body>',
        '<div class="layout sidebar"><nav>x</nav><article><p>Real text here</p></article></div>',
        '<div class="widget"><p>Real text here</p></div>',
        '<div class="page with-sidebar"><div class="sidebar">x</div><main class="menu-open">Real text here</main></div>',
        '<article>Real text here</article><div class="related"><article>Other</article></div>',
    ),
)
def test_class_words_do_not_empty_a_page(page):
    assert main(page) == "Real text here"


def test_marked_elements_go():
    for mark in ('div class="site-footer"', 'div id="side"', 'p class="cookie_notice"', 'section role="navigation"', "aside", "footer", "form"):
        tag = mark.split()[0]
        assert main(f"<body><{mark}>away</{tag}><p>text</p></body>") == "text"
        assert main(f"<article><{mark}>away</{tag}><p>text</p></article>") == "text"


def test_deep_markup_takes_linear_time():
    began = time.time()
    for tag, end in (("<div>", ""), ("<b>", "</i>"), ("<h1>", "</p>"), ("<section><p>", "</section></b>")):
        assert main(tag * 50_000 + "deep" + end * 50_000) == "deep"
    assert time.time() - began < 20


def site(n, at="http://h.example/{}", body="<body><div class=box>Subscribe to us</div><div class=text><p>text {i} of page</p><p>other {j}</p></div><div class=legal><p>All rights</p></div></body>", first=0):
    return [(first + i, at.format(i), body.format(i=i, j=i * 7)) for i in range(n)]


def texts(pages, **how):
    return sorted(((r["page_id"], r["text"]) for r in extract(pages, **how).collect()), key=str)


def test_the_tree_judges(spark):
    """Without the tree nothing tells boxes that repeat from text, outside of an article or in it."""
    article = "<body><article><p>text {i}</p><div class=box>Read our paper</div><p>more {j}</p></article></body>"
    rows = site(12) + site(6, "https://u@a.example:80/{}", article, 1000)
    rows += [(100, "nohost", "<body><div class=box>alone</div></body>"), (101, None, None), (102, "http://h.example/z", ""), rows[0], (None, "http://h.example/y", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS host", "1 AS low", "2 AS key", "'y' AS text")
    want = [*((i, f"text {i} of page other {i * 7}") for i in range(12)), *((1000 + i, f"text {i} more {i * 7}") for i in range(6)), (0, "text 0 of page other 0"), (100, "alone"), (101, ""), (102, ""), (None, "")]
    for limit in (20_000, 0):  # as a broadcast, and joined by path
        assert texts(pages, broadcast_rows=limit) == sorted(want, key=str)
    off = dict(texts(pages, min_pages=10**6))
    assert off[3] == "Subscribe to us text 3 of page other 21 All rights" and off[1003] == "text 3 Read our paper more 21"


def test_importance_is_of_pages(spark):
    tree = {r["path"]: r for r in style_tree(spark.createDataFrame(site(12) + site(3), "page_id long, url string, html string").selectExpr("'h' AS host", "html")).collect()}
    found = sorted((r["pages"], round(r["importance"], 6)) for r in tree.values())
    # body, div.text and its p vary in content alone; div.box and div.legal with its p in nothing
    assert found == [(12, 0.0)] * 3 + [(12, 0.9)] * 3


def test_what_repeats_on_one_page_or_in_copies_stays(spark):
    rows = [(1, "http://one.example", "<body>" + "<p>again</p>" * 4 + "</body>")]
    rows += [(10 + i, f"http://copies.example/{i}", f"<!-- {i} --><body><nav>{i}</nav><article><p>the same text</p></article></body>") for i in range(30)]
    rows += [(50 + i, f"http://plain.example/{i}", "<body><p>no such page</p></body>") for i in range(30)]
    got = dict(texts(spark.createDataFrame(rows, "page_id long, url string, html string")))
    assert got[1] == "again again again again"
    assert {got[10 + i] for i in range(30)} == {"the same text"} and {got[50 + i] for i in range(30)} == {"no such page"}


def test_nothing(spark):
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert extract(spark.createDataFrame([], "page_id long, url string, html string"), broadcast_rows=-1).count() == 0


def test_the_query_on_the_tables(spark):
    """The tables' pages wrap all that isn't the article in marked elements: a pattern can cut it."""
    sf, want = "/root/testdata/sf0.001", {}
    for page, text in duckdb.connect().execute(f"SELECT page_id, html FROM '{sf}/pages.parquet'").fetchall():
        body = re.search(r"<article>(.*)</article>", text, re.S)[1]
        want[page] = " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(p|h1|br|li|ul|div)\b[^>]*>", " ", body))).split())
    rows = queries.queries()["op10_html"](spark, sf).collect()
    assert {r["page_id"]: r["text"] for r in rows} == want and len(rows) == len(want) and all(r["n_chars"] == len(r["text"]) for r in rows)
