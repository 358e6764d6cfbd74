from __future__ import annotations

import html
import re
import time

import pytest

from skyledger.llm.html_text import main_text, main_texts

LONG = "This sentence is long enough, with a comma, to count as a paragraph of prose."
PAGE = f"""<!doctype html><html><head><title>T &amp; t</title><style>p{{}}</style></head>
<body class="no-sidebar"><header><h1>Site name, of a site</h1></header>
<nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav>
<div class="cookie-notice">We use cookies, as all do, for reasons that nobody reads at all.</div>
<div id=page><div class="post"><h2>Title</h2><p>{LONG}<p>Second &lt;b&gt; &eacute;&#233;&#x41;, {LONG}
<ul><li>first point<li>second point</ul><blockquote>Quoted,   and
more</blockquote><script>if (a < b) document.write("<p>no</p>")</script>
<div class="ad">Buy this, buy that, buy all of it, buy it today and again.</div></div>
<div class="sidebar"><p>{LONG} {LONG} {LONG} {LONG} {LONG}</p></div></div>
<section id="comments"><p>{LONG}</p><p>{LONG} {LONG} {LONG}</p></section>
<form><p>{LONG}</p><input name=q></form><footer><p>{LONG}</p></footer></body></html>"""


def test_a_page_without_an_article_element():
    want = (
        f"Title {LONG} Second <b> ééA, {LONG} first point second point Quoted, and more"
    )
    assert main_text(PAGE) == want


@pytest.mark.parametrize(
    "page, want",
    [
        ("", ""),
        ("just text,\n no   markup", "just text, no markup"),
        ("<nav><a href=x>menu</a></nav>", ""),
        ("<script>never closed <p>text", ""),
        ("<p>a<br>b<i>c</i> d</p>", "a bc d"),
        ("<article><p><b>one<br><p>two</p></article>", "one two"),
        ("<!-- <p>no</p> --><p>yes 1 < 2 &copy &ampx</p><p cla", "yes 1 < 2 © &x"),
        ("<p title='a > b'>kept</p>", "kept"),
        ("<p title='open>kept", "kept"),
        ("<div hidden><p>secret</p></div><p>shown</p>", "shown"),
        ("<article><header><h1>Head</h1></header><p>Body.</p></article>", "Head Body."),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
        ("<ul><li><a href=1>one</a><li><a href=2>two</a></ul><p>text</p>", "text"),
        ("<p>x &nbsp; y</p>", "x y"),
    ],
)
def test_cases(page, want):
    assert main_text(page) == want


def test_siblings_of_the_best_container_are_kept():
    page = f"<div><p>{LONG}</p>" * 1 + f"</div><div><p>{LONG}</p><p>{LONG}</p></div>"
    page = f"<body>{page}<p>Prose beside it ends here.</p><p>Not prose</p></body>"
    assert main_text(page).endswith("ends here.")


def test_deep_and_long_pages():
    assert main_text("<div>" * 20_000 + "deep text") == "deep text"
    long = ", ".join(["word"] * 200_000)
    assert main_text(f"<p>{long}</p>") == long


def reference(page):
    """The article of a test page by cutting it out."""
    found = re.search(r"<article>(.*?)(</article>|$)", page, re.S)
    inner = re.sub(r"<br>|</?(p|h1)>", " ", found[1]) if found else ""
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", inner)).split())


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: reference(r.html or "") for r in pages.collect()}
    got = main_texts(pages).collect()
    assert {r.page_id: r.text for r in got} == want and len(got) == len(want)
    assert all(r.n_chars == len(r.text) for r in got)


def test_edge_rows(spark):
    rows = [(1, "u", None, "x"), (1, "u", None, "x"), (None, None, "", "y"), (2, "v", "t", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(main_texts(pages).collect(), key=repr)
    assert [r.text for r in got].count("") == 3 and len(got) == 4
    assert main_texts(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "part", ["<ul><li>x", "<table><tr><td>x", "<b>x<hr>", "<p>x<div>", "<i>x</b>", "<td><p>x<div>"]
)
def test_deep_pages_take_linear_time(part):
    start = time.process_time()
    found = main_text("<p><table><tr><td>" + part * 20_000)
    assert time.process_time() - start < 2
    assert set(found) <= {"x", " "}
    whole = main_text(f"<body><div><p>{'A sentence, with commas, in it. ' * 20}</p></div>" + part * 50)
    assert whole.startswith("A sentence, with commas")
