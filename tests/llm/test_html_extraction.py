"""Main texts: parts of a page that its markup names, and those that only its site tells."""

import html as entities
import re

import pyarrow.parquet as pq
import pytest

from tapemill.llm import html_extraction, queries
from tapemill.llm.html_extraction import article_text

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string, host string, site string, hash string, k1 string, text string"


def articles_own_words(page):
    """What stands in the article element of the test tables' pages, which hold no other markup there."""
    inner = re.search(r"<article>(.*)</article>", page, re.S).group(1)
    inner = re.sub(r"</?(p|h1|br|ul|li|div)\b[^>]*>", " ", inner)
    return " ".join(entities.unescape(re.sub(r"</?[bi]>", "", inner)).split())


def test_query_on_the_whole_table(spark):
    pages = pq.read_table(f"{SF}/pages.parquet").to_pylist()
    rows = queries.QUERIES["op13_main_text"](spark, SF).collect()
    assert {r["page_id"]: r["text"] for r in rows} == {p["page_id"]: articles_own_words(p["html"]) for p in pages}
    assert all(r["n_chars"] == len(r["text"]) for r in rows) and len(rows) == len(pages)


@pytest.mark.parametrize(
    "page, text",
    [
        ("<p>one<br>two <b>th</b>ree &amp; &eacute;&#x41;&nbsp;x</p>", "one two three & éA x"),
        ("<nav>menu</nav><article><h1>T</h1><p>a<p>b</article><footer>f</footer>", "T a b"),
        ("<body><header><h1>Site</h1></header><div id=main-content><p>a</p></div><aside>s</aside>", "a"),
        ("<article><header><h1>T</h1></header><p>a</p><footer>tags</footer></article>", "T a"),
        ('<article><p>a</p><div class="ad-slot">buy</div><p>b</p></article>', "a b"),
        ('<div class="post"><p>a</p></div><section id="comments"><article class="comment"><p>nice</p></article></section>', "a"),
        ('<div class="content with-sidebar"><p>a</p><div class="sidebar">s</div></div>', "a"),
        ('<div class="cookieNotice">ok?</div><main><p>a</p><form><input><label>mail</label></form></main>', "a"),
        ('<form action="/"><article><p>a</p></article><input type=hidden></form>', "a"),
        ('<script>var t="</p><p>no";</script><style>p{}</style><p>a</p><noscript>no</noscript>', "a"),
        ("<p>2 < 3 and a<b c", "2 < 3 and a"),
        ("<!-- <p>no</p> --><p title='a>b' x=\"'>\">yes</p>", "yes"),
        ("<ul><li><a href=/a>A</a></li><li><a href=/b>B</a></li></ul><p>text <a href=/c>c</a> goes on</p>", "text c goes on"),
        ("<article><ul><li>one<li>two</ul><table><tr><td>1<td>2</table></article>", "one two 1 2"),
        ("<main><h1>T</h1><article><p>a</p></article></main>", "T a"),
        ('<article class="teaser"><p>t</p></article><article><h1>T</h1>a</article><article><h2>o</h2>b</article>', "T a"),
        ("<P>A</P></div></p><DIV>b</DIV>", "A b"),
        ("<b>x<p>y</b>z</p>", "x yz"),
        ("", ""), (None, ""), ("plain", "plain"), ("<script>a", ""), ("<article>", ""),
    ],
)
def test_markup(page, text):
    assert article_text(page, {}) == text


def test_deep_and_broken_pages():
    assert article_text("<div>" * 50_000 + "x", {}) == "x"
    assert article_text("<a " * 100_000, {}) == ""
    assert article_text('<a b="' * 50_000 + ">x", {}) == "x"
    long = "word " * 200_000
    assert article_text(f"<article><p>{long}</p></article>", {}) == long.strip()


def site(host, n, banner="<div>Join our club today</div>", copies=0):
    pages = []
    for k in range(n):
        words = f"story {host} {k} " * (3 + k % 4)
        pages.append(f"<div><a href=/>Home</a> and more</div>{banner}<article><h1>T{k}</h1><p>{words}</p>{banner}<p>By {host}.</p></article><div>The end of it</div>")
    pages += [pages[0]] * copies
    return [(f"https://U@{host.upper()}.example.org:8{k}/x{k}", page) for k, page in enumerate(pages)]


def table(spark, pages):
    return spark.createDataFrame([(k, u, h, *["x"] * 5) for k, (u, h) in enumerate(pages)], SCHEMA)


@pytest.mark.parametrize("limit", [0, html_extraction.BROADCAST_TEMPLATES])
def test_templates_of_a_site_go(spark, limit):
    """Parts without a telling name go where many articles of the host have them; both ways of lookup agree."""
    pages = [*site("a", 6), *site("b", 2), ("no address", "<div>Join our club today</div>x"), (None, None), ("http://c/", "")]
    rows = {r["page_id"]: r["text"] for r in html_extraction.main_texts(table(spark, pages), limit).collect()}
    assert [rows[k] for k in range(6)] == [f"T{k} " + " ".join([f"story a {k}"] * (3 + k % 4)) for k in range(6)]
    # Two pages are not many, and on another host the same words may be an article's own.
    assert rows[6].startswith("T0 story b 0") and rows[6].endswith("Join our club today By b.")
    assert rows[8] == "Join our club today x" and rows[9] == rows[10] == ""


@pytest.mark.parametrize("limit", [0, html_extraction.BROADCAST_TEMPLATES])
def test_copies_of_an_article_are_no_template(spark, limit):
    """One page a hundred times over, and near copies that differ in a title, keep their words."""
    pages = site("a", 1, banner="", copies=100)
    near = [("https://n.example.org/", f"<article><h1>Title {k}</h1><p>{'the same long text ' * 9}</p><p>Short end.</p></article>") for k in range(30)]
    rows = {r["page_id"]: r["text"] for r in html_extraction.main_texts(table(spark, pages + near), limit).collect()}
    assert len({rows[k] for k in range(101)}) == 1 and rows[0].endswith("By a.")
    assert all(rows[101 + k] == f"Title {k} " + "the same long text " * 9 + "Short end." for k in range(30))


def test_a_passage_that_some_articles_share_stays(spark):
    pages = site("a", 30, banner="")
    shared = "<p>A passage that a third of the articles quote.</p>"
    pages = [(u, h.replace("<p>By", shared + "<p>By") if k % 3 == 0 else h) for k, (u, h) in enumerate(pages)]
    rows = {r["page_id"]: r["text"] for r in html_extraction.main_texts(table(spark, pages)).collect()}
    assert all(("articles quote" in rows[k]) == (k % 3 == 0) and "The end" not in rows[k] for k in range(30))


def test_no_pages(spark):
    assert html_extraction.main_texts(spark.createDataFrame([], SCHEMA)).collect() == []
