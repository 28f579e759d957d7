"""Main text of pages: given pages against a plain reading, templates of made hosts, odd markup."""

import html
import json
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ratesheet.llm import html_extraction
from ratesheet.llm.html_extraction import main_blocks
from ratesheet.llm.page_tokens import read
from ratesheet.llm.queries import QUERIES

SCHEMA = "page_id bigint, url string, html string"


def plain(source: str) -> str:
    """The given pages hold one article of headings and paragraphs."""
    article = re.search(r"<article>(.*)</article>", source, re.S)[1].replace("<br>", " ")
    blocks = [html.unescape(re.sub("<[^>]*>", "", b)) for b in re.split("</?(?:p|h1)>", article)]
    return "\n".join(" ".join(b.split()) for b in blocks if b.strip())


def texts(df) -> dict:
    return {r.page_id: r.text for r in html_extraction.extracted(df).collect()}


def test_given_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    found = {r.page_id: r for r in QUERIES["op13_html_extraction"](spark, sf_dir).collect()}
    assert len(found) == len(pages)
    for page in pages:
        r = found[page.page_id]
        assert (r.url, r.text, r.n_chars) == (page.url, plain(page.html), len(plain(page.html)))


def soup(k: int) -> str:
    """A page without article or main: only the template and the names tell its parts."""
    body = "".join(f"<p>Story {k} part {j} tells of number {k * 7 + j}.</p>" for j in range(2 + k % 3))
    replies = "".join(f"<div class='comment'><p>Reader {k * j} says hi</p></div>" for j in range(k % 4))
    return f"""<html><head><title>T{k}</title><style>p {{}}</style></head><body>
      <div class=top><b>The Daily Fixture</b><span> since 1900</span></div>
      <div class="links"><a href=/a>Home</a><a href=/b>World</a><a href=/{k}>Today {k}</a></div>
      <div id="cookie-note"><p>We keep cookies {k}</p></div>
      <div class="c{7}"><h1>Headline {k}</h1>{body}<div class=hint><p>Print this page</p></div></div>
      <div class="sidebar"><p>Also {k}</p></div><form><input name=q>Search {k}<button>Go</button></form>
      <div id=comments>{replies}</div><div class=low><p>All the news</p><p>Fixture Press</p></div></body></html>"""


def soup_text(k: int) -> str:
    parts = [f"Story {k} part {j} tells of number {k * 7 + j}." for j in range(2 + k % 3)]
    return "\n".join([f"Headline {k}", *parts])


def test_template_of_a_host(spark):
    rows = [(k, f"http://User@News.Example.org:80/{k}", soup(k)) for k in range(1, 13)]
    found = texts(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert found == {k: soup_text(k) for k in range(1, 13)}
    told = json.loads(html_extraction.templates(spark.createDataFrame(rows, SCHEMA)).first().template)
    assert not told["classes"][0][0] and len(told["texts"]) >= 4 and not told["main"]


def test_hosts_do_not_mix(spark):
    """Two pages are too few for a template; another host's does not apply to them."""
    rows = [(k, "http://a.example/", soup(k)) for k in range(1, 9)]
    rows += [(k, "http://b.example/", soup(k)) for k in (20, 21)]
    found = texts(spark.createDataFrame(rows, SCHEMA))
    assert found[3] == soup_text(3)
    assert "Fixture Press" in found[20] and soup_text(20) in found[20]


def test_a_page_that_breaks_the_order_is_read_by_itself(spark):
    rows = [(k, "http://a.example/", soup(k)) for k in range(1, 9)]
    odd = "<body><article><h1>Other</h1><p>Own words</p></article><div class=top>The Daily Fixture</div></body>"
    found = texts(spark.createDataFrame([*rows, (99, "http://a.example/x", odd)], SCHEMA))
    assert found[99] == "Other\nOwn words" and found[5] == soup_text(5)


def test_classes_are_those_of_equal_vectors(spark):
    """The two sums stand for the vector of counts a page."""
    rows = [(k, "http://a.example/", soup(k)) for k in range(1, 10)]
    vectors = defaultdict(Counter)
    for k, (_, _, source) in enumerate(rows):
        for _, role, _, _ in read(source).tokens:
            vectors[role][k] += 1
    sums = html_extraction.token_statistics(spark.createDataFrame(rows, SCHEMA).repartition(5)).where("kind <> 'h'")
    by_sum, by_vector = defaultdict(set), defaultdict(set)
    for r in sums.collect():
        by_sum[r.pages, r.total, r.lo, r.hi].add(r.role)
        by_vector[tuple(sorted(vectors[r.role].items()))].add(r.role)
    assert sorted(map(sorted, by_sum.values())) == sorted(map(sorted, by_vector.values()))
    assert sum(map(len, by_sum.values())) == len(vectors)


def test_copies_on_a_host_keep_their_article(spark):
    body = "<article><h1>Same</h1><p>Equal words on most pages</p></article><footer>f</footer>"
    rows = [(k, "http://a.example/", body if k < 8 else body.replace("Same", f"Other {k}")) for k in range(10)]
    found = texts(spark.createDataFrame(rows, SCHEMA))
    assert found[0] == "Same\nEqual words on most pages" and found[9] == "Other 9\nEqual words on most pages"


ODD = {
    "<ARTICLE><P>One<P>Two <I>three</I>four</ARTICLE>": ["One", "Two threefour"],
    "<article>a &amp; b &lt;c&gt; &#233;&nbsp;d &eacute;</article>": ["a & b <c> é d é"],
    "<article><p title='x > y' class=a>in</p><!-- <p>no</p> --><p>on<br>and</p></article>": ["in", "on and"],
    "<article><script>var a='</p><p>no';</script><p>yes</p><style>p{}</style></article>": ["yes"],
    "<article><p>it's 1 < 2 and 3 > 2</p><p title=don't>ok</p>": ["it's 1 < 2 and 3 > 2", "ok"],
    "<nav><ul><li>m<li>n</ul></nav><main><h1>t</h1><aside>s</aside><p>p</p></main>": ["t", "p"],
    "<main><article><header><h1>h</h1></header><p>p</p></article><p>outside</p></main>": ["h", "p"],
    "<article><p>a</p><section class='comments'><p>no</p></section><div class=ad>no</div></article>": ["a"],
    "<article><ul><li>one<li>two <b>x</b></ul><table><tr><td>1<td>2</table></article>": ["one", "two x", "1", "2"],
    "<body><form action=x><article><p>inside a form</p></article></form></body>": ["inside a form"],
    "<article class='post has-sidebar'><p>kept</p></article><article class=comment><p>no</p></article>": ["kept"],
    "<body><div class=menu>m</div><p>plain text</p><footer>f</footer>": ["plain text"],
    "<article><p>broken off <a href='x": ["broken off"],
    "<article><p>never closed <!-- and so on": ["never closed"],
    "<article><p hidden>no</p><p style='display: none'>no</p><p>yes</p></article>": ["yes"],
    "<article><p>a\n  b\t c&#8203;d</p></article>": ["a b c​d"],
    "no markup at all": ["no markup at all"],
    "<article></article><footer>x</footer>": [],
    "</p></div></article>": [],
    "<": ["<"],
    "<title>broken off": [],
}


@pytest.mark.parametrize("source", ODD)
def test_odd_markup(source):
    assert main_blocks(source) == ODD[source]


def test_nulls_copies_long_pages_and_extra_columns(spark):
    long = "<article>" + "".join(f"<p>w{k} é</p>" for k in range(60_000)) + "</article>"
    rows = [(1, None, "<article>x</article>"), (2, "nonsense", None), (3, "http://a/", ""), (None, None, None),
            (2**60, "http://a/", "<article>y</article>"), (2**60, "http://a/", "<article>y</article>"),
            (4, "http://a/", long), (5, "http://a/", "<p>" * 3000 + "deep" + "<div>" * 3000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit(1) for c in ("host", "template", "role", "kind", "text", "n_chars", "a.b")}
    )
    found = html_extraction.extracted(df.repartition(3)).collect()
    assert len(found) == len(rows) and [r.text for r in found].count("y") == 2
    by_id = {r.page_id: r for r in found}
    assert (by_id[1].text, by_id[2].text, by_id[3].text, by_id[None].text) == ("x", "", "", "")
    assert by_id[4].n_chars == len(by_id[4].text) and by_id[4].text.count("\n") == 59_999
    assert by_id[5].text == "deep" and by_id[2**60].url == "http://a/"


def test_empty_table(spark):
    assert html_extraction.extracted(spark.createDataFrame([], SCHEMA)).collect() == []


def test_large_templates_are_joined(spark, monkeypatch):
    rows = [(k, f"http://h{k % 3}.example/", soup(k)) for k in range(1, 28)]
    monkeypatch.setattr(html_extraction, "BROADCAST_BYTES", 0)
    assert texts(spark.createDataFrame(rows, SCHEMA)) == {k: soup_text(k) for k in range(1, 28)}
