"""Main texts against what the pages were made from, and the inference of wrappers."""

import html
import random
import re

import pytest
from pyspark.sql import functions as F

from panelloom.llm import html_extract
from panelloom.llm.html_extract import Item, Page, aligned, flat, folded, nested, written

FOLDER = "/root/testdata/sf0.001"


def items(names):
    return [Item(n) for n in names]


def expression(*pages):
    whole = folded(items(pages[0].split()))
    for page in pages[1:]:
        whole = aligned(whole, folded(items(page.split())))
    return written(whole).strip()


@pytest.mark.parametrize("pages, wrapper", [
    (["h p p p", "h p"], "h p+"),
    (["h p", "h x p"], "h x? p"),
    (["dt dd dt dd dt dd"], "( dt? dd? )+"),
    (["p ul p", "p"], "( p? ul? )+"),
    (["a b", "b a"], "( a? b? )+"),
    (["h p q", "h q", "h p p"], "h p* q?"),
    (["a b a c d", "c d d"], "( a? b? )+ c d+"),
])
def test_mismatches_become_groups_and_options(pages, wrapper):
    assert expression(*pages) == wrapper


def test_texts_become_slots_and_survive_writing():
    pages = [Page(f"<div>Fixed<p>text {i}</p></div><div class=x{i}>same</div>").items[0].body for i in range(5)]
    whole = pages[0]
    for page in pages[1:]:
        whole = aligned(whole, page)
    assert written(whole).strip() == 'div { " p { # } } div.x0 { " }'
    assert flat(nested(*flat(whole))) == flat(whole)


def texts(spark, pages, **kinds):
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    return {r.page_id: r.text for r in html_extract.extract(frame).collect()}


def test_given_pages(spark):
    given = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    found = {r.page_id: r for r in html_extract.op12_html_extraction(spark, FOLDER).collect()}
    assert len(found) == len(given)
    for row in given:
        article = re.search(r"<article>(.*)</article>", row.html, re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        text = "\n".join(b for b in blocks if b)
        assert found[row.page_id].text == text and found[row.page_id].n_chars == len(text) and found[row.page_id].url == row.url


def test_boilerplate_by_meaning(spark):
    page = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
<nav><p>Menu</p></nav><div class="cookie-notice"><p>We use cookies</p></div><div id=wrap class="modal"><main><article class="post ad-free"><header><h2>A &amp; B</h2></header>
<p>One <b>two</b>&nbsp;three<br>four<p>Fi<i>ve</i> &lt;6&gt; &#233;&eacute<script>if (a > "</p>") b()</script></p><aside>Related</aside><div class="ad">Buy</div>
<ul><li>item 1<li>item 2</ul><form><p>Your mail</p></form><table><tr><td>a<td>b</table><p title='a > b' data-x="it's">Last</p>
<section id="comments"><h3>Comments</h3><article class="comment"><p>Nice!</p></article></section></article></main></div>
<div class="sidebar">Side</div><!-- <p>no</p> --><footer>Foot"""
    expected = "A & B\nOne two three four\nFive <6> éé\nitem 1\nitem 2\na\nb\nLast"
    found = texts(spark, [(1, "http://a.example/1", page), (2, None, page), (3, "nothing", ""), (4, "nothing", None), (None, "http://a.example/1", "plain text"),
                          (6, "http://B.example", "<p>x" * 3 + "</div></article>"), (7, "http://b.example/", "<div>" * 3000 + "deep" + "</div>" * 2000 + "<p>tail"),
                          (8, "http://b.example/", "<p>" + "word " * 200_000), (9, "http://c.example", "a < b and <3 & c")])
    assert found[1] == found[2] == expected
    assert found[3] == found[4] == "" and found[None] == "plain text" and found[6] == "x\nx\nx"
    assert found[7] == "deep\ntail" and len(found[8]) == 999_999 and found[9] == "a < b and <3 & c"


def test_wrapper_finds_what_no_name_tells(spark):
    """Elements without names: what all pages of a host share is left out, also equal articles stay whole."""
    random.seed(5)
    def prose():
        return " ".join(random.choices("lorem ipsum dolor sit amet".split(), k=40))

    pages, expected = [], {}
    for i in range(12):
        paragraphs = [prose() for _ in range(1 + i % 4)]
        paragraphs[0] = paragraphs[0] if i else "Same"
        note = "<div>Breaking now</div>" if i % 3 == 0 else ""
        body = "".join(f"<p>{p}</p>" for p in paragraphs)
        pages.append((i, "http://plain.example/x", f"<body><div>Our site</div>{note}<div><div><h1>Title</h1>{body}</div><div>Printed on paper</div></div></body>"))
        expected[i] = "\n".join(["Title", *paragraphs])
    copies = [(100 + i, "http://copies.example/", "<body><div>All of it</div><p>equal</p></body>") for i in range(6)]
    found = texts(spark, pages + copies)
    assert {i: found[i] for i in expected} == expected
    assert all(found[100 + i] == "All of it\nequal" for i in range(6))


def test_wrappers_do_not_depend_on_partitions(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").withColumn("host", F.substring_index("url", "/", 3))
    odd = pages.withColumn("html", F.expr("concat(repeat('<div class=a><ul><li>x</ul>', page_id % 4), repeat('<p>y</p>', page_id % 3), html)"))
    one, many = (sorted(html_extract.wrappers(f).collect()) for f in (odd.coalesce(1), odd.repartition(9)))
    assert one == many and len(one) > 5


def test_empty_table_and_clashing_names(spark):
    schema = "page_id long, url string, html string, host string, main string, `_html` int, fixed string, text string"
    assert html_extract.extract(spark.createDataFrame([], schema)).collect() == []
    row = html_extract.extract(spark.createDataFrame([(1, "u", "<p>x", "h", "m", 1, "f", "t")], schema)).first()
    assert (row.page_id, row.url, row.text, row.n_chars) == (1, "u", "x", 1)
