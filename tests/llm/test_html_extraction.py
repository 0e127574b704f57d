from __future__ import annotations

import re
import time
from collections import Counter
from html import unescape

import pytest
from compare import duckdb_over
from pyspark.sql import functions as F

from tidewatch.llm.html_extraction import (
    MIN_PAGES,
    extract,
    host_of,
    main_text,
    site_templates,
    subtree_hashes,
)
from tidewatch.llm.queries import QUERIES

FRAME = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head>"
    "<body><header>Site</header><nav><ul><li><a href=/x>X</a></ul></nav><div class='ad'>Buy</div>"
    "{body}<aside>Side</aside><form><input> Search</form>"
    "<div id=comments><p>Nice!</div><footer>&copy; Site</footer></body></html>"
)


@pytest.mark.parametrize(
    ("body", "text"),
    [
        ("<article><h1>Head</h1><p>One <b>two</b>.<p>Three&amp;four</article>", "Head One two. Three&four"),
        ("<main><p>a\n\n b<br>c</p><ul><li>x<li>y</ul></main>", "a b c x y"),
        ("<article><p>open <b>bold<p>next</article>", "open bold next"),
        ("<article><header><h1>Kept</h1></header><p>x</p></article>", "Kept x"),
        ("<div><p>No article here.</p></div>", "No article here."),
        ("<article><p>in</p><div class='share-buttons'>Share</div><!-- no --><p>out", "in out"),
        ("<article><p>&lt;tag&gt; &eacute; &#x1F600; a&nbsp;b</article>", "<tag> é \U0001f600 a b"),
        ("<article><p title='a>b'>x</p></article>", "x"),
        ("", ""),
    ],
)
def test_marked_boilerplate_goes(body, text):
    assert main_text(FRAME.format(body=body)) == text


def test_odd_pages():
    assert main_text(None) == ""
    assert main_text("just text") == "just text"
    assert main_text("<script>never closed <p>text") == ""
    assert main_text("<div>" * 50_000 + "deep") == "deep"
    assert main_text("<article>" + "<p>word " * 20_000).count("word") == 20_000


def pages_of(spark):
    """A host with an unmarked template on every page, and a passage many of its articles share."""
    rows = []
    for i in range(30):
        body = (
            f"<div><div><b>Menu of the house</b> with words</div><p>Own story number {i}.</p>"
            f"<div>Do not miss <i>our</i> letter</div></div><p>Passage shared by all.</p>"
        )
        if i % 2:
            body = f"<article><p>Story {i}</p><p>Passage shared by all.</p></article><div>Do not miss <i>our</i> letter</div>"
        rows.append((i, f"https://host.example/{i}", f"<html><body>{body}</body></html>", "x"))
    small = "<html><body><div>Menu of the house</div><p>Lonely page.</p></body></html>"
    rows += [(100, "http://other.example:80/a", small, "y"), (101, None, None, "z"), (102, "", "", None)]
    rows += [(200 + i, "http://copies.example/", "<body><div>Same page, again and again</div></body>", "") for i in range(20)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, template string")


def test_template_of_a_host_goes_where_it_recurs(spark):
    pages = pages_of(spark)
    found = {r["page_id"]: r["main_text"] for r in extract(pages).collect()}
    assert len(found) == pages.count()
    assert found[0] == "Own story number 0."
    assert found[1] == "Story 1 Passage shared by all."  # in an article, passages stay
    assert found[100] == "Menu of the house Lonely page."  # other hosts have no such template
    assert found[101] == found[102] == ""
    assert found[200] == "Same page, again and again"  # copies of one page are one page
    assert site_templates(pages).count() == 30  # the pages of host.example alone
    assert extract(pages.limit(0)).count() == 0
    assert extract(pages).columns == [*pages.columns, "main_text"]


@pytest.mark.parametrize(("with_block", "n_pages"), [(4, 100), (5, 100), (9, 100), (90, 1000)])
def test_a_block_on_enough_pages_goes_however_many_pages_the_host_has(spark, with_block, n_pages):
    def html(i):
        block = "<div>A block without marks</div>" if i < with_block else ""
        return f"<body>{block}<div><p>Own story number {i}.</p></div></body>"

    rows = [(i, f"http://big.example/{i}", html(i)) for i in range(n_pages)]
    found = extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(found) == n_pages
    kept = {r["page_id"] for r in found if "without marks" in r["main_text"]}
    assert kept == (set(range(with_block)) if with_block < 5 else set())
    assert all(r["main_text"].endswith(f"Own story number {r['page_id']}.") for r in found)


def test_counts_equal_those_of_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    counts, own = Counter(), {}
    hosts = pages.select("page_id", host_of(F.col("url")).alias("host"), "html").collect()
    for host, html in {(r["host"], r["html"]) for r in hosts}:
        counts.update((host, key) for key in subtree_hashes(html)[0])
        own[host, html] = subtree_hashes(html)[1]
    plain = {key: {k for k in keys if counts[key[0], k] >= MIN_PAGES} for key, keys in own.items()}
    expected = {r["page_id"]: main_text(r["html"], frozenset(plain[r["host"], r["html"]])) for r in hosts}
    assert {r["page_id"]: r["main_text"] for r in extract(pages).collect()} == expected
    found = sorted(sorted(r["template"]) for r in site_templates(pages).collect())
    assert found == sorted(sorted(keys) for keys in plain.values() if keys)


def test_host(spark):
    urls = ["HTTPS://U:p@Host.example:8/x", "//a.b/c", "nonsense", None, "http://h?q"]
    frame = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in frame.select(host_of(F.col("u"))).collect()] == ["host.example", "a.b", "", "", "h"]


def test_query_gives_the_article_of_every_page(spark):
    sf_dir = "/root/testdata/sf0.001"
    found = {r["page_id"]: r for r in QUERIES["op1_html_extraction"](spark, sf_dir).collect()}
    pages = duckdb_over(sf_dir).execute("SELECT page_id, html FROM pages").fetchall()
    assert len(found) == len(pages)
    for page_id, html in pages:
        article = re.search(r"<article>(.*?)</article>", html, re.DOTALL)[1]
        plain = re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", article))
        text = " ".join(unescape(plain).split())
        assert found[page_id]["text"] == text and found[page_id]["n_chars"] == len(text)


def test_many_open_and_stray_tags_and_attributes_are_read_in_proportion():
    start = time.perf_counter()
    assert main_text("<p>x</p>" + "<b>" * 20_000 + "</i>" * 20_000 + "hello") == "x hello"
    assert time.perf_counter() - start < 10
    many = " ".join(f'a{i}="x > y"' for i in range(600))
    assert main_text(f"<div {many}>text</div>") == "text"
