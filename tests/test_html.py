"""Page facts on small pages."""

from pyspark.sql import functions as F

from inkwell.functions import html, markup
from inkwell.operators import discovery, extraction

RICH = """<html><head><title>x | Daily FT</title><META content=" Bank&amp;Co  rises - Daily FT " property="og:title"><meta name='author' content=' '>
<meta property="article:published_time" content="later"><meta name="pubdate" content="2026-09-11T10:00:00Z"><meta name="description" content=" a  b ">
<script type="application/ld+json">{"@graph": [{"author": [{"name": "A"}, "B", 3], "headline": "jl", "url": "HTTPS://X.lk/a/?utm_source=1&b="}], "description": "dd"}</script>
<script type="application/ld+json">{bad</script><script>var a = "<a href='no'>";</script></head>
<body><nav><a href="/x">Nav</a></nav><div><a href="a/b-1">Head <b>line</b></a><span>Friday, 11 September 2026 05:54</span>
<p>This is a paragraph of more than forty characters, yes it is.</p></div></body></html>"""
LISTED = """<script type='application/ld+json'>[{"headline": 5, "author": {"name": " C "}}, {"headline": "From list", "datePublished": "2026-09-10", "mainEntityOfPage": {"@id": "http://m.lk/p/"}}]</script><h1>h</h1>"""
H1 = "<title>t</title><h1> One <i>two</i> &lt;3 </h1><link rel='canonical' href=' http://c.lk/z/?gclid=1 '><time datetime=''>12 September 2026</time>"
PLAIN = "<title> Only title — Ceylon Today</title><body>Published September 3, 2026 by us<p>x</p>"
PAGES = [("rich", RICH), ("listed", LISTED), ("h1", H1), ("plain", PLAIN), ("empty", ""), ("null", None)]


def test_facts(spark):
    d = spark.createDataFrame([(k, "http://f.lk/q/", h) for k, h in PAGES], "k string, url string, html string")
    got = {r["k"]: r for r in extraction.with_facts(d).collect()}
    pick = lambda c: [got[k][c] for k, _ in PAGES]
    assert pick("headline") == ["Bank&Co rises", "From list", "One two <3", "Only title", "", ""]
    assert pick("subheadline") == ["a b", None, None, None, None, None]
    assert pick("author") == ["A, B", "C", None, None, None, None]
    assert pick("published_at") == ["2026-09-11T15:30:00+05:30", "2026-09-10T00:00:00+05:30", "2026-09-12T00:00:00+05:30", "2026-09-03T00:00:00+05:30", None, None]
    assert pick("canonical_url") == ["https://x.lk/a?b=", "http://m.lk/p", "http://c.lk/z", "http://f.lk/q", "http://f.lk/q", "http://f.lk/q"]


def test_links_and_their_surroundings(spark):
    d = spark.createDataFrame([(RICH,), (None,)], "html string")
    dated, excerpted, carded = d.select(html.links_with_dates(F.col("html")), html.links_with_excerpts(F.col("html")), html.links_with_cards(F.col("html"))).first()
    assert [(a.href, a.text, a.date) for a in dated] == [("/x", "Nav", "Friday, 11 September 2026 05:54"), ("a/b-1", "Head line", "Friday, 11 September 2026 05:54")]
    assert [a.excerpt for a in excerpted] == ["This is a paragraph of more than forty characters, yes it is."] * 2
    assert [a.date for a in carded] == [None, None]


def test_main_text_leaves_navigation_out(spark):
    page = "<nav><p>menu</p></nav><article><h2>Part</h2><p>One <b>two</b>.<p>Three</p><ul><li>Four</li></ul></article><footer><p>end</p></footer><script>p()</script>"
    assert spark.createDataFrame([(page,), (None,), ("",)], "html string").select(html.article_text(F.col("html"))).collect()[0][0] == "Part\n\nOne two .\n\nThree\n\nFour"


def test_whole_records(spark):
    d = spark.createDataFrame([("http://f.lk/q/", "http://f.lk/q/", RICH)], "url string, final_url string, html string")
    r = extraction.extract_articles(d, "S", "T", "2026-09-14T00:00:00+00:00").first()
    assert (r.word_count, r.fetch_method, r.source_name, len(r.content_hash)) == (12, "httpx", "S", 64)


def test_classifier(spark):
    found = {
        "https://a.lk/x/y": True, "https://a.lk/x": False, "https://a.lk/": False, "https://b.lk/x/y": False, "https://a.lk/tag/y": False, "https://a.lk/x/y.PDF": False,
        "https://a.lk/news/": False, "https://a.lk/biz": True, "https://a.lk/columns/4": True,
    }
    d = spark.createDataFrame([(u,) for u in found], "u string")
    assert [r[0] for r in d.select(discovery.looks_like_article(F.col("u"), "a.lk", "https://a.lk/news", ("/biz",))).collect()] == list(found.values())


def test_markup_that_no_parser_knows(spark):
    pages = ["<p>a</p><![weird x><p>b</p>", "<p>a</p><![weird x>b", "<p>a<![CDATA[x]]><p>b", "<p>a</p><![", "<!DOCTYPE x [<!weird", "<p>a <b", "<div><p>a</div></p></p>&#xZZ; <a href='/q'", "<" * 50, "<![if !IE]><p>a</p><![endif]>"]
    d = spark.createDataFrame([(p,) for p in pages], "html string")
    got = d.select(html.article_text(F.col("html")).alias("t"), html.links_with_dates(F.col("html")), html.links_with_excerpts(F.col("html")), html.links_with_cards(F.col("html"))).collect()
    assert len(got) == len(pages) and [r.t for r in got[:2]] == ["a\n\nb", "a"]


def test_neighbourhoods_cost_in_proportion_to_the_page():
    import time

    page = "<body>" + "".join(f"<div><div><a href='/{k}'>link {k}</a><p>short</p></div></div>" for k in range(4000)) + "</body>" + "<div>" * 5000
    at = time.process_time()
    assert len(markup.Page(page).near(7, 2500, None, 40)) == 4000
    assert time.process_time() - at < 3
