"""The tokenizer against the standard library's parser, and by worked pages."""

import random
import time
from html.parser import HTMLParser

from pyspark.sql import functions as F

from inkwell.functions import markup
from inkwell.functions.markup import Page, best_run
from inkwell.operators import extraction


class Plain(HTMLParser):
    """Metadata, link targets and texts as the standard parser finds them."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.metas, self.hrefs, self.said, self.raw = [], [], [], None
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        d = dict(attrs)
        if tag == "meta":
            self.metas.append(tuple(d.get(c) for c in ("property", "name", "content")))
        if tag == "a" and d.get("href"):
            self.hrefs.append(d["href"])
        self.raw = tag if tag in ("script", "style") else None

    def handle_endtag(self, tag):
        self.raw = None

    def handle_data(self, data):
        if self.raw is None:
            self.said += data.split()


PIECES = [
    "<p>One &amp; two", "</p>", "<div class=x>", "</div>", "<!-- <meta name='author' content='no'><a href='no'>x</a> -->", "<script>var a = \"<a href='no'>\" < 3;</script>", "<style>p > a {}</style>",
    "<meta property=og:title content=Plain>", "<META NAME='author' CONTENT=\"Jos&eacute; O&#8217;Neil\">", "<meta name=description content='a > b'/>", "<a href=/u/x/1>text</a>", "<a href='/q?a=1&amp;b=2' title=\"it's\">more <b>bold</b></a>",
    "<A HREF = \"/sp ace\" >x</A>", "<a name=x>no target</a>", "<br/>", "<br>", "a < b and c > d", " &mdash; &#x2014; &nbsp; ", "<li>item", "<ul>", "</ul>", "\n", "<p data-a='1' data-b = 2 hidden>", "<time datetime=2026-09-14>14</time>", "<!DOCTYPE html>", "&copy", "<span\nclass='y'\n>z</span>",
]


def agrees(page):
    got, want = Page(page), Plain(page)
    assert [(m["property"], m["name"], m["content"]) for m in got.metas()] == want.metas, page
    assert [a["href"] for a in got.anchors()] == want.hrefs, page
    assert got.text().split() == want.said, page


def test_agrees_with_the_standard_parser():
    rng = random.Random(4)
    for _ in range(400):
        agrees("".join(rng.choices(PIECES, k=rng.randrange(1, 14))) + "<p>end")


def test_agrees_on_the_pages_of_the_table(spark):
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect():
        agrees(r.html[: r.html.rfind(">") + 1])


def test_what_is_no_tag():
    for page, said in [
        ("a<3 and <b>c</b>", "a<3 and c"), ("<p>a</p><b", "a"), ("x <a href='y", "x"), ("<>", "<>"), ("a</>b", "a b"), ("</ x>y", "y"), ("<!-->a-->b", "a-->b"), ("a<!-- open", "a"), ("a<!x>b<?php y?>c", "a b c"),
        ("<title>a <b>x</b> &lt;</title>t", "a <b>x</b> < t"), ("<script>never ends <p>x", ""), ("<script>a</scripty></SCRIPT >b", "b"), ("<p =x>t", "t"), ("<p don't>it's</p>", "it's"), ("<p a=\"x>y</p>z", "y z"), ("\0<p>�", "\0 �"), ("", ""), (None, ""),
    ]:
        assert Page(page).text() == said, page


def test_any_page_is_read_in_proportion_to_its_length():
    at = time.process_time()
    for page in ("<" * 200_000, "<a " * 100_000, "<a \"" * 100_000, "<!--" * 100_000, "<a b='" * 80_000 + ">", "</" * 100_000, "<p>" * 100_000, "<div><a href=x>y" * 30_000, "&" * 200_000, "<a b=c " * 60_000 + "<p>"):
        Page(page).body()
    assert time.process_time() - at < 20


def test_main_text_is_the_run_worth_most():
    rng = random.Random(6)
    for _ in range(200):
        w = [rng.randrange(-9, 10) for _ in range(rng.randrange(9))]
        sums = [(sum(w[i:j]), -i, -j) for i in range(len(w)) for j in range(i + 1, len(w) + 1)]
        low, high = best_run(w)
        assert sum(w[low:high]) == max([0, *(s for s, _, _ in sums)])


def test_lists_of_links_fall_away():
    links = "".join(f"<li><a href='/{k}'>Related story number {k}</a></li>" for k in range(12))
    one, two = "First paragraph with <a href='/x'>a link</a> and what it says of the bank.", "Second paragraph, longer than the first one was, of the same story."
    page = f"<div><ul>{links}</ul></div><div><p>{one}</p><p><a href='/ad'>Read also this</a></p><p>{two}</p></div><ul>{links}</ul><p>Tail</p>"
    assert Page(page).body() == "First paragraph with a link and what it says of the bank.\n\nSecond paragraph, longer than the first one was, of the same story."


def test_bodies_of_known_pages(spark):
    """Recall and precision of words on the table's pages, whose paragraphs are known, among ads and lists of links put between."""
    import re

    found = known = right = 0
    noise = "<ul>" + "".join(f"<li><a href='/n{k}'>noise{k} noise noise</a></li>" for k in range(9)) + "</ul><div>advert</div>"
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").limit(120).collect():
        inside = re.search("<article>.*?</h1>(.*?)(?:</article>|$)", r.html, re.S)[1]
        want = re.sub("<[^>]*>?", " ", inside).split()
        got = Page(r.html.replace("<article>", noise + "<div>").replace("</article>", noise)).body().split()
        found, known, right = found + len(got), known + len(want), right + len(set(got) & set(want)) * len(got) // max(1, len(set(got)))
    assert right / found > 0.95 and found / known > 0.95


def test_one_pass_over_each_page(spark):
    d = spark.createDataFrame([("http://a/", "<p>x")], "final_url string, html string").withColumn("url", F.col("final_url"))
    plan = extraction.extract_articles(d, "S", "T")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("run(html") == 1


def test_columns_of_a_page(spark):
    d = spark.createDataFrame([("<title>T</title><h1></h1><h1>2</h1><link rel='a canonical' href=u><time>x</time>",), (None,)], "html string")
    a, b = (r[0] for r in d.select(markup.parsed(F.col("html"), "title", "h1", "links", "times", "shown", "scripts", "metas")).collect())
    assert (a.title, a.h1, a.shown) == ("T", None, "2 x") and a.links[0].rel == ["a", "canonical"] and a.times[0].text == "x"
    assert (b.title, b.h1, b.shown, b.links, b.metas) == (None, None, "", [], [])


def test_words_and_hash_of_a_body(spark):
    """Words and hash taken while the page is read are those of the column functions, also between odd blanks."""
    from inkwell.functions import text

    pages = ["", None, "<p> </p>", "<p>one</p>", "<p>a\u00a0b&nbsp;c\u2003 d\x1ce\x85f\u200bg</p><p>h &amp; \u3000</p><li>i<p>j", "<h2>\U0001f600 x</h2>\n<p>y\x0bz&#xD800;&#0;</p>"]
    pages += [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect()]
    p = markup.parsed(F.col("html"), "body", "words", "hash")
    rows = spark.createDataFrame([(x,) for x in pages], "html string").select(p.alias("p")).select("p.*", text.word_count(F.col("p.body")).alias("n"), text.content_hash(F.col("p.body")).alias("h")).collect()
    assert len(rows) == len(pages) and all((r.words, r.hash) == (r.n, r.h) for r in rows)
    assert [r.words for r in rows[:5]] == [0, 0, 0, 1, 9]


def test_extraction_needs_no_pattern_over_whole_texts(spark):
    """Words are counted and hashed where a page is read."""
    d = spark.createDataFrame([("http://a/", "<p>x")], "final_url string, html string").withColumn("url", F.col("final_url"))
    plan = extraction.extract_articles(d, "S", "T")._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "sha2" not in plan
