"""Queries over pages whose titles were cut, also inside of a character reference, against their SQL."""

import duckdb
import pytest

from inkwell import catalogue
from inkwell.functions.markup import Page, decoder

CUT = ["One two", "a&amp;&amp;&amp", "a &am", "b&a", "c &", "say &quot", "&quot;x&quot; &quo", "x &lt", "y &lt;b&gt", "&#39;z&#39", "q &#3", "&amp;lt; &amp;amp", "&amp;copy; r", "R&amp;D  and&amp;"]
PAGE = (
    '<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>{0}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body><nav><ul><li><a href="/a?b=1&amp;c=2">Home</a></li></ul></nav>'
    '<!-- ad --><div class="ad">Ad.</div><article><h1>{0}</h1><p>One.</p></article><footer>&copy; x.example.net &middot; End.</footer></body></html>'
)


@pytest.fixture(scope="module")
def cut(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("cut"))
    spark.createDataFrame([(k, f"https://x.example.net/en/{k}.html", PAGE.format(t)) for k, t in enumerate(CUT)], "page_id long, url string, html string").coalesce(1).write.parquet(f"{d}/pages.parquet")
    return d


@pytest.mark.parametrize("name", ["headline_cascade", "odd_markup", "page_facts", "page_probe", "probe_words"])
def test_cut_titles(spark, cut, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{cut}/pages.parquet/*.parquet'")
    want = con.execute(catalogue.ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(map(tuple, catalogue.QUERIES[name](spark, cut).select(*columns).collect())) == sorted(want.fetchall())


def test_references_that_are_known():
    assert decoder(("&amp;", "&amp"))("&amp;amp &ampx &lt; &copy") == "&amp &x &lt; &copy"
    assert decoder(())("&amp; &#39;") == "&amp; &#39;" and decoder()("&ampx &copy &#39") == "&x © '"
    page = Page("<meta name='a&lt;' content='&quot;b&quot'><p>c &quot", decoder(("&quot;",)))
    assert page.metas()[0]["content"] == '"b&quot' and page.text() == "c &quot"
