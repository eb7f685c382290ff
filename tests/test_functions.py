"""Functions against plain Python."""

import hashlib
from datetime import date, datetime, timedelta
from urllib.parse import parse_qsl, urlencode, urljoin, urlparse, urlunparse

import pytest
from pyspark.sql import functions as F

from inkwell.functions import dates, text, urls


def values(spark, rows, expr, schema="s string"):
    return [r[0] for r in spark.createDataFrame([(x,) if not isinstance(x, tuple) else x for x in rows], schema).select(expr).collect()]


SPACED = ["", "  a  b ", "a\u00a0b\x1cc\x85d", "\u2003x\u3000", "one\ntwo\r\nthree", None]


def test_collapse_and_hashes(spark):
    assert values(spark, SPACED, text.collapse(F.col("s"))) == [None if s is None else " ".join(s.split()) for s in SPACED]
    assert values(spark, SPACED, text.content_hash(F.col("s"))) == [hashlib.sha256(" ".join((s or "").split()).encode()).hexdigest() for s in SPACED]
    assert values(spark, SPACED, text.word_count(F.col("s"))) == [len((s or "").split()) for s in SPACED]
    assert values(spark, ["u"], text.url_hash(F.col("s"))) == [hashlib.sha256(b"u").hexdigest()[:16]]


def test_body_keeps_lines_with_text(spark):
    assert values(spark, [" a  b\n\n \nc\r\n d", None, ""], text.normalize_body(F.col("s"))) == ["a b\n\nc\n\nd", "", ""]


def test_matching_form(spark):
    assert values(spark, ["Bank’s “Loan” – 5%!", None, "A&B  C", "a\0b", "\té\0 É x"], text.matching_form(F.col("s"))) == ["bank's loan - 5%", "", "a b c", "a b", "x"]


@pytest.mark.parametrize("form, found", [("a bank.", True), ("non-bank", True), ("bank's", True), ("banks", False), ("ebank", False), ("2bank", False), ("bank", True), ("", False)])
def test_terms_stand_alone(spark, form, found):
    assert values(spark, [form], text.contains_term(F.col("s"), F.lit("bank"))) == [found]


def test_terms_keep_the_order_of_the_list_and_their_form(spark):
    got = values(spark, ["the loan of a (bank)"], text.matching_terms(F.lit("the loan of a bank"), ["Bank", "fee", "loan", "a bank"]))
    assert got == [["Bank", "loan", "a bank"]]
    assert values(spark, ["x"], text.matching_terms(F.col("s"), [])) == [[]]


def test_one_publisher_is_cut_off(spark):
    heads = ["Rates  up | Daily FT", "Rates up – the island", "Rates - Daily News - Daily News", "Daily FT", "", None, "X -Daily FT"]
    assert values(spark, heads, text.clean_headline(F.col("s"))) == ["Rates up", "Rates up", "Rates - Daily News", "Daily FT", "", "", "X -Daily FT"]


def test_identities(spark):
    rows = [("s", "c", "u", "r/s/d/v1.json"), ("s", None, "u", "r/s/d/v1.json"), ("s", "", None, "r/s/d/v1.json"), ("s", None, None, "v1.json")]
    got = [r[0] for r in spark.createDataFrame(rows, "a string, b string, c string, d string").select(text.article_identity(*map(F.col, "abcd"))).collect()]
    assert got == ["s|c", "s|u", "s|d", "s|v1.json"]
    paths = ["a/daily/2026-09-14/abc/v012.json", "a/daily/2026-09-14/x y!.json", "2026-9-14/v1.txt"]
    assert values(spark, paths, text.path_date(F.col("s"))) == ["2026-09-14", "2026-09-14", None]
    assert values(spark, paths, text.article_version(F.lit(None).cast("string"), F.col("s"))) == [12, 0, 0]
    assert values(spark, paths, text.article_version(F.lit("7"), F.col("s"))) == [7, 7, 7]
    assert values(spark, paths, text.article_id_from_path(F.col("s"), F.lit(None).cast("string"), ["daily"])) == ["abc", "x_y_", "2026-9-14"]
    assert values(spark, [(1,), (99,), (1234,)], text.version_name(F.col("n")), "n int") == ["v001", "v099", "v1234"]
    assert values(spark, [" Daily FT! ", "--"], text.source_slug(F.col("s"))) == ["daily_ft", ""]


def plain_normal(url):
    p = urlparse(url)
    q = [(k, v) for k, v in parse_qsl(p.query, keep_blank_values=True) if k.lower() not in urls.TRACKING_KEYS]
    path = p.path if p.path == "/" else p.path.rstrip("/")
    return urlunparse(p._replace(scheme=p.scheme.lower(), netloc=p.netloc.lower(), path=path, query=urlencode(q), fragment=""))


URLS = [
    "HTTPS://WWW.Ft.lk/A/b//?utm_source=x&b=&a=1&UTM_Medium=2#top", "http://a.lk/", "http://a.lk", "http://a.lk/x?q=a b&c=%7E%2f*", "/only/path/", "http://a.lk/?gclid=1",
    "http://u:p@A.lk:80/x", "http://a.lk/x?&&a", "", "http://a.lk/é?ü=1",
]


def test_normalize_url(spark):
    assert values(spark, URLS, urls.normalize_url(F.col("s"))) == [plain_normal(u) for u in URLS]


def test_domains(spark):
    hosts = ["https://ft.lk/x", "https://www.FT.lk:443/", "https://notft.lk", "https://u@x.ft.lk", "ft.lk", ""]
    assert values(spark, hosts, urls.domain_matches(F.col("s"), "ft.lk")) == [True, True, False, True, False, False]


@pytest.mark.parametrize("base", ["https://www.ft.lk/a/b/c?x=1#y", "https://www.ft.lk", "https://www.ft.lk/"])
def test_absolute_url(spark, base):
    hrefs = ["", "d", "../d", "./d/", "/d/../e", "//z.lk/q", "?q=2", "#f", "http://o/p", "d//e/f", "/a//b", "mailto:x@y", "..", ".", "../../../../g?h#i"]
    assert values(spark, hrefs, urls.absolute_url(F.lit(base), F.col("s"))) == [urljoin(base, h) for h in hrefs]


def test_section_pages(spark):
    n = [(1,), (2,), (4,)]
    assert values(spark, n, urls.section_page_by_offset(F.lit("b"), F.col("n")), "n int") == ["b", "b/30", "b/90"]
    assert values(spark, n, urls.section_page_by_path(F.lit("b/"), F.col("n")), "n int") == ["b/", "b/page/2/", "b/page/4/"]


def test_windows_of_every_weekday(spark):
    days = [date(2026, 12, 28) + timedelta(days=k) for k in range(9)]
    got = values(spark, [(d,) for d in days], dates.window_dates(F.col("d")), "d date")
    for d, found in zip(days, got, strict=True):
        back = {0: 3, 5: 0, 6: 0}.get(d.weekday(), 1)
        assert found == [(d - timedelta(days=k)).isoformat() for k in range(back, -1, -1)]


def test_article_dates(spark):
    said = ["2026-09-11T10:00:00+05:30", "2026-09-11T22:00:00Z", "2026-09-11", "2026-09-11T23:59:59.123456", "2026-09", "2026", "2026-09-11Tjunk", "2026-02-30", "", None]
    d11, d12 = date(2026, 9, 11), date(2026, 9, 12)
    assert values(spark, said, dates.article_date(F.col("s"))) == [d11, d12, d11, d11, None, None, None, None, None, None]


def test_free_text_dates(spark):
    said = ["Friday, 11 September 2026 05:54", "11 SEPTEMBER 2026", "September 3, 2026", "3 Sep 2026", "2026-09-11T22:00:00Z", "soon", None]
    at = ["2026-09-11T05:54:00", "2026-09-11T00:00:00", "2026-09-03T00:00:00", "2026-09-03T00:00:00", "2026-09-12T03:30:00"]
    assert values(spark, said, dates.parse_free_text(F.col("s"))) == [f"{a}+05:30" for a in at] + [None, None]
    assert values(spark, ["/2026/02/30/x", "/2026/02/03/x", "/x"], dates.hint_from_path(F.col("s"))) == [None, "2026-02-03T00:00:00+05:30", None]


def test_next_fire(spark):
    at = [datetime(2026, 9, 11, 17, 0), datetime(2026, 9, 11, 7, 59), datetime(2026, 9, 14, 8, 0), datetime(2026, 9, 12, 12, 0)]
    want = [datetime(2026, 9, 14, 8), datetime(2026, 9, 11, 8), datetime(2026, 9, 14, 9), datetime(2026, 9, 14, 8)]
    assert values(spark, [(a,) for a in at], dates.next_fire(F.col("t")).cast("timestamp_ntz"), "t timestamp_ntz") == want
