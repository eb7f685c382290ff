"""URL filters: rules against a plain version, trees against a walk, accuracy on URLs kept back."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkwell.llm import urlfilter
from inkwell.llm.urlfilter import RULES
from tests.llm.test_quality import one_by_one

SF = "/root/testdata/sf0.01"
ODD = [
    (1, None), (2, ""), (3, "no scheme.com/"), (4, "http://A.COM/x"), (5, "http://a.com"), (6, "http://com/"), (7, "http://xcom/"), (8, "http://www.Example.com/en/?a=b#c"),
    (9, "http://m.example.com/en/1"), (10, "http://a.www.example.com/en/"), (11, "http://example.com/EN/"), (12, "https://b.net/es/#x"), (13, "https://b.net/fr/9?q"), (14, "https://b.net/es"), (15, "ftp://net/fr/"),
    (16, "a://b://c.com/x"), (17, "://com/"), (18, "http://a.com?x=://net/es/"), (19, "http://ä.net/es/ñ"), (20, "http://a\nb.com/x\ny?z"), (21, "http://x.org/" + "p/" * 50_000), (21, "http://a.com/"), (None, "http://a.com/"), (22, "http://a.com:80/"), (23, "http://u@b.net/fr/"),
]


def plain(url):
    """host, path, rule, the rule's verdict."""
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end : min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    r = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, r and r.name, r and r.verdict


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string").withColumns({"html": F.lit("x"), "host": F.lit("clash"), "score": F.lit(1)})


def test_rules_on_odd_urls(spark):
    got = urlfilter.filter_urls(pages(spark, ODD), RULES).collect()
    said = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict if r.rule else None) for r in got), key=repr)
    assert said == sorted(((i, *plain(u)) for i, u in ODD), key=repr)
    assert all(r.verdict in ("allow", "block") and 0 <= r.score <= 1 for r in got)


def test_query_against_plain_rules_and_model(spark):
    """Every page: the rules' verdicts, else what the score says."""
    got = {r.page_id: r for r in urlfilter.op13_url_filter(spark, SF).collect()}
    urls = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()
    assert len(got) == len(urls)
    for r in urls:
        g = got[r.page_id]
        assert (g.host, g.path, g.rule) == plain(r.url)[:3]
        assert g.verdict == (plain(r.url)[3] or ("block" if g.score >= 0.5 else "allow"))


def test_scores_are_those_of_the_trees(spark):
    rows = [(i, f"https://h{i % 7}.{'org net com'.split()[i % 3]}/{'es en'.split()[i % 2]}/{i}") for i in range(300)]
    df = pages(spark, rows)
    got = {r.page_id: r.score for r in urlfilter.filter_urls(df, RULES).collect()}
    host = urlfilter.host_of(F.col("url"))
    path = urlfilter.path_of(F.col("url"))
    placed = df.select("page_id", "url", urlfilter.longest_rule(host, path, RULES).alias("r"), *[c.alias(k) for k, c in urlfilter.places(host, path).items()])
    labelled = placed.where("r is not null").select("url", *urlfilter.KINDS, (F.col("r.verdict") == "block").alias("blocked"))
    trees, statistics = urlfilter.learn(placed.select(*urlfilter.KINDS), labelled)
    for r in placed.collect()[:40]:
        row = urlfilter.rows_of([r.url.encode()], [np.array([r[k]]) for k in urlfilter.KINDS], statistics)[0]
        assert got[r.page_id] == pytest.approx(one_by_one(trees, row))


def test_suffix_statistics_are_counts(spark):
    rows = [("a.com", True), ("b.com", True), ("c.com", False), ("a.net", False), ("x.a.com", True)]
    df = spark.createDataFrame([(f"http://{h}/", b) for h, b in rows], "url string, blocked boolean")
    host = urlfilter.host_of(F.col("url"))
    placed = df.select("url", "blocked", *[c.alias(k) for k, c in urlfilter.places(host, urlfilter.path_of(F.col("url"))).items()])
    s = urlfilter.suffix_statistics(placed, placed)
    at = {r.url: (r.suffix, r.site) for r in placed.collect()}
    com, net, site = at["http://a.com/"][0], at["http://a.net/"][0], at["http://a.com/"][1]
    mean = 3 / 5
    assert s[0, 0, com] == pytest.approx((3 + 8 * mean) / (4 + 8)) and s[0, 0, net] == pytest.approx((0 + 8 * mean) / (1 + 8))
    assert s[1, 0, site] == pytest.approx((2 + 8 * mean) / (2 + 8)) and s[0, 1, com] == pytest.approx(np.log2(5 / 6))


def test_learned_from_labels_of_the_user(spark):
    """Four fifths of labelled URLs teach, the rest are told right."""
    rng = np.random.default_rng(3)

    def url(i):
        bad = i % 2 == 0
        host = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz0123456789"), 18)) if bad else rng.choice(["daily", "evening", "market"]) + rng.choice(["news", "post", "times"])
        return i, f"http://{host}.org/{'&'.join('?' * (i % 2 == 0))}{'x=1&y=2&z=3' if bad else 'politics/' + str(i)}", bad

    rows = [url(i) for i in range(1500)]
    taught = spark.createDataFrame([(u, b) for i, u, b in rows if i % 5], "url string, blocked boolean")
    asked = [(i, u, b) for i, u, b in rows if i % 5 == 0]
    got = {r.page_id: r.verdict for r in urlfilter.filter_urls(pages(spark, [(i, u) for i, u, _ in asked]), [], taught).collect()}
    assert np.mean([(got[i] == "block") == b for i, _, b in asked]) > 0.97


def test_rules_as_labels_on_urls_kept_back(spark):
    """Rules of four fifths of the hosts' URLs teach; the trees alone tell the others."""
    p = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    r = urlfilter.longest_rule(urlfilter.host_of(F.col("url")), urlfilter.path_of(F.col("url")), RULES)
    known = p.withColumn("v", r["verdict"]).where("v is not null")
    taught = known.where(F.crc32("url") % 5 != 0).select("url", (F.col("v") == "block").alias("blocked"))
    kept = known.where(F.crc32("url") % 5 == 0)
    got = urlfilter.filter_urls(kept, [], taught).join(kept.select("page_id", "v"), "page_id").collect()
    assert len(got) > 150 and np.mean([r.verdict == r.v for r in got]) > 0.95


def test_few_labels_and_none(spark):
    none = spark.createDataFrame([], "url string, blocked boolean")
    assert urlfilter.filter_urls(pages(spark, []), RULES).collect() == []
    assert [r.score for r in urlfilter.filter_urls(pages(spark, [(1, "http://a.org/")]), RULES, none).collect()] == [0.5]
    one = spark.createDataFrame([(f"http://a{i}.org/", True) for i in range(40)] + [(None, False), ("http://b.org/", None)], "url string, blocked boolean")
    assert [r.verdict for r in urlfilter.filter_urls(pages(spark, [(1, "http://a.org/")]), [], one).collect()] == ["block"]


def test_repeated_urls_leave_the_other_label_in_the_sample(spark):
    """The draw is among distinct URLs, each label for itself, in an order that reruns share."""
    rows = [("http://hot.com/", False, k) for k in range(3000)] + [(f"http://x{i}.net/", True, i) for i in range(30)]
    df = spark.createDataFrame(rows, "url string, blocked boolean, k long")
    placed = df.select("url", *[F.lit(1).alias(k) for k in urlfilter.KINDS], "blocked")
    a = urlfilter.training_urls(placed, 10)
    b = urlfilter.training_urls(placed.repartition(7), 10)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert a.where("blocked").count() == 10 and a.where("not blocked").count() == 1
