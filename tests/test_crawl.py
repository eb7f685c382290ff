"""The frontier crawl and a run over a registry, against a local server."""

import threading
from dataclasses import replace
from functools import partial
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from inkwell.plans import collection, crawl
from inkwell.sources import readers
from inkwell.sources.rules import REGISTRY

DAY = "2026-09-14"  # a Monday: the window opens on Friday the 11th


def link(path, n, day):
    return f"<div><a href='{path}{n}'>Number {n} of the day</a><span>{day} September 2026</span></div>"


def ft(*days):
    return "".join(link("/financial-services/Some-thing/42-", n, day) for n, day in days)


ARTICLE = "<title>Article of the day</title><meta property='article:published_time' content='2026-09-14T08:00:00+05:30'><p>" + "word " * 90
SITE = {
    "/older": ft((1, "Monday, 14")), "/older/30": ft((2, "Friday, 11"), (3, "Thursday, 10")), "/older/60": ft((4, "Monday, 14")),
    "/empty": ft((5, "Sunday, 13")), "/empty/30": "<p>nothing", "/empty/60": ft((6, "Monday, 14")),
    "/long": ft((7, "Monday, 14")), "/long/30": ft((8, "Monday, 14")), "/long/60": ft((9, "Monday, 14")), "/long/90": ft((10, "Monday, 14")),
    "/broken": ft((11, "Monday, 14")),
    "/by-path/": "<a href='/2026/09/14/some-story'>A story of the day</a>", "/by-path/page/2/": "<a href='/2026/09/13/other-story'>Another story of it</a><a href='/2026/09/01/old'>An old story here</a>", "/by-path/page/3/": "x",
}


@pytest.fixture
def site():
    asked = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append(self.path)
            body = SITE.get(self.path, ARTICLE if "/42-" in self.path or self.path.startswith("/2026/") else None)
            self.send_response(404 if body is None else 200)
            self.send_header("Content-Type", "text/html; charset=utf-8")
            self.end_headers()
            self.wfile.write((body or "").encode())

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", asked
    server.shutdown()


def listings(root):
    one = replace(collection.LISTINGS["daily_ft"], base=root, domain="127.0.0.1", most_pages=3)
    found = {key: replace(one, section=f"{root}/{key}") for key in ("older", "empty", "long", "broken")}
    return found | {"by-path": replace(collection.LISTINGS["ceylon_today"], base=f"{root}/", domain="127.0.0.1", section=f"{root}/by-path/")}


def test_no_page_after_a_stop_is_asked_for(spark, site):
    root, asked = site
    pages = crawl.crawl(spark, listings(root), DAY, partial(readers.fetch_pages, attempts=1)).collect()
    assert sorted(asked) == sorted(["/older", "/older/30", "/empty", "/empty/30", "/long", "/long/30", "/long/60", "/broken", "/broken/30", "/by-path/", "/by-path/page/2/"])
    got = {(r.source_key, r.page): (r.html is None, r.error is None) for r in pages}
    assert len(got) == len(pages) == 11 and [k for k, v in got.items() if v != (False, True)] == [("broken", 2)]
    assert crawl.crawl(spark, {}, DAY).collect() == []


def test_a_run_over_a_registry(spark, site, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "BUCKETS", 4)
    root, asked = site
    rows = [(k, None, k.upper(), None, True, "ACTIVE", None, None) for k in ("older", "long", "broken", "nobody", "by-path")] + [("empty", None, "E", None, False, "ACTIVE", None, None)]
    registry = spark.createDataFrame(rows, REGISTRY)
    paths = [str(tmp_path / p) for p in ("state", "raw", "staged")]
    run = lambda now, k: crawl.run_registry(spark, registry, *paths, DAY, now, k, listings(root), partial(readers.fetch_pages, attempts=1))
    statuses = run("2026-09-14T08:00:00", "r1")
    crawl.write_run(statuses, str(tmp_path / "statuses"), str(tmp_path / "summary"))
    got = {r.source_key: (r.execution_status, r.content_status, r.new_articles) for r in readers.read_statuses(spark, str(tmp_path / "statuses")).collect()}
    assert got == {
        "older": ("SUCCESS", "NEW_ARTICLES_FOUND", 2), "long": ("SUCCESS", "NEW_ARTICLES_FOUND", 3), "by-path": ("SUCCESS", "NEW_ARTICLES_FOUND", 2),
        "broken": ("FAILED", "SOURCE_FETCH_FAILED", None), "nobody": ("FAILED", "NO_COLLECTOR_IMPLEMENTED", None),
    }
    summary = spark.read.json(str(tmp_path / "summary")).first()
    assert (summary.active_sources_run, summary.successful_sources, summary.failed_sources, summary.healthy_sources) == (5, 3, 2, 3)
    assert not any("/42-11" in a or "/42-3" in a or "/empty" in a for a in asked)
    staged = readers.staged(paths[2]).read(spark)
    assert {r.source: r["count"] for r in staged.groupBy("source").count().collect()} == {"older": 2, "long": 3, "by-path": 2}
    assert staged.where(F.col("collection_run_date") != DAY).isEmpty()
    # an hour later nothing is due: section pages are read again, articles are not
    before = len(asked)
    again = {r.source_key: r.recent_duplicates for r in run("2026-09-14T09:00:00", "r2").collect()}
    assert again["older"] == 2 and not any("/42-" in a or a.startswith("/2026/") for a in asked[before:])
