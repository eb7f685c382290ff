"""Readers, sinks, the scoring job, a collection run and the streams, on small files."""

import json
import threading
from datetime import datetime, timedelta
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from inkwell.operators import rollup
from inkwell.plans import collection, history, stage1
from inkwell.sources import readers, sinks
from inkwell.sources.rules import DEMO
from inkwell.streaming import sightings


def staged(root, source, day, name, version, **fields):
    folder = root / source / day / name
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"v{version:03d}.json").write_text(json.dumps({"article_version": version, **fields}, indent=2, ensure_ascii=False), encoding="utf-8")


@pytest.fixture
def files(tmp_path):
    root = tmp_path / "staged"
    a = {"source_name": "Daily FT", "source_url": "https://a", "canonical_url": "https://a", "content_hash": "h" * 64, "published_at": "2026-09-14T09:00:00+05:30"}
    staged(root, "daily_ft", "2026-09-14", "aa", 1, headline="The old", article_text="of the", **a)
    staged(root, "daily_ft", "2026-09-14", "aa", 2, headline="The new", article_text="of the, é", **a)
    staged(root, "ceylon_today", "2026-09-14", "bb", 1, headline="", article_text="x", source_url="https://b", published_at=None)
    staged(root, "ceylon_today", "2026-09-11", "cc", 1, headline="h", article_text="x", source_url="https://c", published_at="2026-09-11")
    (root / "ceylon_today" / "2026-09-14" / "bad.json").write_text("{not json")
    return root


def test_scoring_job_keeps_labels(spark, files, tmp_path):
    review, analyses = str(tmp_path / "review"), str(tmp_path / "analyses")
    job = lambda: stage1.run(spark, str(files), ["daily_ft", "ceylon_today"], "2026-09-14", DEMO, analyses, review).first().asDict()
    assert job() == {"include": 0, "watch": 0, "exclude": 1, "failed": 1}
    rows = readers.read_annotations(spark, review).collect()
    assert [(r.source_url, r.human_label) for r in rows] == [("https://a", None)]
    # a person labels the row, then the job runs again
    held = spark.read.option("header", True).csv(review).toPandas()
    assert held.columns[0] == "source_name" and held.loc[0, "headline"] == "The new" and held.loc[0, "institutions"] is None
    held["human_label"], held["review_notes"] = "RELEVANT", 'said "yes", twice'
    held.to_csv(tmp_path / "edited.csv", index=False, encoding="utf-8-sig")
    (again := readers.read_annotations(spark, str(tmp_path / "edited.csv"))).collect()
    assert again.first().human_label == "RELEVANT" and again.first().review_notes == 'said "yes", twice'
    spark.createDataFrame(held.fillna("")).coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(review)
    assert job()["exclude"] == 1
    assert spark.read.option("header", True).option("escape", '"').csv(review).first().review_notes == 'said "yes", twice'
    assert readers.analyses(analyses).read(spark, run_date="2026-09-14").count() == 1


def test_staged_files_and_dates(spark, files):
    s = readers.read_staged(spark, str(files), ["daily_ft", "ceylon_today"])
    assert s.where("corrupt").count() == 1 and s.count() == 5
    got = {(r.source, r.date): r.records for r in stage1.available_dates(s).collect()}
    assert got == {("daily_ft", "2026-09-14"): 2, ("ceylon_today", "2026-09-14"): 1, ("ceylon_today", "2026-09-11"): 1}
    with pytest.raises(ValueError):
        stage1.run(spark, str(files), ["daily_ft"], "2026-9-14", DEMO, "x", "y")
    assert stage1.window_dates_of("2026-09-14") == ["2026-09-11", "2026-09-12", "2026-09-13", "2026-09-14"]


def test_missing_files_are_empty(spark, tmp_path):
    assert readers.read_state(spark, str(tmp_path / "no")).isEmpty()
    assert readers.read_statuses(spark, str(tmp_path / "no")).isEmpty()
    assert readers.read_annotations(spark, str(tmp_path / "no")).isEmpty()


def page(n, date="14 September 2026", words=90):
    return f"<title>Article {n} of the day</title><meta property='article:published_time' content='{date}'><p>{' '.join(['word'] * words)} {n}</p>"


def test_collection_run(spark, tmp_path):
    listing = collection.LISTINGS["daily_ft"]
    link = lambda n, day: f"<div><a href='/financial-services/Some-thing/42-{n}'>Number {n}</a><span>{day} September 2026</span></div>"
    sections = spark.createDataFrame(
        [(1, link(1, "Monday, 14") + link(2, "Friday, 11") + link(3, "Tuesday, 15") + "<a href='/other/1'>x</a>"), (2, link(4, "Thursday, 10") + link(5, "Monday, 14")), (3, link(6, "Monday, 14"))], "page int, html string"
    )
    wanted = collection.required(collection.discover(sections, listing), listing, "2026-09-14")
    urls = {r.url: r.headline for r in wanted.collect()}
    base = "https://www.ft.lk/financial-services/Some-thing/42-"
    assert set(urls) == {base + "1", base + "2", base + "5"}  # future and older items go, page 3 isn't read
    html = {base + "1": page(1), base + "2": page(2, "11 September 2026"), base + "5": page(5, words=20)}
    pages = spark.createDataFrame([(u, u, h) for u, h in html.items()], "url string, final_url string, html string")
    state = readers.read_state(spark, str(tmp_path / "state"))
    run = lambda state, pages, now: collection.collect(wanted, pages, state, "Daily FT", "F", "2026-09-14", now)
    outcomes, after = run(state, pages, "2026-09-14T08:00:00")
    assert {r.url[-1]: r.outcome for r in outcomes.collect()} == {"1": "NEW", "2": "LATE", "5": "INVALID"}
    path = sinks.write_snapshot(after, str(tmp_path / "states"), "r1")
    held = {r.url[-1]: (r.version_number, r.last_fetched_at) for r in readers.read_state(spark, path).collect()}
    assert held == {"1": (1, "2026-09-14T08:00:00"), "2": (1, "2026-09-14T08:00:00"), "5": (0, None)}
    row = collection.status(outcomes, "daily_ft", "r1").first()
    assert (row.content_status, row.health_status, row.new_articles, row.late_discoveries, row.invalid_extraction) == ("NEW_ARTICLES_FOUND", "PARTIAL_ERROR", 2, 1, 1)
    # an hour later only what was never fetched is due; seven hours later one has changed
    outcomes, _ = run(readers.read_state(spark, path), pages.where("html is null"), "2026-09-14T09:00:00")
    assert {r.url[-1]: r.outcome for r in outcomes.collect()} == {"1": "RECENTLY_FETCHED", "2": "RECENTLY_FETCHED", "5": "FETCH_FAILED"}
    changed = pages.withColumn("html", F.when(F.endswith("url", F.lit("1")), page("1 again")).otherwise(F.col("html")))
    outcomes, after = run(readers.read_state(spark, path), changed, "2026-09-14T15:00:00")
    assert {r.url[-1]: r.outcome for r in outcomes.collect()} == {"1": "CHANGED", "2": "UNCHANGED", "5": "INVALID"}
    assert {r.url[-1]: r.version_number for r in after.collect()} == {"1": 2, "2": 1, "5": 0}


def test_a_run_ends_in_stored_articles_that_can_be_scored(spark, tmp_path):
    link = lambda n: f"<div><a href='/financial-services/Some-thing/42-{n}'>Number {n}</a><span>Monday, 14 September 2026</span><p>What the listing says of this one, in forty letters.</p></div>"
    sections = spark.createDataFrame([(1, link(1) + link(2) + "<![odd>")], "page int, html string")
    base = "https://www.ft.lk/financial-services/Some-thing/42-"
    pages = spark.createDataFrame([(base + n, base + n, page(n)) for n in "12"], "url string, final_url string, html string")
    raw, staged = str(tmp_path / "raw"), str(tmp_path / "staged")
    state = readers.read_state(spark, str(tmp_path / "none"))
    for k, (now, again) in enumerate((("2026-09-14T08:00:00", pages), ("2026-09-14T18:00:00", pages.withColumn("html", F.when(F.endswith("url", F.lit("1")), page("1 again")).otherwise(F.col("html")))))):
        row, state = collection.run(spark, "daily_ft", sections, state, "2026-09-14", now, f"r{k}", raw, staged, again)
        assert row.first().content_status == ("NEW_ARTICLES_FOUND", "ARTICLES_CHANGED")[k]
    found = readers.read_staged(spark, staged, ["source=daily_ft"], one_a_file=False)
    got = sorted((r.source_url[-1], r.article_version, r.collection_status, r.listing_headline, r.listing_published_at, r.listing_excerpt is not None, r.collection_mode) for r in found.collect())
    assert got == [("1", "1", "NEW", "Number 1", "2026-09-14T00:00:00+05:30", True, "MONDAY_WEEKEND_CATCHUP"), ("1", "2", "CHANGED", "Number 1", "2026-09-14T00:00:00+05:30", True, "MONDAY_WEEKEND_CATCHUP"), ("2", "1", "NEW", "Number 2", "2026-09-14T00:00:00+05:30", True, "MONDAY_WEEKEND_CATCHUP")]
    counts = stage1.run(spark, staged, ["source=daily_ft"], "2026-09-14", DEMO, str(tmp_path / "analyses"), str(tmp_path / "review"), one_a_file=False).first()
    assert counts.include + counts.watch + counts.exclude == 2 and counts.failed == 0


def test_no_jobs_no_rows(spark):
    assert collection.run_sources(spark, {}, "r").count() == 0


def test_the_last_whole_snapshot_is_current(spark, tmp_path):
    root = str(tmp_path / "states")
    assert sinks.current_snapshot(spark, root) is None
    for run in ("r2", "r1"):
        path = sinks.write_snapshot(spark.createDataFrame([(run,)], "url string"), root, run)
    assert sinks.current_snapshot(spark, root) == path == f"{root}/run=r1"


def test_one_failing_source_leaves_the_others(spark):
    good = lambda: spark.createDataFrame([("a", "r", "SUCCESS", "HEALTHY", "NO_NEW_ARTICLES", 3)], "source_key string, run_id string, execution_status string, health_status string, content_status string, new_articles int")

    def bad():
        raise RuntimeError("page 2")

    got = {r.source_key: (r.execution_status, r.content_status, r.error_message) for r in collection.run_sources(spark, {"b": bad, "a": good}, "r").collect()}
    assert got == {"a": ("SUCCESS", "NO_NEW_ARTICLES", None), "b": ("FAILED", "SOURCE_FETCH_FAILED", "page 2")}


def test_statuses(spark, tmp_path):
    path = str(tmp_path / "statuses")
    for run in ("r1", "r2"):
        sinks.write_statuses(spark.createDataFrame([("k", run, "SUCCESS", "HEALTHY", "NO_NEW_ARTICLES")], "source_key string, run_id string, execution_status string, health_status string, content_status string"), path)
    now = sinks.current_statuses(readers.read_statuses(spark, path))
    assert [(r.source_key, r.run_id) for r in now.collect()] == [("k", "r2")]
    summary = rollup.run_summary(now)
    sinks.write_run_summary(summary, now.select("source_key", "run_id"), str(tmp_path / "summary"))
    got = spark.read.json(str(tmp_path / "summary")).first()
    assert (got.active_sources_run, got.healthy_sources, got.sources[0].source_key) == (1, 1, "k")


def test_web_pages(spark):
    asked = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append(self.path)
            code = {"/gone": 404, "/busy": 503}.get(self.path, 200)
            if self.path == "/once" and asked.count("/once") == 1:
                code = 503
            self.send_response(code)
            self.send_header("Content-Type", "text/html; charset=utf-8")
            self.end_headers()
            self.wfile.write("<p>é</p>".encode())

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    readers.register_web_pages(spark)
    root = f"http://127.0.0.1:{server.server_port}"
    got = spark.read.format("web_pages").option("urls", "\n".join(root + p for p in ("/ok", "/once", "/gone", "/busy"))).option("delay", "0.01").option("partitions", "2").load().collect()
    asked_before = list(asked)
    column = spark.createDataFrame([(root + p,) for p in ("/ok", "/ok", "/gone")] + [("not a url",), (None,)], "u string")
    many = readers.fetch_pages(column, "u", partitions=2, delay=0.01).collect()
    assert sorted((r.url.removeprefix(root), r.status_code, r.html) for r in many) == [("/gone", 404, None), ("/ok", 200, "<p>é</p>"), ("not a url", None, None)]
    asked[:] = asked_before
    server.shutdown()
    assert {r.url.removeprefix(root): (r.status_code, r.html) for r in got} == {"/ok": (200, "<p>é</p>"), "/once": (200, "<p>é</p>"), "/gone": (404, None), "/busy": (503, None)}
    assert (asked.count("/gone"), asked.count("/busy"), asked.count("/once")) == (1, 3, 2)


def test_streams(spark, tmp_path):
    start = datetime(2026, 1, 1)
    rows = [("u", start + timedelta(hours=h), x) for h, x in ((0, "a"), (3, "a"), (6, "b"), (8, "b"), (13, "a"))]
    schema = "k string, t timestamp, content_hash string"
    source = str(tmp_path / "in")
    spark.createDataFrame(rows[:3], schema).coalesce(1).write.parquet(source)

    gate, versions = sightings.gate_each(str(tmp_path / "gate"), "k", "t"), sightings.versions_each(str(tmp_path / "versions"), "k", "t")

    def drain(each, name, schema_of):
        stream = spark.readStream.schema(schema).parquet(source)
        stream.writeStream.foreachBatch(each).option("checkpointLocation", str(tmp_path / f"{name}-progress")).trigger(availableNow=True).start().awaitTermination(120)
        return spark.read.schema(schema_of).parquet(str(tmp_path / name / "out")).collect()

    drain(gate, "gate", sightings.FETCHED)
    drain(versions, "versions", sightings.VERSIONED)
    # the streams go on where they ended, from their stored state
    spark.createDataFrame(rows[3:] + [(None, start, "x"), ("v", None, "x"), ("w", start, "y")], schema).coalesce(1).write.mode("append").parquet(source)
    got = drain(gate, "gate", sightings.FETCHED)
    assert sorted((r["key"], r["at"].hour, r.fetched) for r in got) == [("u", 0, True), ("u", 3, False), ("u", 6, True), ("u", 8, False), ("u", 13, True), ("w", 0, True)]
    numbers = drain(versions, "versions", sightings.VERSIONED)
    assert sorted((r["key"], r["at"].hour, r.status, r.version_number) for r in numbers) == [("u", 0, "NEW", 1), ("u", 3, "UNCHANGED", 1), ("u", 6, "CHANGED", 2), ("u", 8, "UNCHANGED", 2), ("u", 13, "CHANGED", 3), ("w", 0, "NEW", 1)]
    held = spark.read.schema(sightings.HELD).parquet(str(tmp_path / "versions" / "state-1")).collect()
    assert sorted((r["key"], r.hash_before, r.version_before) for r in held) == [("u", "a", 3), ("w", "y", 1)]
    # a batch that comes again after a failure gives its rows once more
    versions(spark.createDataFrame(rows[3:], schema), 1)
    again = spark.read.schema(sightings.VERSIONED).parquet(str(tmp_path / "versions" / "out")).where("key = 'u'").collect()
    assert sorted((r["at"].hour, r.version_number) for r in again) == [(0, 1), (3, 1), (6, 2), (8, 2), (13, 3)]


def test_gate_of_batches(spark, tmp_path):
    start = datetime(2026, 1, 1)
    batches = [
        [("u", start), ("u", start + timedelta(hours=5)), ("v", start), (None, start), ("w", None)],
        [("u", start + timedelta(hours=6)), ("u", start + timedelta(hours=6)), ("u", start + timedelta(hours=-1))],
        [],
        [("v", start + timedelta(hours=5)), ("u", start + timedelta(hours=11)), ("u", start + timedelta(hours=12)), ("x", start)],
    ]
    each = sightings.gate_each(str(tmp_path), "k", "t")
    want, last = [], {}
    for number, rows in enumerate(batches):
        for _ in range(2):
            each(spark.createDataFrame(rows, "k string, t timestamp"), number)
        for k, t in sorted((r for r in rows if None not in r)):
            go = k not in last or t - last[k] >= timedelta(hours=6)
            last[k] = t if go else last[k]
            want.append((k, t, go, number))
    got = spark.read.schema(sightings.FETCHED).parquet(str(tmp_path / "out"))
    assert sorted(tuple(r) for r in got.select("key", "at", "fetched", "batch").collect()) == sorted(want)


def test_stream_of_a_table_in_several_files(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(5).write.parquet(str(tmp_path / "events.parquet"))
    assert len(list((tmp_path / "events.parquet").glob("part-*.parquet"))) == 5
    got = sorted(tuple(r) for r in history.stream_fetch_gate(spark, str(tmp_path)).collect())
    want = history.recheck_chain(spark, str(tmp_path)).select("user_id", "fetches", "sightings")
    assert got and got == sorted(tuple(r) for r in want.collect())
