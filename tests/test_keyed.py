"""Keyed tables: writes that come twice, break off, or meet; and the collection's files and state on them."""

import random
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from inkwell.plans import collection
from inkwell.sources import keyed, readers, sinks
from inkwell.sources.keyed import Keyed


def table(path, form="parquet"):
    return Keyed(str(path), "k string, v long", ("day", "source"), ("k",), form)


def rows(spark, values):
    return spark.createDataFrame([(k, v, d, s) for (k, d, s), v in values.items()], "k string, v long, day string, source string")


def held(t, spark, **where):
    got = t.read(spark, **where).collect()
    assert len({(r.k, r.day, r.source) for r in got}) == len(got)
    return {(r.k, r.day, r.source): r.v for r in got}


@pytest.mark.parametrize("form", ["parquet", "json"])
def test_merges_are_upserts(spark, tmp_path, form):
    t, want, rng = table(tmp_path, form), {}, random.Random(2)
    assert held(t, spark) == {}
    for step in range(6):
        new = {(f"k{rng.randrange(9)}", f"2026-09-1{rng.randrange(3)}", rng.choice(["a", "b/ =:é"])): 10 * step + i for i in range(5)}
        t.merge(rows(spark, new))
        want |= new
        assert held(t, spark) == want
    assert held(t, spark, day="2026-09-11") == {k: v for k, v in want.items() if k[1] == "2026-09-11"}
    assert held(t, spark, day=["2026-09-11", "2026-09-12"], source="a") == {k: v for k, v in want.items() if k[1] != "2026-09-10" and k[2] == "a"}
    t.merge(rows(spark, want).where("false"))
    assert held(t, spark) == want


def test_rebuilt_partitions_and_compaction(spark, tmp_path):
    t = table(tmp_path)
    first = {("x", "d1", "a"): 1, ("y", "d1", "a"): 2, ("x", "d2", "a"): 3}
    t.merge(rows(spark, first))
    t.merge(rows(spark, {("y", "d1", "a"): 5, ("z", "d2", "b"): 6}))
    t.rebuild(spark, [("d1", "a")], lambda old: old.withColumn("v", F.col("v") + 100).where("k = 'y'"))
    assert held(t, spark) == {("y", "d1", "a"): 105, ("x", "d2", "a"): 3, ("z", "d2", "b"): 6}
    t.merge(rows(spark, {("y", "d1", "a"): 7, ("x", "d2", "a"): 8}))
    want = {("y", "d1", "a"): 7, ("x", "d2", "a"): 8, ("z", "d2", "b"): 6}
    assert held(t, spark) == want
    t.compact(spark)
    assert held(t, spark) == want and t.read(spark).where("day = 'd2' and source = 'a'").select("w").distinct().count() == 1
    assert t.compact(spark, day="d9") is None
    t.merge(rows(spark, {("x", "d2", "a"): 9}))
    assert held(t, spark) == want | {("x", "d2", "a"): 9}
    t.rebuild(spark, [("d2", "a")], lambda old: old.where("false"))
    assert held(t, spark) == {("y", "d1", "a"): 7, ("z", "d2", "b"): 6}


def test_a_write_that_breaks_off_counts_for_nothing(spark, tmp_path, monkeypatch):
    t = table(tmp_path)
    t.merge(rows(spark, {("x", "d", "a"): 1}))

    def stop(*a):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(keyed, "_create", stop)
        with pytest.raises(RuntimeError):
            t.merge(rows(spark, {("x", "d", "a"): 2, ("y", "d", "a"): 2}))
    (tmp_path / "log" / "00000002.json").write_text("")  # its number was taken, its row never came
    assert held(t, spark) == {("x", "d", "a"): 1}
    t.merge(rows(spark, {("x", "d", "a"): 2, ("y", "d", "a"): 2}))
    assert held(t, spark) == {("x", "d", "a"): 2, ("y", "d", "a"): 2}


def test_writes_that_meet(spark, tmp_path):
    """Writers of one key and of others at once: nothing is lost, no key stands twice."""
    t, failed = table(tmp_path), []
    t.merge(rows(spark, {("hot", "d", "a"): -1}))

    def write(n):
        try:
            t.merge(rows(spark, {("hot", "d", "a"): n, (f"own{n}", "d", "a"): n}))
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    def add(n):
        try:
            t.rebuild(spark, [("d", "b")], lambda old: old.select("k", "v", "day", "source").unionByName(rows(spark, {(f"r{n}", "d", "b"): n})))
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=f, args=(n,)) for n in range(4) for f in (write, add)]
    for x in threads:
        x.start()
    for x in threads:
        x.join()
    assert not failed
    got = held(t, spark)
    assert {k[0] for k in got} == {"hot", *(f"own{n}" for n in range(4)), *(f"r{n}" for n in range(4))}


def test_state_writes_follow_the_touched_keys(spark, tmp_path):
    root = str(tmp_path)
    columns = [c.split()[0] for c in readers.STATE.split(", ")]
    state = lambda urls, v: spark.createDataFrame([(u, v) for u in urls], "url string, headline string").select(*[F.col(c) if c in ("url", "headline") else F.lit(None).cast("long" if c == "version_number" else "string").alias(c) for c in columns])
    everything = [f"https://x/{i}" for i in range(3000)]
    sinks.write_state(state(everything, "old"), root)
    size = lambda: sum(p.stat().st_size for p in Path(root, "data").rglob("*.parquet"))
    before = size()
    few = everything[:2] + ["https://x/new"]
    sinks.write_state(state(few, "now"), root)
    assert size() - before < before / 20
    asked = spark.createDataFrame([(u,) for u in few + ["https://x/unknown"]], "url string")
    mine = {r.url: r.headline for r in readers.state_of(spark, root, asked).collect() if r.url in {*few, "https://x/unknown"}}
    assert mine == dict.fromkeys(few, "now")
    plan = readers.state_of(spark, root, asked)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and readers.state_of(spark, root, asked).count() < 300
    whole = readers.state(root).read(spark)
    assert whole.count() == 3001 and whole.where("headline = 'now'").count() == 3


def page(canonical, words):
    return f"<link rel='canonical' href='{canonical}'><title>Article of the day</title><meta property='article:published_time' content='2026-09-14T08:00:00+05:30'><p>{' '.join(['word'] * 90)} {words}</p>"


def listing(spark, numbers):
    link = lambda n: f"<div><a href='/financial-services/Some-thing/42-{n}'>Number {n}</a><span>Monday, 14 September 2026</span></div>"
    return spark.createDataFrame([(1, "".join(map(link, numbers)))], "page int, html string")


BASE = "https://www.ft.lk/financial-services/Some-thing/42-"


def pages(spark, of):
    return spark.createDataFrame([(BASE + n, BASE + n, page(BASE + c, w)) for n, (c, w) in of.items()], "url string, final_url string, html string")


def stored(spark, tmp_path):
    raw = readers.raw_pages(str(tmp_path / "raw")).read(spark).collect()
    staged = readers.staged(str(tmp_path / "staged")).read(spark).collect()
    assert {(r.run_date, r.article_id, r.version_name) for r in raw} == {(r.run_date, readers_id(r.canonical_url), f"v{int(r.article_version):03}") for r in staged} and len(raw) == len(staged)
    state = {r.url.removeprefix(BASE): r.version_number for r in readers.state(str(tmp_path / "state")).read(spark).collect()}
    return sorted((r.canonical_url.removeprefix(BASE), r.article_version, r.collection_status, r.source_url.removeprefix(BASE)) for r in staged), state


def readers_id(url):
    import hashlib

    return hashlib.sha256(url.encode()).hexdigest()[:16]


def test_hourly_runs_keep_all_pages_and_number_versions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "BUCKETS", 4)
    paths = [str(tmp_path / p) for p in ("raw", "staged")]
    run = lambda numbers, of, now, k: collection.run_stored(spark, "daily_ft", listing(spark, numbers), str(tmp_path / "state"), "2026-09-14", now, k, *paths, pages(spark, of)).first()
    # two listings of page 1 in one run: the second is the next version; of page 4: unchanged
    of = {"1": ("1", "a"), "2": ("1", "b"), "3": ("3", "c"), "4": ("4", "d"), "5": ("4", "d")}
    row = run("12345", of, "2026-09-14T08:00:00", "r1")
    assert (row.new_articles, row.changed_articles, row.unchanged_articles) == (3, 1, 1)
    first = [("1", "1", "NEW", "1"), ("1", "2", "CHANGED", "2"), ("3", "1", "NEW", "3"), ("4", "1", "NEW", "4")]
    assert stored(spark, tmp_path) == (first, {"1": 2, "2": 0, "3": 1, "4": 1, "5": 0})
    # an hour later one new article: all earlier pages stay
    row = run("36", of | {"6": ("6", "e")}, "2026-09-14T09:00:00", "r2")
    assert (row.new_articles, row.recent_duplicates) == (1, 1)
    assert stored(spark, tmp_path) == (sorted([*first, ("6", "1", "NEW", "6")]), {"1": 2, "2": 0, "3": 1, "4": 1, "5": 0, "6": 1})

    # a run that breaks off between its files and its state, and comes again
    def lost(*a):
        raise RuntimeError("lost")

    changed = {"3": ("3", "changed"), "7": ("7", "f")}
    with monkeypatch.context() as m:
        m.setattr(sinks, "write_state", lost)
        with pytest.raises(RuntimeError):
            run("37", changed, "2026-09-14T16:00:00", "r3")
    row = run("37", changed, "2026-09-14T16:30:00", "r4")
    assert (row.new_articles, row.changed_articles) == (1, 1)
    last = sorted([*first, ("6", "1", "NEW", "6"), ("3", "2", "CHANGED", "3"), ("7", "1", "NEW", "7")])
    assert stored(spark, tmp_path) == (last, {"1": 2, "2": 0, "3": 2, "4": 1, "5": 0, "6": 1, "7": 1})
