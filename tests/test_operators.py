"""Validation, gates, discovery, versions, selection and roll-ups on small tables."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from inkwell.operators import discovery, rollup, selection, validation, versions


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


ARTICLE = {"source_name": "s", "section_name": "t", "source_url": "https://a", "canonical_url": "http://a", "headline": "A headline of ten", "article_text": "text", "word_count": 150, "published_at": "2026-09-11", "author": "x", "content_hash": "h"}


@pytest.mark.parametrize(
    "change, errors, warnings",
    [
        ({}, [], []),
        ({"word_count": 79}, ["ARTICLE_TOO_SHORT:79"], []),
        ({"word_count": 80}, [], ["LOW_WORD_COUNT:80"]),
        ({"word_count": 149}, [], ["LOW_WORD_COUNT:149"]),
        ({"headline": "123456789"}, [], ["HEADLINE_UNUSUALLY_SHORT"]),
        ({"headline": " 1234567890 "}, [], []),
        ({"article_text": " Sign In "}, ["PAGE_UI_EXTRACTED_INSTEAD_OF_ARTICLE"], []),
        ({"article_text": "", "word_count": 0}, ["ARTICLE_TEXT_MISSING"], []),
        ({"source_url": "ftp://a", "canonical_url": None}, ["SOURCE_URL_INVALID", "CANONICAL_URL_MISSING"], []),
        (
            dict.fromkeys(ARTICLE),
            ["SOURCE_NAME_MISSING", "SOURCE_URL_MISSING", "CANONICAL_URL_MISSING", "HEADLINE_MISSING", "ARTICLE_TEXT_MISSING"],
            ["SECTION_NAME_MISSING", "PUBLISHED_DATE_MISSING", "AUTHOR_NOT_AVAILABLE", "CONTENT_HASH_MISSING"],
        ),
    ],
)
def test_validator(spark, change, errors, warnings):
    schema = ", ".join(f"{c} {'int' if c == 'word_count' else 'string'}" for c in ARTICLE)
    v = validation.validate(spark.createDataFrame([tuple((ARTICLE | change).values())], schema)).first().validation
    assert (v.valid, v.errors, v.warnings) == (not errors, errors, warnings)


NOW = datetime(2026, 9, 14, 12)


@pytest.mark.parametrize(
    "known, last, reason",
    [
        (None, None, "NEW"), (True, None, "NEVER_FETCHED"), (True, "", "NEVER_FETCHED"), (True, "yesterday", "INVALID_FETCH_TIME"), (True, "2026-09-14T06:00:00", "RECHECK"),
        (True, "2026-09-14T06:00:00.001", "RECENTLY_FETCHED"), (True, "2026-09-14T11:30:00+05:30", "RECHECK"), (True, "2026-09-14T11:31:00+05:30", "RECENTLY_FETCHED"),
    ],
)
def test_fetch_gate(spark, known, last, reason):
    assert one(spark, validation.fetch_reason(F.lit(known).cast("boolean"), F.lit(last).cast("string"), F.lit(NOW))) == (reason,)


def test_gates_come_in_order(spark):
    day = F.lit(date(2026, 9, 14))
    gate = lambda d, valid: one(spark, validation.gate_outcome(F.lit(d).cast("date"), F.lit(valid), day))[0]
    assert [gate(None, False), gate(date(2026, 9, 10), False), gate(date(2026, 9, 11), False), gate(date(2026, 9, 11), True), gate(date(2026, 9, 15), True)] == ["MISSING_DATE", "WRONG_DATE", "INVALID", "ACCEPTED", "WRONG_DATE"]
    kind = lambda d, s: one(spark, validation.intake_status(F.lit(d).cast("date"), F.lit(s), day))[0]
    assert [kind(None, "CHANGED"), kind(None, "UNCHANGED"), kind(None, "NEW"), kind(date(2026, 9, 13), "NEW"), kind(date(2026, 9, 14), "NEW")] == ["UPDATED_ARTICLE", "EXISTING_ARTICLE", "NEW_DATE_UNKNOWN", "LATE_DISCOVERY", "NEW_TODAY"]


def test_first_wins_with_back_fill(spark):
    d = spark.createDataFrame([(2, "u", "later", None), (0, "u", "", None), (1, "u", "text", "x"), (3, "v", None, None)], "pos int, url string, headline string, excerpt string")
    got = {r.url: (r.pos, r.headline, r.excerpt) for r in discovery.first_wins(d, ["url"], ("headline", "excerpt")).collect()}
    assert got == {"u": (0, "text", "x"), "v": (3, None, None)}
    last = discovery.last_value_first_place(d.withColumn("page", F.col("pos") % 2), ["url"], ["headline"], ["page", "pos"]).collect()
    assert {r.url: (r.headline, r.page, r.pos) for r in last} == {"u": ("text", 0, 0), "v": (None, 1, 3)}


def test_pages_stop_after_an_older_item_or_a_gap(spark):
    rows = [("a", 1, "KEPT"), ("a", 2, "OLDER"), ("a", 2, "KEPT"), ("a", 3, "KEPT"), ("b", 1, "KEPT"), ("b", 3, "KEPT"), ("c", 2, "KEPT"), ("d", 6, "KEPT")]
    got = discovery.pages_read(spark.createDataFrame(rows, "s string, page int, listing_gate string"), ["s"]).collect()
    assert sorted((r.s, r.page, r.listing_gate) for r in got) == [("a", 1, "KEPT"), ("a", 2, "KEPT"), ("a", 2, "OLDER"), ("b", 1, "KEPT")]


def test_future_items_are_told_from_older_ones(spark):
    rows = [(None,), (date(2026, 9, 10),), (date(2026, 9, 11),), (date(2026, 9, 14),), (date(2026, 9, 15),)]
    d = spark.createDataFrame(rows, "hint date").withColumn("day", F.lit(date(2026, 9, 14)))
    assert [r.listing_gate for r in discovery.gate_listing(d, "hint", "day").collect()] == ["KEPT", "OLDER", "KEPT", "KEPT", "FUTURE"]
    assert discovery.gate_listing_strict(d, "hint", "day").count() == 2


def test_latest_record(spark):
    rows = [("a", 1, 5, "p"), ("a", 2, 1, "q"), ("a", 2, 3, "s"), ("a", 2, 3, "r"), ("b", None, None, "t")]
    got = versions.latest(spark.createDataFrame(rows, "k string, v int, m int, path string"), ["k"], "v", "m", "path").collect()
    assert sorted((r.k, r.path) for r in got) == [("a", "r"), ("b", "t")]


def test_changes_and_versions(spark):
    rows = [("u", t, h) for t, h in enumerate("aabba")]
    got = versions.with_changes(spark.createDataFrame(rows, "u string, t int, content_hash string"), "u", "t").orderBy("t").collect()
    assert [(r.status, r.version_number) for r in got] == [("NEW", 1), ("UNCHANGED", 1), ("CHANGED", 2), ("UNCHANGED", 2), ("CHANGED", 3)]


def test_state_update(spark):
    state = spark.createDataFrame([("u", "a", "t0", 1), ("v", "b", "t0", 2)], "url string, content_hash string, last_fetched_at string, version_number long")
    new = spark.createDataFrame([("u", "a", "t1"), ("v", "c", "t1"), ("w", "d", "t1")], "url string, content_hash string, last_fetched_at string")
    got = {r.url: (r.content_hash, r.last_fetched_at, r.version_number) for r in versions.update_after_fetch(state, new).collect()}
    assert got == {"u": ("a", "t1", 1), "v": ("c", "t1", 3), "w": ("d", "t1", 1)}


def test_fetch_chain_against_a_loop(spark):
    import random

    rng = random.Random(4)
    at = [(k, datetime(2026, 1, 1) + timedelta(minutes=rng.randrange(6000))) for k in (1, 2, 3) for _ in range(120)] + [(4, datetime(2026, 1, 1))] * 2
    got = versions.fetch_chain(spark.createDataFrame(at, "k int, t timestamp_ntz"), "k", "t", 6.0).collect()
    want, last = [], {}
    for k, t in sorted(at):
        go = k not in last or t - last[k] >= timedelta(hours=6)
        if go:
            last[k] = t
        want.append((k, t, go))
    assert sorted((r.k, r.t, r.fetched) for r in got) == sorted(want)


@pytest.mark.parametrize(
    "folder, published, run, target, method",
    [
        ("2026-09-14", "2026-09-11T10:00:00+05:30", "2026-09-14", "2026-09-14", None),
        ("2026-09-14", "2026-09-11T10:00:00+05:30", "2026-09-14", "2026-09-11", "published_at"),
        ("2026-09-14", None, "2026-09-14", "2026-09-14", "collection_run_date_fallback"),
        ("2026-09-14", None, None, "2026-09-14", "path_date_fallback"),
        ("2026-09-14", "soon", "2026-09-13", "2026-09-14", "path_date_fallback"),
    ],
)
def test_target_date(spark, folder, published, run, target, method):
    c = [F.lit(x).cast("string") for x in (published, run, folder, target)]
    assert one(spark, selection.match_method(*c)) == (method,)


def test_annotations_survive_a_rerun(spark):
    given = spark.createDataFrame([(" https://example.com/a ", "OLD", "", 0), ("https://example.com/a", "RELEVANT", "checked by analyst", 1), ("", "X", "", 2)], "source_url string, human_label string, review_notes string, place int")
    review = spark.createDataFrame([("https://example.com/a", None, None), ("https://example.com/b", None, None)], "source_url string, human_label string, review_notes string")
    got = {r.source_url[-1]: (r.human_label, r.review_notes) for r in selection.merge_annotations(review, selection.last_annotations(given, "place")).collect()}
    assert got == {"a": ("RELEVANT", "checked by analyst"), "b": ("", "")}


def test_rollup_labels(spark):
    status = lambda *n: one(spark, rollup.content_status(*map(F.lit, n)))[0]
    assert [status(1, 0, 1, 1, 1, 1), status(0, 1, 0, 0, 0, 1), status(0, 0, 1, 1, 1, 1), status(0, 0, 0, 1, 1, 1), status(0, 0, 0, 0, 1, 1), status(0, 0, 0, 0, 0, 0), status(0, 0, 0, 0, 0, 1)] == [
        "NEW_ARTICLES_FOUND", "NEW_ARTICLES_FOUND", "ARTICLES_CHANGED", "ARTICLE_FETCH_FAILURES", "ARTICLE_EXTRACTION_FAILURES", "NO_CURRENT_UPDATE", "NO_NEW_ARTICLES",
    ]
    outcome = lambda code, failed: one(spark, rollup.job_outcome(F.lit(code).cast("int"), F.lit(failed).cast("boolean")))[0]
    assert [outcome(None, None), outcome(2, None), outcome(0, True), outcome(0, False)] == ["EXECUTION_ERROR", "FAILED", "COLLECTION_SUCCESS_INTELLIGENCE_FAILED", "SUCCESS"]
    assert [one(spark, rollup.scoring_outcome(F.lit(c).cast("int")))[0] for c in (0, 1, None)] == ["SUCCESS", "FAILED", "EXECUTION_ERROR"]
    assert one(spark, rollup.job_outcome(F.lit(0), F.lit(False), F.lit(False)), rollup.scoring_outcome(F.lit(0), F.lit(False))) == ("COLLECTION_SCRIPT_MISSING", "INTELLIGENCE_SCRIPT_MISSING")


def test_diagnosis(spark):
    sections = spark.createDataFrame([("a", True), ("b", True), ("c", False), ("d", True)], "source_code string, section_fetched boolean")
    links = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3")], "source_code string, url string")
    tests = spark.createDataFrame([("a", None, True, True), ("a", "2026-09-14", False, False), ("b", "2026-09-14", False, False)], "source_code string, published_at string, valid boolean, used_browser boolean")
    got = {r.source_code: (r.candidate_links_found, r.tested_articles, r.successful_articles, r.notes, r.verdict) for r in rollup.diagnose(sections, links, tests).collect()}
    assert got == {
        "a": (2, 2, 1, ["BROWSER_FALLBACK_REQUIRED_OR_USED", "MISSING_PUBLICATION_DATE:1/2"], "PASS"),
        "b": (1, 1, 0, [], "SECTION OK / ARTICLE EXTRACTION NEEDS WORK"),
        "c": (0, 0, 0, ["SECTION_FETCH_FAILED"], "FAILED"),
        "d": (0, 0, 0, ["NO_ARTICLE_LINKS_DISCOVERED"], "SECTION OK / ARTICLE EXTRACTION NEEDS WORK"),
    }
    pages = spark.createDataFrame([(200, True), (403, True), (200, False), (None, None)], "status_code int, valid boolean")
    assert tuple(rollup.page_test_counts(pages).first()) == (1, 1, 2)
