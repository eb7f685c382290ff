"""Counters of a run, content and health labels, and the status of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.operators import validation

#: Counter by outcome of a candidate.
OUTCOMES = {
    "new_articles": "NEW",
    "late_discoveries": "LATE",
    "changed_articles": "CHANGED",
    "unchanged_articles": "UNCHANGED",
    "wrong_date_skipped": "WRONG_DATE",
    "missing_date": "MISSING_DATE",
    "invalid_extraction": "INVALID",
    "fetch_failures": "FETCH_FAILED",
    "recent_duplicates": "RECENTLY_FETCHED",
}


def source_counters(candidates: DataFrame, by: list[str], outcome: str = "outcome") -> DataFrame:
    """One row a source with all counters; a late discovery is new as well."""
    o = F.col(outcome)
    counts = {name: F.count_if(o == label) for name, label in OUTCOMES.items()}
    counts["new_articles"] = F.count_if(o.isin("NEW", "LATE"))
    return candidates.groupBy(*by).agg(F.count(F.lit(1)).alias("candidate_urls"), F.count_if(o != "RECENTLY_FETCHED").alias("articles_requiring_fetch"), *[c.alias(n) for n, c in counts.items()])


def content_status(new: Column, late: Column, changed: Column, failures: Column, invalid: Column, candidates: Column) -> Column:
    return (
        F.when((new > 0) | (late > 0), "NEW_ARTICLES_FOUND")
        .when(changed > 0, "ARTICLES_CHANGED")
        .when(failures > 0, "ARTICLE_FETCH_FAILURES")
        .when(invalid > 0, "ARTICLE_EXTRACTION_FAILURES")
        .when(candidates == 0, "NO_CURRENT_UPDATE")
        .otherwise("NO_NEW_ARTICLES")
    )


def health_status(failures: Column, invalid: Column, missing: Column) -> Column:
    return F.when((failures > 0) | (invalid > 0) | (missing > 0), "PARTIAL_ERROR").otherwise("HEALTHY")


def with_statuses(counters: DataFrame) -> DataFrame:
    c = F.col
    return counters.withColumns(
        {
            "content_status": content_status(c("new_articles"), c("late_discoveries"), c("changed_articles"), c("fetch_failures"), c("invalid_extraction"), c("candidate_urls")),
            "health_status": health_status(c("fetch_failures"), c("invalid_extraction"), c("missing_date")),
        }
    )


def active(registry: DataFrame) -> DataFrame:
    return registry.where(F.coalesce("enabled", F.lit(False)) & (F.upper(F.coalesce("production_status", F.lit(""))) == "ACTIVE"))


def run_statuses(registry: DataFrame, collectors: DataFrame, statuses: DataFrame, run_id: str) -> DataFrame:
    """The outcome of each source of a run.

    collectors: source_key, return_code (null: could not be started).
    statuses: source_key, run_id, execution_status, health_status, content_status.
    """
    c = collectors.select("source_key", F.lit(True).alias("_has"), "return_code")
    s = statuses.select("source_key", F.col("run_id").alias("_run"), "execution_status", "health_status", "content_status")
    joined = registry.select("source_key").join(c, "source_key", "left").join(s, "source_key", "left")
    failure = (
        F.when(F.col("_has").isNull(), "NO_COLLECTOR_IMPLEMENTED")
        .when(F.col("return_code").isNull(), "EXECUTION_ERROR")
        .when(F.col("_run").isNull(), "STATUS_FILE_MISSING")
        .when(F.col("_run") != run_id, "STATUS_RUN_ID_MISMATCH")
    )
    broken = failure.isNotNull() | (F.col("return_code") != 0)
    return joined.select(
        "source_key",
        "return_code",
        F.when(broken, "FAILED").otherwise(F.col("execution_status")).alias("execution_status"),
        F.when(broken, "FAILED").otherwise(F.col("health_status")).alias("health_status"),
        F.coalesce(failure, F.col("content_status")).alias("content_status"),
    )


def run_summary(statuses: DataFrame, by: list[str] | None = None) -> DataFrame:
    ok = F.count_if(F.col("execution_status") == "SUCCESS")
    return statuses.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("active_sources_run"),
        ok.alias("successful_sources"),
        (F.count(F.lit(1)) - ok).alias("failed_sources"),
        F.count_if(F.col("health_status") == "HEALTHY").alias("healthy_sources"),
        F.count_if(F.col("health_status") == "PARTIAL_ERROR").alias("partial_error_sources"),
    )


def job_outcome(collection_code: Column, any_stage_failed: Column, there: Column | None = None) -> Column:
    """Result of a scheduled run; the collection's code is null where it could not be started.

    there: whether the collection exists at all.
    """
    exists = F.lit(True) if there is None else there
    return (
        F.when(~exists, "COLLECTION_SCRIPT_MISSING")
        .when(collection_code.isNull(), "EXECUTION_ERROR")
        .when(collection_code != 0, "FAILED")
        .when(F.coalesce(any_stage_failed, F.lit(False)), "COLLECTION_SUCCESS_INTELLIGENCE_FAILED")
        .otherwise("SUCCESS")
    )


def scoring_outcome(code: Column, there: Column | None = None) -> Column:
    """Result of one date's scoring; the code is null where it could not be started."""
    exists = F.lit(True) if there is None else there
    return F.when(~exists, "INTELLIGENCE_SCRIPT_MISSING").when(code.isNull(), "EXECUTION_ERROR").when(code == 0, "SUCCESS").otherwise("FAILED")


def gate_counts(scored: DataFrame, by: list[str] | None = None) -> DataFrame:
    g = F.col("gate_decision")
    return scored.groupBy(*(by or [])).agg(
        F.count_if(g == "INCLUDE_CANDIDATE").alias("include"), F.count_if(g == "WATCH").alias("watch"), F.count_if(g == "EXCLUDE_NOISE").alias("exclude"), F.count_if(g.isNull()).alias("failed")
    )


def diagnostic_verdict(section_fetched: Column, successful: Column) -> Column:
    return F.when(section_fetched & (successful > 0), "PASS").when(section_fetched, "SECTION OK / ARTICLE EXTRACTION NEEDS WORK").otherwise("FAILED")


def diagnostic_rollup(tests: DataFrame, by: list[str]) -> DataFrame:
    """Tested articles of each source: how many are valid, whether a browser helped, notes, verdict."""
    missing, n = F.count_if(F.coalesce("published_at", F.lit("")) == ""), F.count(F.lit(1))
    ratio = F.concat(F.lit("MISSING_PUBLICATION_DATE:"), missing.cast("string"), F.lit("/"), n.cast("string"))
    valid = F.count_if(F.col("valid"))
    return tests.groupBy(*by).agg(
        n.alias("tested_articles"),
        valid.alias("successful_articles"),
        F.bool_or("used_browser").alias("browser_fallback_used"),
        F.array_compact(F.array(F.when(F.bool_or("used_browser"), "BROWSER_FALLBACK_REQUIRED_OR_USED"), F.when(missing > 0, ratio))).alias("notes"),
        diagnostic_verdict(F.lit(True), valid).alias("verdict"),
    )


def diagnose(sections: DataFrame, candidates: DataFrame, tests: DataFrame, by: str = "source_code") -> DataFrame:
    """Every section with its candidate links and tested articles; sections without either keep their row.

    sections: by, section_fetched. candidates: by, url. tests: as in diagnostic_rollup.
    """
    links = candidates.groupBy(by).agg(F.count(F.lit(1)).alias("candidate_links_found"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    joined = sections.join(links, by, "left").join(diagnostic_rollup(tests, [by]).drop("verdict"), by, "left")
    none = F.when(F.col("section_fetched") & (F.coalesce("candidate_links_found", F.lit(0)) == 0), F.array(F.lit("NO_ARTICLE_LINKS_DISCOVERED")))
    failed = F.when(~F.col("section_fetched"), F.array(F.lit("SECTION_FETCH_FAILED")))
    return joined.select(
        by,
        "section_fetched",
        zero("candidate_links_found"),
        zero("tested_articles"),
        zero("successful_articles"),
        F.coalesce("browser_fallback_used", F.lit(False)).alias("browser_fallback_used"),
        F.coalesce(failed, none, F.col("notes"), F.array().cast("array<string>")).alias("notes"),
        diagnostic_verdict(F.col("section_fetched"), F.coalesce("successful_articles", F.lit(0))).alias("verdict"),
    )


def page_test_counts(pages: DataFrame, status: str = "status_code", valid: str = "valid") -> DataFrame:
    """How many tested pages are valid, blocked, or neither."""
    blocked = F.coalesce(validation.is_blocked(F.col(status)), F.lit(False))
    good = ~blocked & F.coalesce(valid, F.lit(False))
    return pages.agg(F.count_if(good).alias("valid"), F.count_if(blocked).alias("blocked"), F.count_if(~good & ~blocked).alias("invalid"))
