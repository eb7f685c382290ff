"""Validation of article records, the gates after extraction, and fetch gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions import dates, text

# Texts of a page's controls that are no article, limits, and statuses of a blocked page.
CONTROL_TEXTS = ["subscribe now", "accept cookies", "enable javascript", "sign in", "log in"]
SHORT, LOW, SHORT_HEADLINE = 80, 150, 10
BLOCKED_STATUSES = [401, 403, 429]
RECHECK_HOURS = 6.0


def _missing(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def _bad_url(c: Column, name: str) -> Column:
    web = F.startswith(c, F.lit("http://")) | F.startswith(c, F.lit("https://"))
    return F.when(_missing(c), f"{name}_MISSING").when(~web, f"{name}_INVALID")


def errors(a: dict[str, Column]) -> Column:
    """Error codes of an article, in order; a holds its columns by name."""
    body, n = a["article_text"], a["word_count"]
    return F.array_compact(
        F.array(
            F.when(_missing(a["source_name"]), "SOURCE_NAME_MISSING"),
            _bad_url(a["source_url"], "SOURCE_URL"),
            _bad_url(a["canonical_url"], "CANONICAL_URL"),
            F.when(_missing(a["headline"]), "HEADLINE_MISSING"),
            F.when(_missing(body), "ARTICLE_TEXT_MISSING").when(n < SHORT, F.concat(F.lit("ARTICLE_TOO_SHORT:"), n.cast("string"))),
            F.when(body.rlike(f"(?i)^{text.SPACE}*({'|'.join(CONTROL_TEXTS)}){text.SPACE}*$"), "PAGE_UI_EXTRACTED_INSTEAD_OF_ARTICLE"),
        )
    )


def warnings(a: dict[str, Column]) -> Column:
    body, n = a["article_text"], a["word_count"]
    return F.array_compact(
        F.array(
            F.when(_missing(a["section_name"]), "SECTION_NAME_MISSING"),
            F.when(~_missing(a["headline"]) & (F.length(text.stripped(a["headline"])) < SHORT_HEADLINE), "HEADLINE_UNUSUALLY_SHORT"),
            F.when(~_missing(body) & (n >= SHORT) & (n < LOW), F.concat(F.lit("LOW_WORD_COUNT:"), n.cast("string"))),
            F.when(_missing(a["published_at"]), "PUBLISHED_DATE_MISSING"),
            F.when(_missing(a["author"]), "AUTHOR_NOT_AVAILABLE"),
            F.when(_missing(a["content_hash"]), "CONTENT_HASH_MISSING"),
        )
    )


FIELDS = ["source_name", "section_name", "source_url", "canonical_url", "headline", "article_text", "word_count", "published_at", "author", "content_hash"]


def validate(articles: DataFrame) -> DataFrame:
    """articles with validation: struct(valid, errors, warnings)."""
    a = {c: F.col(c) for c in FIELDS}
    found = articles.withColumns({"_e": errors(a), "_w": warnings(a)})
    return found.withColumn("validation", F.struct((F.size("_e") == 0).alias("valid"), F.col("_e").alias("errors"), F.col("_w").alias("warnings"))).drop("_e", "_w")


def gate_outcome(published: Column, valid: Column, day: Column) -> Column:
    """The first gate that an extracted article fails, else ACCEPTED."""
    return F.when(published.isNull(), "MISSING_DATE").when(~dates.in_window(published, day), "WRONG_DATE").when(~valid, "INVALID").otherwise("ACCEPTED")


def fetch_reason(known: Column, last_fetched: Column, now: Column, hours: float = RECHECK_HOURS) -> Column:
    """Why a candidate is fetched, or RECENTLY_FETCHED; last_fetched is an ISO string, naive as UTC."""
    then = F.when(last_fetched.rlike(r"^\d{4}-\d{2}-\d{2}"), last_fetched).try_cast("timestamp")
    return (
        F.when(~F.coalesce(known, F.lit(False)), "NEW")
        .when(_missing(last_fetched), "NEVER_FETCHED")
        .when(then.isNull(), "INVALID_FETCH_TIME")
        .when(dates.age_hours(now, then) >= hours, "RECHECK")
        .otherwise("RECENTLY_FETCHED")
    )


def is_blocked(status: Column) -> Column:
    return status.isin(BLOCKED_STATUSES)


def intake_status(published: Column, status: Column, day: Column) -> Column:
    return (
        F.when(status == "CHANGED", "UPDATED_ARTICLE")
        .when(status == "UNCHANGED", "EXISTING_ARTICLE")
        .when(published.isNull(), "NEW_DATE_UNKNOWN")
        .when(dates.is_late(published, day), "LATE_DISCOVERY")
        .otherwise("NEW_TODAY")
    )


def fetched_or_fallback(pages: DataFrame, rendered: DataFrame, key: str = "url", least: int = 2000) -> DataFrame:
    """Plain pages of `least` characters and more; else the rendered page of the same key."""
    b = rendered.select(F.col(key), F.col("html").alias("_html"), F.col("status_code").alias("_status"))
    enough = F.length(F.coalesce("html", F.lit(""))) >= least
    return pages.join(b, key, "full").select(
        key,
        F.when(enough, F.col("html")).otherwise(F.col("_html")).alias("html"),
        F.when(enough, F.col("status_code")).otherwise(F.col("_status")).alias("status_code"),
        F.when(enough, "httpx").otherwise("playwright").alias("fetch_method"),
        (~enough).alias("used_browser"),
    )
