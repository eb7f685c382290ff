"""Selection of records for a target date, available dates, and review labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions import dates, text

METHODS = ["published_at", "collection_run_date_fallback", "path_date_fallback"]


def match_method(published: Column, run_date: Column, folder_date: Column, target: Column) -> Column:
    """How a record matches the target date, or null.

    A valid publication date decides alone; the run date and the folder's date
    count only without one.
    """
    day = dates.article_date(published).cast("string")
    return F.when(day.isNotNull(), F.when(day == target, METHODS[0])).when(run_date == target, METHODS[1]).when(folder_date == target, METHODS[2])


def effective_date(published: Column, run_date: Column, folder_date: Column) -> Column:
    return F.coalesce(dates.article_date(published).cast("string"), F.when(run_date.rlike(r"^\d{4}-\d{2}-\d{2}$"), run_date), folder_date)


def match_counts(records: DataFrame, method: str = "method", by: list[str] | None = None) -> DataFrame:
    """Scanned and matched records, and matches by each method, zeros kept."""
    counts = [F.count_if(F.col(method) == m).alias(m) for m in METHODS]
    return records.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("scanned"), F.count(method).alias("matched"), *counts)


def available_dates(records: DataFrame, source: str, date: Column) -> DataFrame:
    return records.select(F.col(source), date.alias("date")).where("date is not null").groupBy(source, "date").agg(F.count(F.lit(1)).alias("records"))


def last_annotations(annotations: DataFrame, order: str) -> DataFrame:
    """source_url, human_label, review_notes: the last row of each URL."""
    url = text.stripped(F.col("source_url"))
    last = F.max_by(F.struct("human_label", "review_notes"), F.col(order))
    return annotations.where(url != "").groupBy(url.alias("source_url")).agg(last.alias("_a")).select("source_url", "_a.*")


def merge_annotations(review: DataFrame, annotations: DataFrame, key: str = "source_url") -> DataFrame:
    """review with the labels given before; empty strings where there are none."""
    kept = annotations.select(key, "human_label", "review_notes")
    merged = review.drop("human_label", "review_notes").join(kept, key, "left")
    return merged.withColumns({c: F.coalesce(c, F.lit("")) for c in ("human_label", "review_notes")})
