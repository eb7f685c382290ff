"""The scoring job of one publication date: select, score, save, review."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions import text
from inkwell.operators import rollup, scoring, selection, versions
from inkwell.session import materialize
from inkwell.sources import readers, sinks
from inkwell.sources.rules import Rules


def select_articles(staged: DataFrame, target_date: str) -> DataFrame:
    """The latest matching version of every article for a date, with the method that matched.

    Names, versions and times alone are ranked; texts meet only the rows that
    won, which are few, so they neither sort nor move.
    """
    method = selection.match_method(F.col("published_at"), F.col("collection_run_date"), text.path_date(F.col("path")), F.lit(target_date))
    identity = text.article_identity(F.col("source"), F.col("canonical_url"), F.col("source_url"), F.col("path"))
    version = text.article_version(F.col("article_version"), F.col("path"))
    matched = staged.where("not corrupt").withColumns({"method": method, "identity": identity, "version": version}).where("method is not null")
    won = versions.latest(matched.select("identity", "version", "mtime", "path"), ["identity"], "version", "mtime", "path")
    return matched.join(materialize(won.select("identity", "version", "path"), "won"), ["identity", "version", "path"], "left_semi")


def run(spark, staged_root: str, sources: list[str], target_date: str, rules: Rules, analyses_path: str, review_path: str, one_a_file: bool = True) -> DataFrame:
    """Score a date's articles, keep human labels given before, write analyses and the review file.

    Returns the counts of the gate's decisions, failures included. A date
    without articles gives no files; see available_dates for those that have some.
    """
    if not is_date(target_date):
        raise ValueError(f"not a date: {target_date}")
    chosen = select_articles(readers.read_staged(spark, staged_root, sources, one_a_file), target_date)
    trimmed = chosen.withColumns({c: text.stripped(F.col(c)) for c in ("headline", "article_text", "source_url")})
    failure = scoring.required_fields_failure(F.col("headline"), F.col("article_text"), F.col("source_url"))
    scored = materialize(scoring.score(trimmed.withColumn("failure", failure), rules), "scored")
    good = scored.where("failure is null").withColumns(
        {
            "run_date": F.lit(target_date),
            "source_slug": text.source_slug(F.coalesce("source_name", "source")),
            "article_id": text.article_id_from_path(F.col("path"), F.col("content_hash"), sources),
            "processed_at": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss+00:00"),
        }
    )
    annotations = materialize(selection.last_annotations(readers.read_annotations(spark, review_path), "place"), "annotations")
    if good.isEmpty():
        return rollup.gate_counts(scored.withColumn("gate_decision", F.when(F.col("failure").isNull(), F.col("gate_decision"))))
    sinks.write_analyses(good.withColumnRenamed("path", "input_file"), analyses_path)
    empty = good.withColumns({"human_label": F.lit(None).cast("string"), "review_notes": F.lit(None).cast("string")})
    labelled = selection.merge_annotations(empty, annotations)
    file = F.concat(F.lit(f"{analyses_path}/run_date={target_date}/source_slug="), F.col("source_slug"), F.lit("/"), F.col("article_id"))
    sinks.write_review(sinks.review_rows(labelled, file, "path").orderBy("path").drop("path"), review_path)
    return rollup.gate_counts(scored.withColumn("gate_decision", F.when(F.col("failure").isNull(), F.col("gate_decision"))))


def is_date(target_date: str) -> bool:
    """dates.is_iso_date for a value of the driver."""
    try:
        return date.fromisoformat(target_date).isoformat() == target_date
    except ValueError:
        return False


def available_dates(staged: DataFrame) -> DataFrame:
    """How many staged records each source has for each date."""
    day = selection.effective_date(F.col("published_at"), F.col("collection_run_date"), text.path_date(F.col("path")))
    return selection.available_dates(staged.where("not corrupt"), "source", day)


def window_dates_of(day: str) -> list[str]:
    """The publication days that a scheduled run scores."""
    d = date.fromisoformat(day)
    back = 3 if d.weekday() == 0 else 1 if d.weekday() < 5 else 0
    return [(d - timedelta(days=k)).isoformat() for k in range(back, -1, -1)]

