"""Writers: pages, staged articles, analyses, review files, state and statuses.

Spark's committer makes each write whole. Pages, staged articles, analyses and
the state are keyed tables (sources.keyed): a rerun takes the place of the rows
whose keys it writes and leaves all others.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inkwell.functions import text
from inkwell.sources import readers
from inkwell.sources.keyed import Keyed

# Columns of the review file, in order.
REVIEW_COLUMNS = [
    "source_name", "headline", "published_at", "source_url", "financial_score", "financial_label", "pr_score", "pr_label", "article_type_hint",
    "gate_decision", "institutions", "matched_financial_terms", "matched_pr_terms", "pr_counter_signals", "human_label", "review_notes", "analysis_file",
]


def _merged(rows: DataFrame, to: Keyed) -> None:
    """Merge rows into a keyed table; columns of the table that they lack are null."""
    lacks = [f for f in StructType.fromDDL(to.schema) if f.name not in rows.columns]
    to.merge(rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in lacks}))


def write_raw_pages(pages: DataFrame, path: str) -> None:
    """source, run_date, article_id, version_name, html: beside what other runs of the day stored."""
    _merged(pages, readers.raw_pages(path))


def write_staged(articles: DataFrame, path: str) -> None:
    """New versions of articles beside the old ones, each once however often it is staged; needs source and run_date."""
    _merged(articles, readers.staged(path))


def write_diagnosis(diagnosis: DataFrame, path: str, checked_at: str) -> None:
    """The rows of rollup.diagnose with the time of the check, beside earlier ones."""
    diagnosis.withColumn("checked_at", F.lit(checked_at)).write.mode("append").json(path)


def write_analyses(analyses: DataFrame, path: str) -> None:
    """One row an article of a run date, replaced on a rerun that names it; needs run_date, source_slug and article_id."""
    _merged(analyses, readers.analyses(path))


def review_rows(scored: DataFrame, analysis_file: Column, *more: str) -> DataFrame:
    """Scored articles with their labels in the review file's columns, lists as text; more: further columns after them."""
    said = {
        "institutions": text.list_text(F.col("institutions")),
        "matched_financial_terms": text.groups_text(F.col("matched_financial_terms")),
        "matched_pr_terms": text.groups_text(F.col("matched_pr_terms")),
        "pr_counter_signals": text.list_text(F.col("pr_counter_signals")),
        "analysis_file": analysis_file,
    }
    return scored.withColumns(said).select(*REVIEW_COLUMNS, *more)


def write_review(rows: DataFrame, path: str) -> None:
    """CSV files with a header; the first cell carries the byte-order mark that spreadsheets look for."""
    marked = rows.withColumnRenamed(rows.columns[0], "\ufeff" + rows.columns[0])
    marked.write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_state(touched: DataFrame, root: str) -> None:
    """Rows (STATE) of a run, one a URL, into the stored state: only the buckets that they fall in are written."""
    rows = touched.withColumn("bucket", readers.bucket(F.col("url")))
    buckets = [(r[0],) for r in rows.select("bucket").distinct().collect()]  # BUCKETS rows at most
    if buckets:
        readers.state(root).rebuild(touched.sparkSession, buckets, lambda held: held.select(*rows.columns).join(rows.select("url"), "url", "left_anti").unionByName(rows).repartition("bucket"))


def write_snapshot(state: DataFrame, root: str, run_id: str) -> str:
    """A whole state under its run's id; only when it is written it becomes the current one."""
    path = f"{root}/run={run_id}"
    state.write.mode("errorifexists").parquet(path)
    named = state.sparkSession.createDataFrame([(run_id,)], "run_id string").withColumn("at", F.current_timestamp())
    named.write.mode("append").json(f"{root}/_current")
    return path


def current_snapshot(spark: SparkSession, root: str) -> str | None:
    """The path of the last snapshot that was written whole, or None."""
    try:
        last = spark.read.schema("run_id string, at timestamp").json(f"{root}/_current").agg(F.max_by("run_id", "at")).first()[0]
    except AnalysisException:  # no such path
        return None
    return f"{root}/run={last}"


def write_statuses(statuses: DataFrame, path: str) -> None:
    """Append to the history of statuses."""
    statuses.withColumn("status_written_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")).write.mode("append").json(path)


def current_statuses(history: DataFrame) -> DataFrame:
    """The last status of each source."""
    rest = [c for c in history.columns if c != "source_key"]
    return history.groupBy("source_key").agg(F.max_by(F.struct(*rest), F.struct("status_written_at", "run_id")).alias("_s")).select("source_key", "_s.*")


def write_run_summary(summary: DataFrame, sources: DataFrame, path: str) -> None:
    """The roll-up of a run with its sources as a list; sources are few by nature (one row each)."""
    # both sides are one row
    listed = sources.agg(F.sort_array(F.collect_list(F.struct("source_key", *[c for c in sources.columns if c != "source_key"]))).alias("sources"))
    summary.join(listed).write.mode("append").json(path)
