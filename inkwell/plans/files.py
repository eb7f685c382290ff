"""Queries that write through the sinks to the shared folder and read back through the readers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inkwell.operators import rollup, selection, versions
from inkwell.plans.documents import articles
from inkwell.session import shared_dir, table
from inkwell.sources import readers, sinks


def _folder(spark) -> str:
    return f"{shared_dir(spark)}/inkwell/files-{uuid.uuid4().hex}"


def staged_round_trip(spark, sf_dir):
    """Articles staged as JSON, read with their validation and the source that the path names."""
    root = _folder(spark)
    a = articles(spark, sf_dir).withColumns({"article_version": (F.col("doc_id") % 3).cast("string"), "word_count": F.col("word_count").cast("int"), "source": F.lit("daily"), "run_date": F.lit("2026-09-14")})
    known = [f.name for f in StructType.fromDDL(readers.STAGED) if f.name in a.columns]
    sinks.write_staged(a.select("source", "run_date", *known), root)
    back = readers.read_staged(spark, root, ["source=daily"], one_a_file=False)
    return back.select("canonical_url", "source", "corrupt", F.sha2("article_text", 256).alias("text_sha256"), F.col("word_count").cast("long").alias("word_count"), "article_version")


def review_round_trip(spark, sf_dir):
    """Labels through a review file: the last one of each URL."""
    path = _folder(spark)
    given = table(spark, sf_dir, "labels").select(F.concat(F.lit("https://x/"), "doc_id").alias("source_url"), F.when(F.col("quality") == 1, 'RELEVANT, "so"').otherwise("NOT_RELEVANT").alias("human_label"), F.concat(F.lit("toxic\n"), F.col("toxic")).alias("review_notes"))
    rows = given.select(*[F.col(c) if c in given.columns else F.lit("").alias(c) for c in sinks.REVIEW_COLUMNS])
    sinks.write_review(rows, path)
    return selection.last_annotations(readers.read_annotations(spark, path), "place")


def state_round_trip(spark, sf_dir):
    """A state, what a run fetched, and the snapshot that becomes current."""
    root = _folder(spark)
    d = table(spark, sf_dir, "documents")
    url = F.concat(F.lit("https://x/"), F.col("doc_id"))
    before = d.where("doc_id % 3 <> 0").select(url.alias("url"), F.lit("h0").alias("content_hash"), F.lit("2026-09-13T08:00:00").alias("last_fetched_at"), F.lit(1).cast("long").alias("version_number"))
    fetched = d.where("doc_id % 2 = 0").select(url.alias("url"), F.when(F.col("doc_id") % 4 == 0, "h0").otherwise("h1").alias("content_hash"), F.lit("2026-09-14T08:00:00").alias("last_fetched_at"))
    sinks.write_snapshot(before, root, "r1")
    sinks.write_snapshot(versions.update_after_fetch(spark.read.parquet(sinks.current_snapshot(spark, root)), fetched), root, "r2")
    return readers.read_state(spark, sinks.current_snapshot(spark, root)).select("url", "content_hash", "last_fetched_at", "version_number")


def status_history(spark, sf_dir):
    """Two runs of nations as sources; the last status of each."""
    path = _folder(spark)
    n = table(spark, sf_dir, "nation")
    for run, kept in (("r1", "n_nationkey >= 0"), ("r2", "n_nationkey % 3 = 0")):
        sinks.write_statuses(n.where(kept).select(F.col("n_name").alias("source_key"), F.lit(run).alias("run_id"), F.lit("SUCCESS").alias("execution_status"), F.when(F.col("n_nationkey") % 2 == 0, "HEALTHY").otherwise("PARTIAL_ERROR").alias("health_status")), path)
    return sinks.current_statuses(readers.read_statuses(spark, path)).select("source_key", "run_id", "execution_status", "health_status")


def run_summary_file(spark, sf_dir):
    """The roll-up of a run beside the list of its sources."""
    path = _folder(spark)
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("source_key"), F.when(F.col("n_nationkey") % 5 == 0, "FAILED").otherwise("SUCCESS").alias("execution_status"), F.when(F.col("n_nationkey") % 2 == 0, "HEALTHY").otherwise("PARTIAL_ERROR").alias("health_status"))
    sinks.write_run_summary(rollup.run_summary(n), n, path)
    return spark.read.json(path).select(F.explode("sources").alias("s"), "active_sources_run", "successful_sources", "healthy_sources").select("s.source_key", "s.health_status", "active_sources_run", "successful_sources", "healthy_sources")


def analyses_files(spark, sf_dir):
    """Analyses by date and source; a rerun over a third of one source's articles replaces these alone."""
    path = _folder(spark)
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("article_id"), F.col("source").alias("source_slug"), F.lit("2026-09-14").alias("run_date"), F.substring_index("text", "\n", 1).alias("headline"), F.lit("1").alias("rules_version"))
    sinks.write_analyses(d, path)
    sinks.write_analyses(d.where("source_slug = 'src1' and article_id % 3 = 0").withColumn("rules_version", F.lit("2")), path)
    back = readers.analyses(path).read(spark, run_date="2026-09-14")
    return back.groupBy("source_slug", "rules_version").agg(F.count(F.lit(1)).alias("analyses"), F.sum(F.col("article_id").cast("long")).alias("ids"), F.sum(F.length("headline")).alias("headline_chars"))


def raw_pages_files(spark, sf_dir):
    path = _folder(spark)
    sinks.write_raw_pages(table(spark, sf_dir, "pages").select(F.lit("s").alias("source"), F.lit("2026-09-14").alias("run_date"), F.col("page_id").cast("string").alias("article_id"), F.lit("v001").alias("version_name"), "html"), path)
    return readers.raw_pages(path).read(spark).select(F.col("article_id").cast("long").alias("page_id"), "version_name", F.sha2("html", 256).alias("html_sha256"))


def diagnosis_file(spark, sf_dir):
    """Nations as sections: some could not be fetched, some have no links, some no valid article."""
    path = _folder(spark)
    k = F.col("n_nationkey")
    n = table(spark, sf_dir, "nation")
    code = F.col("n_name").alias("source_code")
    sections = n.select(code, (k % 5 != 4).alias("section_fetched"))
    candidates = n.where("n_nationkey % 5 <> 4 and n_nationkey % 3 <> 2").select(code, F.explode(F.sequence(F.lit(0), k.cast("int")).cast("array<string>")).alias("url"))
    tests = candidates.join(n.select(code, k.alias("k")), "source_code").where("url < '3'").select("source_code", F.when(F.col("k") % 2 == 0, "2026-09-14").alias("published_at"), (F.col("k") % 4 != 1).alias("valid"), (F.col("k") % 7 == 0).alias("used_browser"))
    sinks.write_diagnosis(rollup.diagnose(sections, candidates, tests), path, "2026-09-14T08:00:00")
    back = spark.read.schema("source_code string, section_fetched boolean, candidate_links_found long, tested_articles long, successful_articles long, browser_fallback_used boolean, notes array<string>, verdict string, checked_at string").json(path)
    return back.withColumn("notes", F.array_join("notes", ","))


QUERIES = {f.__name__: f for f in (staged_round_trip, review_round_trip, state_round_trip, status_history, run_summary_file, analyses_files, raw_pages_files, diagnosis_file)}

ORACLES = {
    "staged_round_trip": r"""
SELECT CASE WHEN doc_id % 17 = 0 THEN 'ftp://' ELSE 'https://' END || source || '.example/' || doc_id AS canonical_url, 'source=daily' AS source, false AS corrupt, sha256(text) AS text_sha256,
       len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))::BIGINT AS word_count, (doc_id % 3)::VARCHAR AS article_version
FROM documents""",
    "review_round_trip": """
SELECT 'https://x/' || doc_id AS source_url, CASE WHEN quality = 1 THEN 'RELEVANT, "so"' ELSE 'NOT_RELEVANT' END AS human_label, 'toxic' || chr(10) || toxic AS review_notes FROM labels""",
    "state_round_trip": """
SELECT 'https://x/' || doc_id AS url, CASE WHEN doc_id % 2 = 0 AND doc_id % 4 <> 0 THEN 'h1' ELSE 'h0' END AS content_hash,
       CASE WHEN doc_id % 2 = 0 THEN '2026-09-14T08:00:00' ELSE '2026-09-13T08:00:00' END AS last_fetched_at,
       ((doc_id % 3 <> 0)::INT + (doc_id % 2 = 0 AND (doc_id % 3 = 0 OR doc_id % 4 <> 0))::INT)::BIGINT AS version_number
FROM documents WHERE doc_id % 3 <> 0 OR doc_id % 2 = 0""",
    "status_history": """
SELECT n_name AS source_key, CASE WHEN n_nationkey % 3 = 0 THEN 'r2' ELSE 'r1' END AS run_id, 'SUCCESS' AS execution_status,
       CASE WHEN n_nationkey % 2 = 0 THEN 'HEALTHY' ELSE 'PARTIAL_ERROR' END AS health_status
FROM nation""",
    "run_summary_file": """
SELECT n_name AS source_key, CASE WHEN n_nationkey % 2 = 0 THEN 'HEALTHY' ELSE 'PARTIAL_ERROR' END AS health_status, count(*) OVER () AS active_sources_run,
       count(*) FILTER (n_nationkey % 5 <> 0) OVER () AS successful_sources, count(*) FILTER (n_nationkey % 2 = 0) OVER () AS healthy_sources
FROM nation""",
    "analyses_files": """
SELECT source AS source_slug, CASE WHEN source = 'src1' AND doc_id % 3 = 0 THEN '2' ELSE '1' END AS rules_version, count(*) AS analyses, sum(doc_id)::BIGINT AS ids,
       sum(length(split_part(text, chr(10), 1)))::BIGINT AS headline_chars
FROM documents GROUP BY 1, 2""",
    "raw_pages_files": "SELECT page_id, 'v001' AS version_name, sha256(html) AS html_sha256 FROM pages",
    "diagnosis_file": """
WITH s AS (
  SELECT n_name AS source_code, n_nationkey AS k, n_nationkey % 5 <> 4 AS f, CASE WHEN n_nationkey % 5 <> 4 AND n_nationkey % 3 <> 2 THEN n_nationkey + 1 ELSE 0 END AS links FROM nation),
t AS (
  SELECT *, CASE WHEN links = 0 THEN 0 ELSE (SELECT count(*) FROM range(0, k + 1) x(i) WHERE i::VARCHAR < '3') END AS n FROM s)
SELECT source_code, f AS section_fetched, links::BIGINT AS candidate_links_found, n::BIGINT AS tested_articles, CASE WHEN k % 4 <> 1 THEN n ELSE 0 END::BIGINT AS successful_articles,
       n > 0 AND k % 7 = 0 AS browser_fallback_used,
       CASE WHEN NOT f THEN 'SECTION_FETCH_FAILED' WHEN links = 0 THEN 'NO_ARTICLE_LINKS_DISCOVERED'
            ELSE array_to_string(list_filter([CASE WHEN k % 7 = 0 THEN 'BROWSER_FALLBACK_REQUIRED_OR_USED' END, CASE WHEN k % 2 <> 0 THEN 'MISSING_PUBLICATION_DATE:' || n || '/' || n END], lambda x: x IS NOT NULL), ',') END AS notes,
       CASE WHEN NOT f THEN 'FAILED' WHEN n > 0 AND k % 4 <> 1 THEN 'PASS' ELSE 'SECTION OK / ARTICLE EXTRACTION NEEDS WORK' END AS verdict,
       '2026-09-14T08:00:00' AS checked_at
FROM t""",
}
