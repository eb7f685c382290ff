"""Queries on runs: counters and labels of sources, statuses, access, diagnostics."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.functions import html
from inkwell.operators import rollup, validation
from inkwell.plans.documents import articles
from inkwell.session import table


def _outcomes(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id") % 23
    o = F.when(k < 9, "NEW").when(k < 11, "LATE").when(k < 13, "CHANGED").when(k < 16, "UNCHANGED").when(k == 16, "WRONG_DATE").when(k < 20, "RECENTLY_FETCHED")
    rare = F.when((F.col("doc_id") % 230 == 20) & (F.col("source") < "src2"), "MISSING_DATE").when(F.col("doc_id") % 460 == 21, "INVALID").when(F.col("doc_id") % 920 == 22, "FETCH_FAILED")
    return d.select(F.col("source").alias("source_name"), F.coalesce(o, rare, F.lit("UNCHANGED")).alias("outcome"))


def source_rollup(spark, sf_dir):
    return rollup.with_statuses(rollup.source_counters(_outcomes(spark, sf_dir), ["source_name"]))


def run_summary(spark, sf_dir):
    s = rollup.with_statuses(rollup.source_counters(_outcomes(spark, sf_dir), ["source_name"]))
    return rollup.run_summary(s.withColumn("execution_status", F.when(F.col("fetch_failures") > 0, "FAILED").otherwise("SUCCESS")))


def run_status_join(spark, sf_dir):
    """Nations as sources: some without collector, some without status, some of another run, some that failed."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    registry = n.select(F.col("n_name").alias("source_key"), (k % 11 != 10).alias("enabled"), F.when(k % 2 == 0, "Active").otherwise("ACTIVE").alias("production_status"))
    collectors = n.where("n_nationkey % 5 <> 0").select(F.col("n_name").alias("source_key"), F.when(k % 7 != 6, F.when(k % 6 == 1, 1).otherwise(0)).alias("return_code"))
    statuses = n.where("n_nationkey % 4 <> 1").select(
        F.col("n_name").alias("source_key"), F.when(k % 3 == 0, "old").otherwise("run-1").alias("run_id"), F.lit("SUCCESS").alias("execution_status"), F.lit("HEALTHY").alias("health_status"), F.lit("NO_NEW_ARTICLES").alias("content_status")
    )
    return rollup.run_statuses(rollup.active(registry), collectors, statuses, "run-1").withColumn("return_code", F.col("return_code").cast("string"))


def access_class(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    codes = F.element_at(F.array(*[F.lit(c) for c in (200, 301, 307, 403, 404, 429, 500, 401)]), (F.col("o_orderkey") % 8 + 1).cast("int"))
    c = o.select(codes.alias("status"))
    return c.groupBy(html.access_class(F.col("status")).alias("access"), validation.is_blocked(F.col("status")).alias("blocked")).agg(F.count(F.lit(1)).alias("pages"))


def job_outcome(spark, sf_dir):
    """Order statuses as scoring results of a run day: any failure marks the day."""
    o = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").cast("string").alias("run_day"), (F.col("o_orderstatus") != "F").alias("failed"), "o_orderkey")
    day = o.groupBy("run_day").agg(F.bool_or("failed").alias("any_failed"), (F.max("o_orderkey") % 5).alias("k"))
    code = F.when(F.col("k") != 4, F.when(F.col("k") == 3, 2).otherwise(0))
    return day.select("run_day", rollup.job_outcome(code, F.col("any_failed")).alias("result"))


def gate_outcomes(spark, sf_dir):
    a = validation.validate(articles(spark, sf_dir))
    published = F.when(F.col("doc_id") % 7 != 0, F.date_add(F.lit("2026-09-08").cast("date"), (F.col("doc_id") % 8).cast("int")))
    g = validation.gate_outcome(published, F.col("validation.valid"), F.lit("2026-09-14").cast("date"))
    return a.groupBy(g.alias("outcome")).agg(F.count(F.lit(1)).alias("articles"))


def diagnostic_rollup(spark, sf_dir):
    a = validation.validate(articles(spark, sf_dir))
    tests = a.select("source_name", "published_at", F.col("validation.valid").alias("valid"), (F.col("doc_id") % 40 == 1).alias("used_browser"))
    r = rollup.diagnostic_rollup(tests, ["source_name"])
    return r.withColumn("notes", F.array_join("notes", ","))


QUERIES = {f.__name__: f for f in (source_rollup, run_summary, run_status_join, access_class, job_outcome, gate_outcomes, diagnostic_rollup)}

_ROLLED = """o AS (
  SELECT source AS source_name, CASE WHEN doc_id % 23 < 9 THEN 'NEW' WHEN doc_id % 23 < 11 THEN 'LATE' WHEN doc_id % 23 < 13 THEN 'CHANGED' WHEN doc_id % 23 < 16 THEN 'UNCHANGED'
    WHEN doc_id % 23 = 16 THEN 'WRONG_DATE' WHEN doc_id % 23 < 20 THEN 'RECENTLY_FETCHED' WHEN doc_id % 230 = 20 AND source < 'src2' THEN 'MISSING_DATE'
    WHEN doc_id % 460 = 21 THEN 'INVALID' WHEN doc_id % 920 = 22 THEN 'FETCH_FAILED' ELSE 'UNCHANGED' END AS outcome
  FROM documents),
c AS (
  SELECT source_name, count(*) AS candidate_urls, count(*) FILTER (outcome <> 'RECENTLY_FETCHED') AS articles_requiring_fetch,
    count(*) FILTER (outcome IN ('NEW', 'LATE')) AS new_articles, count(*) FILTER (outcome = 'LATE') AS late_discoveries, count(*) FILTER (outcome = 'CHANGED') AS changed_articles,
    count(*) FILTER (outcome = 'UNCHANGED') AS unchanged_articles, count(*) FILTER (outcome = 'WRONG_DATE') AS wrong_date_skipped, count(*) FILTER (outcome = 'MISSING_DATE') AS missing_date,
    count(*) FILTER (outcome = 'INVALID') AS invalid_extraction, count(*) FILTER (outcome = 'FETCH_FAILED') AS fetch_failures, count(*) FILTER (outcome = 'RECENTLY_FETCHED') AS recent_duplicates
  FROM o GROUP BY source_name),
r AS (
  SELECT *, CASE WHEN new_articles > 0 OR late_discoveries > 0 THEN 'NEW_ARTICLES_FOUND' WHEN changed_articles > 0 THEN 'ARTICLES_CHANGED' WHEN fetch_failures > 0 THEN 'ARTICLE_FETCH_FAILURES'
    WHEN invalid_extraction > 0 THEN 'ARTICLE_EXTRACTION_FAILURES' WHEN candidate_urls = 0 THEN 'NO_CURRENT_UPDATE' ELSE 'NO_NEW_ARTICLES' END AS content_status,
    CASE WHEN fetch_failures > 0 OR invalid_extraction > 0 OR missing_date > 0 THEN 'PARTIAL_ERROR' ELSE 'HEALTHY' END AS health_status
  FROM c)"""

ORACLES = {
    "source_rollup": f"WITH {_ROLLED} SELECT * FROM r",
    "run_summary": f"""
WITH {_ROLLED} SELECT count(*) AS active_sources_run, count(*) FILTER (fetch_failures = 0) AS successful_sources, count(*) FILTER (fetch_failures > 0) AS failed_sources,
  count(*) FILTER (health_status = 'HEALTHY') AS healthy_sources, count(*) FILTER (health_status = 'PARTIAL_ERROR') AS partial_error_sources FROM r""",
    "run_status_join": """
WITH k AS (
  SELECT n_name AS source_key, n_nationkey % 5 <> 0 AS has, CASE WHEN n_nationkey % 5 <> 0 AND n_nationkey % 7 <> 6 THEN CASE WHEN n_nationkey % 6 = 1 THEN 1 ELSE 0 END END AS return_code,
         CASE WHEN n_nationkey % 4 <> 1 THEN CASE WHEN n_nationkey % 3 = 0 THEN 'old' ELSE 'run-1' END END AS run
  FROM nation WHERE n_nationkey % 11 <> 10),
f AS (
  SELECT *, CASE WHEN NOT has THEN 'NO_COLLECTOR_IMPLEMENTED' WHEN return_code IS NULL THEN 'EXECUTION_ERROR' WHEN run IS NULL THEN 'STATUS_FILE_MISSING' WHEN run <> 'run-1' THEN 'STATUS_RUN_ID_MISMATCH' END AS failure FROM k)
SELECT source_key, return_code::VARCHAR AS return_code, CASE WHEN failure IS NOT NULL OR return_code <> 0 THEN 'FAILED' ELSE 'SUCCESS' END AS execution_status,
       CASE WHEN failure IS NOT NULL OR return_code <> 0 THEN 'FAILED' ELSE 'HEALTHY' END AS health_status, coalesce(failure, 'NO_NEW_ARTICLES') AS content_status
FROM f""",
    "access_class": """
WITH c AS (SELECT [200, 301, 307, 403, 404, 429, 500, 401][o_orderkey % 8 + 1] AS s FROM orders)
SELECT CASE WHEN s = 200 THEN 'HTTP_ACCESS_OK' WHEN s = 403 THEN 'HTTP_ACCESS_BLOCKED' WHEN s BETWEEN 300 AND 399 THEN 'REDIRECT' ELSE 'HTTP_' || s END AS access,
       s IN (401, 403, 429) AS blocked, count(*) AS pages
FROM c GROUP BY ALL""",
    "job_outcome": """
WITH d AS (SELECT o_orderdate::DATE::VARCHAR AS run_day, bool_or(o_orderstatus <> 'F') AS f, max(o_orderkey) % 5 AS k FROM orders GROUP BY 1)
SELECT run_day, CASE WHEN k = 4 THEN 'EXECUTION_ERROR' WHEN k = 3 THEN 'FAILED' WHEN f THEN 'COLLECTION_SUCCESS_INTELLIGENCE_FAILED' ELSE 'SUCCESS' END AS result FROM d""",
    "gate_outcomes": r"""
WITH a AS (
  SELECT doc_id, CASE WHEN doc_id % 7 <> 0 THEN DATE '2026-09-08' + (doc_id % 8)::INTEGER END AS published,
    NOT (doc_id % 13 = 0 OR doc_id % 17 = 0 OR split_part(text, chr(10), 1) = '' OR text = '' OR len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) < 80) AS valid
  FROM documents)
SELECT CASE WHEN published IS NULL THEN 'MISSING_DATE' WHEN published NOT BETWEEN DATE '2026-09-11' AND DATE '2026-09-14' THEN 'WRONG_DATE' WHEN NOT valid THEN 'INVALID' ELSE 'ACCEPTED' END AS outcome,
       count(*) AS articles
FROM a GROUP BY 1""",
    "diagnostic_rollup": r"""
WITH a AS (
  SELECT source AS source_name, doc_id % 7 = 0 AS undated, doc_id % 40 = 1 AS used,
    NOT (doc_id % 13 = 0 OR doc_id % 17 = 0 OR split_part(text, chr(10), 1) = '' OR text = '' OR len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) < 80) AS valid
  FROM documents),
g AS (SELECT source_name, count(*) AS n, count(*) FILTER (valid) AS ok, bool_or(used) AS used, count(*) FILTER (undated) AS undated FROM a GROUP BY source_name)
SELECT source_name, n AS tested_articles, ok AS successful_articles, used AS browser_fallback_used,
       concat_ws(',', CASE WHEN used THEN 'BROWSER_FALLBACK_REQUIRED_OR_USED' END, CASE WHEN undated > 0 THEN 'MISSING_PUBLICATION_DATE:' || undated || '/' || n END) AS notes,
       CASE WHEN ok > 0 THEN 'PASS' ELSE 'SECTION OK / ARTICLE EXTRACTION NEEDS WORK' END AS verdict
FROM g""",
}
