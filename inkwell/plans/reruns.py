"""Queries of several collection runs over one state and one store."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from inkwell.functions import text
from inkwell.plans import collection
from inkwell.session import materialize, shared_dir, table
from inkwell.sources import readers

RUNS = ("2026-09-14T08:00:00", "2026-09-14T09:00:00", "2026-09-14T17:00:00")


def collection_runs(spark, sf_dir):
    """Three runs of a day over documents as pages: what is staged, and whether page and state agree with it.

    Two documents in a row are listings of one page, but every fifth is a page
    of its own. The first run is new, the second comes an hour later, and for
    the third every sixth text has changed.
    """
    root = f"{shared_dir(spark)}/inkwell/runs-{uuid.uuid4().hex}"
    k = F.col("doc_id")
    pair = F.floor(k / 2)
    url = F.concat(F.lit("https://x.lk/l/"), k)
    canonical = F.when(k % 5 == 0, url).otherwise(F.concat(F.lit("https://x.lk/c/"), pair))
    d = table(spark, sf_dir, "documents").select("doc_id", url.alias("url"), canonical.alias("canonical"), F.when(pair % 3 == 0, F.concat(F.repeat(F.lit("word "), F.lit(90)), pair)).otherwise(F.col("text")).alias("body"))
    candidates = d.select("url", F.concat(F.lit("Number "), k).alias("headline"), F.lit(1).alias("page"), k.alias("pos"))
    for run, now in enumerate(RUNS):
        body = F.when((k % 6 == 0) & F.lit(run == 2), F.concat("body", F.lit(" again"))).otherwise(F.col("body"))
        escaped = F.replace(F.replace(F.replace(body, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
        html = F.concat(F.lit("<link rel=canonical href='"), F.col("canonical"), F.lit("'><title>Article number "), k, F.lit("</title><meta property='article:published_time' content='2026-09-14T08:00:00+05:30'><p>"), escaped, F.lit("</p>"))
        pages = materialize(d.select("url", F.col("url").alias("final_url"), html.alias("html")), "pages")
        collection.collect_stored(candidates, pages, f"{root}/state", "x", "business", "2026-09-14", now, f"{root}/raw", f"{root}/staged")
    raw = readers.raw_pages(f"{root}/raw").read(spark, source="x").select("article_id", "version_name", F.lit(True).alias("raw"))
    state = readers.state(f"{root}/state").read(spark).select(F.col("url").alias("canonical_url"), F.col("version_number").alias("state_version"))
    staged = readers.staged(f"{root}/staged").read(spark, source="x", run_date="2026-09-14")
    version = F.col("article_version").cast("long")
    named = staged.withColumns({"version": version, "article_id": text.url_hash(F.col("canonical_url")), "version_name": text.version_name(version)})
    found = named.join(raw, ["article_id", "version_name"], "left").join(state, "canonical_url", "left")
    return found.select("source_url", "canonical_url", "version", "collection_status", "retrieved_at", F.col("word_count").cast("long").alias("word_count"), F.coalesce("raw", F.lit(False)).alias("page_stored"), "state_version")


QUERIES = {"collection_runs": collection_runs}

ORACLES = {
    "collection_runs": r"""
WITH d AS (
  SELECT doc_id, 'https://x.lk/l/' || doc_id AS url, CASE WHEN doc_id % 5 = 0 THEN 'https://x.lk/l/' || doc_id ELSE 'https://x.lk/c/' || doc_id // 2 END AS canonical,
         CASE WHEN doc_id // 2 % 3 = 0 THEN repeat('word ', 90) || doc_id // 2 ELSE text END AS body
  FROM documents),
r AS (
  SELECT d.*, run, CASE WHEN run = 2 AND doc_id % 6 = 0 THEN body || ' again' ELSE body END AS said FROM d, (VALUES (0), (1), (2)) x(run)),
w AS (SELECT *, list_filter(regexp_split_to_array(said, '\s+'), lambda x: x <> '') AS ws FROM r),
f AS (
  SELECT *, lag(ws) OVER seen AS held FROM w WHERE len(ws) >= 80 AND NOT (run = 1 AND doc_id % 5 = 0)
  WINDOW seen AS (PARTITION BY canonical ORDER BY run, doc_id)),
c AS (SELECT *, held IS NULL OR held <> ws AS changed FROM f),
v AS (
  SELECT *, sum(changed::INT) OVER (PARTITION BY canonical ORDER BY run, doc_id) AS version, sum(changed::INT) OVER (PARTITION BY canonical) AS last FROM c)
SELECT url AS source_url, canonical AS canonical_url, version::BIGINT AS version, CASE WHEN held IS NULL THEN 'NEW' ELSE 'CHANGED' END AS collection_status,
       CASE run WHEN 0 THEN '2026-09-14T08:00:00' WHEN 1 THEN '2026-09-14T09:00:00' ELSE '2026-09-14T17:00:00' END AS retrieved_at, len(ws)::BIGINT AS word_count,
       true AS page_stored, last::BIGINT AS state_version
FROM v WHERE changed""",
}
