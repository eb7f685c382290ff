"""Queries over documents as articles: hashes, duplicates, bodies, validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions import text
from inkwell.operators import discovery, validation
from inkwell.session import table


def articles(spark, sf_dir: str, hashed: bool = True) -> DataFrame:
    """documents in the shape of extracted articles: the first line is the headline. Without `hashed` the hash only says that there is one."""
    d = table(spark, sf_dir, "documents")
    url = F.concat(F.when(F.col("doc_id") % 17 == 0, "ftp://").otherwise("https://"), F.col("source"), F.lit(".example/"), F.col("doc_id"))
    return d.select(
        "doc_id",
        F.col("source").alias("source_name"),
        F.when(F.col("doc_id") % 11 != 0, F.col("lang")).alias("section_name"),
        F.when(F.col("doc_id") % 13 != 0, url).alias("source_url"),
        url.alias("canonical_url"),
        F.substring_index("text", "\n", 1).alias("headline"),
        F.col("text").alias("article_text"),
        text.word_count(F.col("text")).alias("word_count"),
        F.when(F.col("doc_id") % 7 != 0, "2026-09-11").alias("published_at"),
        F.when(F.col("doc_id") % 5 == 0, "staff").alias("author"),
        (text.content_hash(F.col("text")) if hashed else F.lit("-")).alias("content_hash"),
    )


_ARTICLES = r"""a AS (
  SELECT doc_id, source AS source_name, CASE WHEN doc_id % 11 <> 0 THEN lang END AS section_name,
         CASE WHEN doc_id % 13 <> 0 THEN CASE WHEN doc_id % 17 = 0 THEN 'ftp://' ELSE 'https://' END || source || '.example/' || doc_id END AS source_url,
         CASE WHEN doc_id % 17 = 0 THEN 'ftp://' ELSE 'https://' END || source || '.example/' || doc_id AS canonical_url,
         split_part(text, chr(10), 1) AS headline, text AS article_text,
         len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))::BIGINT AS word_count,
         CASE WHEN doc_id % 7 <> 0 THEN '2026-09-11' END AS published_at, CASE WHEN doc_id % 5 = 0 THEN 'staff' END AS author
  FROM documents)"""

_VALIDATED = (
    "WITH "
    + _ARTICLES
    + r""",
e AS (
  SELECT *, list_filter([
      CASE WHEN source_url IS NULL THEN 'SOURCE_URL_MISSING' WHEN source_url NOT LIKE 'http://%' AND source_url NOT LIKE 'https://%' THEN 'SOURCE_URL_INVALID' END,
      CASE WHEN canonical_url NOT LIKE 'http://%' AND canonical_url NOT LIKE 'https://%' THEN 'CANONICAL_URL_INVALID' END,
      CASE WHEN headline = '' THEN 'HEADLINE_MISSING' END,
      CASE WHEN article_text = '' THEN 'ARTICLE_TEXT_MISSING' WHEN word_count < 80 THEN 'ARTICLE_TOO_SHORT:' || word_count END,
      CASE WHEN lower(trim(article_text)) IN ('subscribe now', 'accept cookies', 'enable javascript', 'sign in', 'log in') THEN 'PAGE_UI_EXTRACTED_INSTEAD_OF_ARTICLE' END
    ], lambda x: x IS NOT NULL) AS errors,
    list_filter([
      CASE WHEN section_name IS NULL THEN 'SECTION_NAME_MISSING' END,
      CASE WHEN headline <> '' AND length(trim(headline)) < 10 THEN 'HEADLINE_UNUSUALLY_SHORT' END,
      CASE WHEN article_text <> '' AND word_count BETWEEN 80 AND 149 THEN 'LOW_WORD_COUNT:' || word_count END,
      CASE WHEN published_at IS NULL THEN 'PUBLISHED_DATE_MISSING' END,
      CASE WHEN author IS NULL THEN 'AUTHOR_NOT_AVAILABLE' END
    ], lambda x: x IS NOT NULL) AS warnings
  FROM a)"""
)


def content_hash(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.content_hash(F.col("text")).alias("content_hash"))


def dedup_first_wins(spark, sf_dir):
    hashed = table(spark, sf_dir, "documents").select(text.content_hash(F.col("text")).alias("content_hash"), "doc_id", "source", "lang")
    return discovery.first_wins(hashed, ["content_hash"], ("source", "lang"), "doc_id", F.count(F.lit(1)).alias("copies"))


def body_normalize_words(spark, sf_dir):
    body = text.normalize_body(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", text.word_count(F.col("text")).alias("word_count"), F.sha2(body, 256).alias("body_sha256"))


def text_normalize(spark, sf_dir):
    form = text.matching_form(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.length(form).cast("long").alias("n_chars_normalized"), F.sha2(form, 256).alias("form_sha256"))


def source_slugs(spark, sf_dir):
    named = F.concat(F.lit(" The "), F.col("source"), F.lit(" -- "), F.col("lang"), F.lit("! "))
    return table(spark, sf_dir, "documents").select("doc_id", text.source_slug(named).alias("slug"), text.clean_headline(F.concat(F.substring_index("text", "\n", 1), F.lit("  |  Daily News"))).alias("headline"))


def validate_article(spark, sf_dir):
    v = validation.validate(articles(spark, sf_dir, hashed=False))
    return v.select("doc_id", "validation.valid", F.array_join("validation.errors", ",").alias("errors"), F.array_join("validation.warnings", ",").alias("warnings"))


def validation_summary(spark, sf_dir):
    v = validation.validate(articles(spark, sf_dir, hashed=False)).select("source_name", "validation.*")
    return v.groupBy("source_name").agg(
        F.count(F.lit(1)).alias("tested"),
        F.count_if("valid").alias("valid_articles"),
        F.sum(F.size("errors")).alias("n_errors"),
        F.count_if(F.array_contains("warnings", "PUBLISHED_DATE_MISSING")).alias("missing_dates"),
    )


QUERIES = {f.__name__: f for f in (content_hash, dedup_first_wins, body_normalize_words, text_normalize, source_slugs, validate_article, validation_summary)}

ORACLES = {
    "content_hash": r"SELECT doc_id, sha256(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS content_hash FROM documents",
    "dedup_first_wins": r"""
SELECT sha256(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS content_hash, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source,
       arg_min(lang, doc_id) AS lang, count(*) AS copies
FROM documents GROUP BY 1""",
    "body_normalize_words": r"""
SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))::BIGINT AS word_count,
       sha256(coalesce(array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> ''), chr(10) || chr(10)), '')) AS body_sha256
FROM documents""",
    "text_normalize": r"""
WITH f AS (SELECT doc_id, trim(regexp_replace(regexp_replace(translate(lower(text), '’‘–—', '''''--'), '[^a-z0-9%+\-''. ]+', ' ', 'g'), ' +', ' ', 'g')) AS form FROM documents)
SELECT doc_id, length(form)::BIGINT AS n_chars_normalized, sha256(form) AS form_sha256 FROM f""",
    "source_slugs": r"""
SELECT doc_id, 'the_' || source || '_' || lang AS slug, trim(regexp_replace(split_part(text, chr(10), 1), '\s+', ' ', 'g')) AS headline FROM documents""",
    "validate_article": _VALIDATED + "\nSELECT doc_id, len(errors) = 0 AS valid, coalesce(array_to_string(errors, ','), '') AS errors, coalesce(array_to_string(warnings, ','), '') AS warnings FROM e",
    "validation_summary": _VALIDATED
    + """
SELECT source_name, count(*) AS tested, count(*) FILTER (len(errors) = 0) AS valid_articles, sum(len(errors))::BIGINT AS n_errors,
       count(*) FILTER (published_at IS NULL) AS missing_dates
FROM e GROUP BY source_name""",
}
