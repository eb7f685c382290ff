"""Extraction of article records from fetched pages."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions import html, markup


def with_facts(pages: DataFrame, url: str = "url", markup_col: str = "html", *more: str, now: Column | None = None, known: Collection[str] | None = None) -> DataFrame:
    """pages with headline, subheadline, author, published_at and canonical_url.

    A page is read once; the JSON-LD items are shared by all fields. more:
    further parts of the page (markup.parsed) that become columns. now: what
    relative dates are relative to; without it they are none. known: the
    character references that are decoded (markup.decoder).
    """
    parts = pages.withColumn("_page", markup.parsed(F.col(markup_col), *html.PARTS, *more, known=known))
    parts = parts.withColumn("_items", html.json_items(F.col("_page.scripts")))
    p, i = F.col("_page"), F.col("_items")
    facts = {
        "headline": html.headline_of(p, i),
        "subheadline": html.subheadline_of(p, i),
        "author": html.author_of(p, i),
        "published_at": html.published_of(p, i, now),
        "canonical_url": html.canonical_of(p, i, F.col(url)),
    }
    return parts.withColumns(facts | {m: p[m] for m in more}).drop("_page", "_items")


def extract_articles(pages: DataFrame, source_name: str, section_name: str, retrieved_at: str | None = None) -> DataFrame:
    """Whole records of pages with url, final_url and html."""
    at = F.lit(retrieved_at).cast("timestamp") if retrieved_at else F.current_timestamp()
    found = with_facts(pages, "final_url", "html", "body", "words", "hash", now=at).withColumnRenamed("body", "article_text")
    now = F.lit(retrieved_at) if retrieved_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss+00:00")
    return found.select(
        F.lit(source_name).alias("source_name"),
        F.lit(section_name).alias("section_name"),
        F.col("url").alias("source_url"),
        "final_url",
        "canonical_url",
        "headline",
        "subheadline",
        "author",
        "published_at",
        "article_text",
        F.col("words").alias("word_count"),
        now.alias("retrieved_at"),
        F.col("hash").alias("content_hash"),
        F.lit("httpx").alias("fetch_method"),
    )
