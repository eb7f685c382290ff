"""Discovery of article links: anchors, patterns, windows, pages, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkwell.functions import dates, html, text, urls

# Path fragments and file endings that no article has.
EXCLUDED_FRAGMENTS = ["/category/", "/tag/", "/author/", "/page/", "/feed/", "/wp-content/", "/contact", "/privacy", "/terms", "/advert", "/login", "/register", "/search"]
EXCLUDED_ENDINGS = [".jpg", ".jpeg", ".png", ".gif", ".webp", ".svg", ".pdf", ".zip", ".mp4", ".mp3"]

# Path patterns of the three listings.
BY_NUMBER = r"(?i)^/financial-services/.+/\d+-\d+$"
BY_DATE = r"(?i)^/(\d{4})/(\d{2})/(\d{2})/([^/]+)/?$"
BY_DATE_AND_SECTION = r"(?i)^/(\d{4})/(\d{2})/(\d{2})/business/\d+/.+$"

LEAST_HEADLINE, MOST_LINKS, TESTED, TESTED_OF_LISTING = 8, 50, 3, 5


def looks_like_article(url: Column, domain: str, section_url: str, preferred: tuple[str, ...] = ()) -> Column:
    """On the domain, not excluded, not the section itself; a preferred token or two path parts."""
    p = F.lower(urls.path(url))
    excluded = F.exists(text.literals(EXCLUDED_FRAGMENTS), lambda f: F.contains(p, f)) | F.exists(text.literals(EXCLUDED_ENDINGS), lambda e: F.endswith(p, e))
    wanted = F.exists(text.literals([t.lower() for t in preferred]), lambda t: F.contains(p, t)) if preferred else F.lit(False)
    deep = F.size(F.filter(F.split(p, "/"), lambda x: x != "")) >= 2
    return urls.domain_matches(url, domain) & ~p.isin("", "/") & ~excluded & (urls.normalize_url(url) != urls.normalize_url(F.lit(section_url))) & (wanted | deep)


def links(pages: DataFrame, base: Column, keys: list[str], markup: str = "html") -> DataFrame:
    """keys, pos, url, headline: every link of a page, resolved and normalised."""
    each = pages.select(*keys, base.alias("_base"), F.posexplode(html.anchors(F.col(markup))).alias("pos", "_a"))
    return each.select(*keys, F.col("pos").cast("long").alias("pos"), urls.normalize_url(urls.absolute_url(F.col("_base"), F.col("_a.href"))).alias("url"), F.col("_a.text").alias("headline"))


def first_wins(found: DataFrame, keys: list[str], fill: tuple[str, ...] = ("headline",), order: str = "pos", *more: Column) -> DataFrame:
    """One row a key at its first place; empty values of `fill` come from later ones; more: further aggregates."""
    filled = [F.min_by(F.col(c), F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.col(order))).alias(c) for c in fill]
    return found.groupBy(*keys).agg(F.min(order).alias(order), *filled, *more)


def last_value_first_place(found: DataFrame, keys: list[str], values: list[str], order: list[str]) -> DataFrame:
    """One row a key: the values of the last page, the place of the first."""
    place = F.struct(*order)
    return found.groupBy(*keys).agg(F.max_by(F.struct(*values), place).alias("_v"), F.min(place).alias("_p")).select(*keys, "_v.*", "_p.*")


def first_k(found: DataFrame, by: list[str], order: list[str], k: int) -> DataFrame:
    """The first k rows of each group; Spark prunes within tasks before the shuffle."""
    return found.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(*order)).cast("long")).where(F.col("rank") <= k)


def candidates(found: DataFrame, by: list[str], order: list[str], most: int = MOST_LINKS) -> DataFrame:
    """The links that a section's test looks at: the first `most` in order."""
    return first_k(found, by, order, most)


def gate_listing(found: DataFrame, hint: str, day: str) -> DataFrame:
    """listing_gate: KEPT (no date, or in the window), OLDER or FUTURE."""
    h, d = F.col(hint), F.col(day)
    return found.withColumn("listing_gate", F.when(h.isNull() | dates.in_window(h, d), "KEPT").when(h < dates.window_start(d), "OLDER").otherwise("FUTURE"))


def gate_listing_strict(found: DataFrame, hint: str, day: str) -> DataFrame:
    return found.where(dates.in_window(F.col(hint), F.col(day)))


def pages_read(found: DataFrame, by: list[str], page: str = "page", gate: str = "listing_gate", most: int = 5) -> DataFrame:
    """The rows of the pages that are read: none after an empty page or one with an older item.

    One row a page decides; its window sees `most` pages of a source.
    """
    per_page = found.where(F.col(page) <= most).groupBy(*by, page).agg(F.max((F.col(gate) == "OLDER").cast("int")).alias("_older"))
    before = W.partitionBy(*by).orderBy(page).rowsBetween(W.unboundedPreceding, -1)
    unbroken = F.col(page) == F.row_number().over(W.partitionBy(*by).orderBy(page))
    read = per_page.select(*by, page, (F.coalesce(F.max("_older").over(before), F.lit(0)) == 0).alias("_open"), unbroken.alias("_next")).where("_open and _next")
    return found.join(read.drop("_open", "_next"), [*by, page])
