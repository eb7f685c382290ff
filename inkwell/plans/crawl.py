"""A crawl from section URLs: page k of all sources at once, and a run over all of them.

Round k fetches page k of every source that is still open, in parallel tasks.
A source is closed by a page without articles, by a page with an article older
than the window, by its most pages, and by a page that fails, which fails the
source. No page after that is asked for. The driver holds one row a source.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions import dates, urls
from inkwell.operators import discovery, rollup
from inkwell.plans import collection
from inkwell.plans.collection import LISTINGS, Listing
from inkwell.session import materialize
from inkwell.sources import readers, sinks

SECTION_PAGES = "source_key string, page int, url string, html string, error string"


def page_url(listing: Listing, page: Column) -> Column:
    """Page n of a source's section."""
    section = F.lit(listing.section or listing.base)
    if listing.paging == "offset":
        return urls.section_page_by_offset(section, page, listing.page_size)
    return urls.section_page_by_path(section, page)


def crawl(spark: SparkSession, listings: dict[str, Listing], run_day: str, fetch: Callable[[DataFrame], DataFrame] = readers.fetch_pages) -> DataFrame:
    """SECTION_PAGES: the section pages that a run reads, with the error of one that failed (html is null there).

    fetch: PAGE rows of a column url; readers.fetch_pages unless the pages come from elsewhere.
    """
    open_, read = dict(listings), []
    for k in range(1, max([x.most_pages for x in listings.values()], default=0) + 1):
        open_ = {key: x for key, x in open_.items() if k <= x.most_pages}
        if not open_:
            break
        one = spark.range(1)
        frontier = reduce(DataFrame.unionByName, [one.select(F.lit(key).alias("source_key"), F.lit(k).alias("page"), page_url(x, F.lit(k)).alias("url")) for key, x in open_.items()])
        frontier = materialize(frontier, "frontier")
        got = fetch(frontier).select("url", "html", "error")
        pages = materialize(frontier.join(got, "url", "left").select("source_key", "page", "url", "html", F.when(F.col("html").isNull(), F.coalesce("error", F.lit("no page"))).alias("error")), "section_pages")
        read.append(pages)
        if k < max(x.most_pages for x in open_.values()):
            still = {r["source_key"] for r in _goes_on(pages, open_, run_day).collect()}  # one row a source at most
            open_ = {key: x for key, x in open_.items() if key in still}
    return reduce(DataFrame.unionByName, read, spark.createDataFrame([], SECTION_PAGES))


def _goes_on(pages: DataFrame, listings: dict[str, Listing], run_day: str) -> DataFrame:
    """source_key of the sources whose page has articles, none of them older than the window."""
    found = []
    for key, listing in listings.items():
        links = collection.discover(pages.where((F.col("source_key") == key) & F.col("html").isNotNull()), listing)
        dated = links.select(dates.article_date(F.col("published_at_hint")).alias("hint"), F.lit(run_day).cast("date").alias("day"))
        counted = discovery.gate_listing(dated, "hint", "day").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.col("listing_gate") == "OLDER"), F.lit(False)).alias("older"))
        found.append(counted.where("n > 0 and not older").select(F.lit(key).alias("source_key")))
    return reduce(DataFrame.unionByName, found)


def run_registry(spark: SparkSession, registry: DataFrame, state_root: str, raw_path: str, staged_path: str, run_day: str, now: str, run_id: str, listings: dict[str, Listing] | None = None, fetch: Callable[[DataFrame], DataFrame] = readers.fetch_pages) -> DataFrame:
    """The status rows of a run over all active sources of a registry (sources.rules.REGISTRY).

    Each source has its state below state_root. A source without collector, with
    a section page that failed, or that raises, is a FAILED row; the others run.
    """
    listings = LISTINGS if listings is None else listings
    names = {r["source_key"]: r["name"] or r["source_key"] for r in rollup.active(registry).select("source_key", "name").collect()}  # the registry's rows
    mine = {key: listings[key] for key in names if key in listings}
    pages = crawl(spark, mine, run_day, fetch)
    failed = {r["source_key"]: r for r in pages.where("error is not null").select("source_key", "page", "url", "error").collect()}  # one a source

    def job(key: str) -> DataFrame:
        if key not in mine:
            raise NoCollector(f"no collector for {key}")
        if key in failed:
            raise RuntimeError(f"section page {failed[key]['page']} failed: {failed[key]['url']}: {failed[key]['error']}")
        own = pages.where(F.col("source_key") == key).select("page", "html")
        return collection.run_stored(spark, key, own, f"{state_root}/{key}", run_day, now, run_id, raw_path, staged_path, fetch=fetch, listing=mine[key])

    statuses = collection.run_sources(spark, {key: (lambda key=key: job(key)) for key in names}, run_id)
    missing = F.col("error_type") == NoCollector.__name__
    said = F.create_map(*[F.lit(x) for pair in names.items() for x in pair]) if names else F.lit(None)
    return statuses.withColumns({"content_status": F.when(missing, "NO_COLLECTOR_IMPLEMENTED").otherwise(F.col("content_status")), "source_name": said[F.col("source_key")] if names else said.cast("string")})


class NoCollector(RuntimeError):
    """An active source that no listing is known for."""


def write_run(statuses: DataFrame, statuses_path: str, summary_path: str) -> None:
    """The statuses beside earlier ones, and the run's summary with its sources."""
    held = materialize(statuses, "statuses")
    sinks.write_statuses(held, statuses_path)
    sinks.write_run_summary(rollup.run_summary(held), held, summary_path)
