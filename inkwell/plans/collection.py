"""One collection run of a source over pages that are already fetched."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inkwell.functions import dates, html, text, urls
from inkwell.operators import discovery, extraction, rollup, validation, versions
from inkwell.session import materialize
from inkwell.sources import readers, sinks


@dataclass(frozen=True)
class Listing:
    """How a source's section pages list articles."""

    base: str
    domain: str
    pattern: str
    links: str = "dates"  # dates, excerpts or cards near a link
    least_headline: int = 0
    date_in_path: bool = False
    most_pages: int = 5
    section: str = ""  # the first section page; else base
    paging: str = "path"  # path or offset
    page_size: int = 30


# The listings of the three kinds of section page.
LISTINGS = {
    "daily_ft": Listing("https://www.ft.lk", "ft.lk", discovery.BY_NUMBER, section="https://www.ft.lk/financial-services/42", paging="offset"),
    "ceylon_today": Listing("https://ceylontoday.lk/category/ceylon-today-daily/finance-today/", "ceylontoday.lk", discovery.BY_DATE, "excerpts", 8, True, 4),
    "daily_news": Listing("https://dailynews.lk/category/business/", "dailynews.lk", discovery.BY_DATE_AND_SECTION, "cards", 8, True, 1),
}
_NEAR = {"dates": html.links_with_dates, "excerpts": html.links_with_excerpts, "cards": html.links_with_cards}


def discover(section_pages: DataFrame, listing: Listing, now: str | None = None) -> DataFrame:
    """page, pos, url, headline, published_at_hint, excerpt: the article links of section pages (page, html); now: as in dates.parse_date."""
    each = section_pages.select("page", F.posexplode(_NEAR[listing.links](F.col("html"))).alias("pos", "l"))
    url = urls.normalize_url(urls.absolute_url(F.lit(listing.base), F.col("l.href")))
    found = each.select("page", F.col("pos").cast("long").alias("pos"), url.alias("url"), text.collapse(F.col("l.text")).alias("headline"), F.col("l.date").alias("near"), "l.excerpt")
    kept = found.where(urls.domain_matches(F.col("url"), listing.domain) & urls.path(F.col("url")).rlike(listing.pattern) & (F.length("headline") >= listing.least_headline))
    hint = dates.parse_date(F.col("near"), F.lit(now).cast("timestamp") if now else None)
    if listing.date_in_path:
        in_path = dates.hint_from_path(urls.path(F.col("url")))
        hint = in_path if listing.links == "excerpts" else F.coalesce(hint, in_path)
    dated = kept.withColumn("published_at_hint", hint).drop("near")
    return discovery.first_wins(dated, ["page", "url"], ("headline", "published_at_hint", "excerpt"))


def required(found: DataFrame, listing: Listing, run_day: str) -> DataFrame:
    """The candidates of a run day: pages until an older item, future items dropped, one row a URL."""
    day = found.withColumns({"hint_date": dates.article_date(F.col("published_at_hint")), "day": F.lit(run_day).cast("date"), "source": F.lit(listing.domain)})
    gated = discovery.gate_listing(day, "hint_date", "day")
    kept = discovery.pages_read(gated, ["source"], most=listing.most_pages).where("listing_gate = 'KEPT'")
    return discovery.last_value_first_place(kept, ["url"], ["headline", "published_at_hint", "excerpt"], ["page", "pos"])


def collect(candidates: DataFrame, pages: DataFrame, state: DataFrame, source_name: str, section_name: str, run_day: str, now: str) -> tuple[DataFrame, DataFrame]:
    """(outcomes, state): what became of every candidate, and the whole state after the run.

    candidates: url, headline and, where the listing showed them, page and pos
    (the order of fetches; else that of URLs), published_at_hint and excerpt,
    which go to the article as its listing columns. pages: url, final_url, html
    (null: the fetch failed). state: as in readers.STATE, keyed by url; a listing
    URL and a canonical URL that differ are two rows of it.
    """
    outcomes, touched, _ = _collected(candidates, lambda due: pages, lambda urls: state, source_name, section_name, run_day, now)
    return outcomes, state.join(touched.select("url"), "url", "left_anti").unionByName(touched)


def _collected(candidates: DataFrame, pages_of: Callable[[DataFrame], DataFrame], state_of: Callable[[DataFrame], DataFrame], source_name: str, section_name: str, run_day: str, now: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """collect with pages and the state's rows of given urls at hand: (outcomes, the state's rows that the run touched, the pages).

    Pages are asked for only where they are due.

    Articles that are accepted meet what was stored of their canonical URL in the
    order of fetches, one after another: of two listings of one page the second
    is UNCHANGED, or the next version.
    """
    at, day = F.lit(now).cast("timestamp"), F.lit(run_day).cast("date")
    order = [c for c in ("page", "pos") if c in candidates.columns]
    listed = candidates.select("url", "headline", F.struct(*order, "url").alias("place"))
    known = state_of(listed.select("url"))
    # candidates are marked as seen before the gate, so a first contact is NEVER_FETCHED
    asked = listed.join(known.select("url", "last_fetched_at"), "url", "left").withColumn("reason", validation.fetch_reason(F.lit(True), F.col("last_fetched_at"), at))
    wanted = asked.where("reason <> 'RECENTLY_FETCHED'").select("url")
    pages = pages_of(wanted)
    due = wanted.join(pages, "url", "left")
    shown = candidates.select(F.col("url").alias("source_url"), F.col("headline").alias("listing_headline"), *[(F.col(c) if c in candidates.columns else F.lit(None).cast("string")).alias(f"listing_{to}") for c, to in (("published_at_hint", "published_at"), ("excerpt", "excerpt"))])
    fetched = materialize(validation.validate(extraction.extract_articles(due.where("html is not null"), source_name, section_name, now)).withColumn("_row", F.monotonically_increasing_id()), "fetched")
    published = dates.article_date(F.col("published_at"))
    # texts wait in `fetched` and meet their verdicts once, by the row's number there
    gated = fetched.drop("article_text").join(shown, "source_url", "left").join(listed.select(F.col("url").alias("source_url"), "place"), "source_url").withColumn("gate", validation.gate_outcome(published, F.col("validation.valid"), day))
    stored = state_of(fetched.select(F.col("canonical_url").alias("url")))
    before = stored.select(F.col("url").alias("canonical_url"), F.col("content_hash").alias("hash_before"), F.col("version_number").alias("version_before"))
    folded = versions.with_changes(gated.where("gate = 'ACCEPTED'"), "canonical_url", "place", before=before)
    folded = folded.withColumn("intake_status", validation.intake_status(published, F.col("status"), day))
    label = F.when(F.col("intake_status") == "LATE_DISCOVERY", "LATE").otherwise(F.col("status"))
    judged = folded.withColumn("outcome", label).unionByName(gated.where("gate <> 'ACCEPTED'").withColumn("outcome", F.col("gate")), allowMissingColumns=True)
    judged = materialize(judged, "judged")
    rest = asked.join(judged.select(F.col("source_url").alias("url")), "url", "left_anti").select("url", F.when(F.col("reason") == "RECENTLY_FETCHED", F.col("reason")).otherwise("FETCH_FAILED").alias("outcome"))
    columns = [c for c in judged.columns if c not in ("place", "_row")]
    columns.insert(columns.index("word_count"), "article_text")
    outcomes = judged.join(fetched.select("_row", "article_text"), "_row").select(*columns).withColumnRenamed("source_url", "url").unionByName(rest, allowMissingColumns=True)

    seen = listed.select("url", F.col("url").alias("_source"), F.nullif("headline", F.lit("")).alias("_headline"))
    accepted = judged.where("gate = 'ACCEPTED'").groupBy(F.col("canonical_url").alias("url")).agg(F.max_by(F.struct("source_url", "headline", "content_hash", "published_at", "version_number"), "place").alias("f"))
    held = known.unionByName(stored).dropDuplicates(["url"])
    joined = seen.join(accepted, "url", "full").join(held, "url", "left")
    touched = joined.select(
        "url",
        F.coalesce("f.source_url", "source_url", "_source").alias("source_url"),
        F.coalesce(F.col("f.headline"), F.col("_headline"), F.col("headline")).alias("headline"),
        F.coalesce(F.col("f.content_hash"), F.col("content_hash")).alias("content_hash"),
        F.coalesce(F.col("f.published_at"), F.col("published_at")).alias("published_at"),
        F.coalesce("first_seen_at", F.lit(now)).alias("first_seen_at"),
        F.lit(now).alias("last_seen_at"),
        F.when(F.col("f").isNotNull(), F.lit(now)).otherwise(F.col("last_fetched_at")).alias("last_fetched_at"),
        F.coalesce(F.col("f.version_number"), F.col("version_number"), F.lit(0)).cast("long").alias("version_number"),
    )
    return outcomes, touched, pages


def stage(outcomes: DataFrame, pages: DataFrame, source_key: str, run_day: str, raw_path: str, staged_path: str) -> None:
    """Store what a run accepted as new or changed: pages as they came, and staged articles with their listing columns.

    Both are keyed by page and version, so a run that broke off before its state
    was stored may come again.
    """
    day = F.lit(run_day).cast("date")
    stored = outcomes.where("gate = 'ACCEPTED' and status <> 'UNCHANGED'").withColumns({"source": F.lit(source_key), "run_date": F.lit(run_day), "article_id": text.url_hash(F.col("canonical_url")), "version_name": text.version_name(F.col("version_number"))})
    sinks.write_raw_pages(stored.select("source", "run_date", "article_id", "version_name", "url").join(pages.select("url", "html"), "url").drop("url"), raw_path)
    articles = stored.withColumnRenamed("url", "source_url").withColumns(
        {
            "article_version": F.col("version_number").cast("string"),
            "collection_status": F.col("status"),
            "collection_run_date": F.lit(run_day),
            "collection_window_start": dates.window_start(day).cast("string"),
            "collection_window_end": F.lit(run_day),
            "collection_mode": dates.window_mode(day),
        }
    )
    columns = [f.name for f in StructType.fromDDL(readers.STAGED)]
    sinks.write_staged(articles.select("source", "run_date", *columns), staged_path)


def run(spark, source_key: str, section_pages: DataFrame, state: DataFrame, run_day: str, now: str, run_id: str, raw_path: str, staged_path: str, pages: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(status row, state): a source's run from its section pages to stored articles, over a whole state.

    pages: as in collect; without them the candidates' pages are fetched.
    """
    outcomes, touched = _run(source_key, section_pages, lambda urls: state, run_day, now, raw_path, staged_path, pages)
    after = state.join(touched.select("url"), "url", "left_anti").unionByName(touched)
    return status(outcomes, source_key, run_id), materialize(after, "state")


def run_stored(spark, source_key: str, section_pages: DataFrame, state_root: str, run_day: str, now: str, run_id: str, raw_path: str, staged_path: str, pages: DataFrame | None = None,
               fetch: Callable[[DataFrame], DataFrame] = readers.fetch_pages, listing: Listing | None = None) -> DataFrame:
    """The same over a stored state: the status row. Only the state's buckets that the run's URLs fall in are read and written."""
    outcomes, touched = _run(source_key, section_pages, lambda urls: readers.state_of(spark, state_root, urls), run_day, now, raw_path, staged_path, pages, fetch, listing)
    sinks.write_state(touched, state_root)
    return status(outcomes, source_key, run_id)


def collect_stored(candidates: DataFrame, pages: DataFrame, state_root: str, source_key: str, section_name: str, run_day: str, now: str, raw_path: str, staged_path: str) -> DataFrame:
    """collect over a stored state, with pages, staged articles and state written: the outcomes."""
    spark = candidates.sparkSession
    outcomes, touched = _stored(candidates, lambda due: pages, lambda urls: readers.state_of(spark, state_root, urls), source_key, section_name, run_day, now, raw_path, staged_path)
    sinks.write_state(touched, state_root)
    return outcomes


def _run(source_key: str, section_pages: DataFrame, state_of: Callable[[DataFrame], DataFrame], run_day: str, now: str, raw_path: str, staged_path: str, pages: DataFrame | None,
         fetch: Callable[[DataFrame], DataFrame] = readers.fetch_pages, listing: Listing | None = None) -> tuple[DataFrame, DataFrame]:
    listing = listing or LISTINGS[source_key]
    found = materialize(required(discover(section_pages, listing, now), listing, run_day), "candidates")
    pages_of = lambda due: materialize(fetch(due).select("url", "final_url", "html"), "pages") if pages is None else pages
    return _stored(found, pages_of, state_of, source_key, "business", run_day, now, raw_path, staged_path)


def _stored(candidates: DataFrame, pages_of: Callable[[DataFrame], DataFrame], state_of: Callable[[DataFrame], DataFrame], source_key: str, section_name: str, run_day: str, now: str, raw_path: str, staged_path: str) -> tuple[DataFrame, DataFrame]:
    """(outcomes, touched state) of candidates whose pages and articles are stored; the state isn't yet."""
    outcomes, touched, pages = _collected(candidates, pages_of, state_of, source_key, section_name, run_day, now)
    outcomes, touched = materialize(outcomes, "outcomes"), materialize(touched, "touched")
    stage(outcomes, pages, source_key, run_day, raw_path, staged_path)
    return outcomes, touched


def status(outcomes: DataFrame, source_key: str, run_id: str) -> DataFrame:
    """The status row of a source's run."""
    counted = rollup.with_statuses(rollup.source_counters(outcomes.withColumn("source_key", F.lit(source_key)), ["source_key"]))
    return counted.withColumns({"run_id": F.lit(run_id), "execution_status": F.lit("SUCCESS")})


_FAILED = "run_id string, source_key string, execution_status string, health_status string, content_status string, error_type string, error_message string"


def run_sources(spark, jobs: dict[str, Callable[[], DataFrame]], run_id: str) -> DataFrame:
    """The status rows of all sources; one that raises is a FAILED row and the others still run.

    jobs: by source_key, a function that runs the source and returns its status
    row. No jobs give no rows.
    """
    rows = []
    for key, job in jobs.items():
        try:
            rows.append(materialize(job(), "status"))
        except Exception as e:  # noqa: BLE001  whatever a source fails with is its status
            failed = (run_id, key, "FAILED", "FAILED", "SOURCE_FETCH_FAILED", type(e).__name__, str(e))
            rows.append(spark.createDataFrame([failed], _FAILED))
    whole = spark.createDataFrame([], _FAILED)
    for r in rows:
        whole = whole.unionByName(r, allowMissingColumns=True)
    return whole
