"""Facts of a web page, by expressions over what the tokenizer (functions.markup) finds in it."""

from __future__ import annotations

import re
from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell.functions import dates, markup, text, urls

# The metadata that may hold a publication date, in order of trial.
DATE_PROPERTIES = ["article:published_time", "og:published_time", "article:published"]
DATE_NAMES = ["date", "datePublished", "datepublished", "publish-date", "publish_date", "publication_date", "publication-date", "pubdate", "article_date_original", "sailthru.date"]

#: The parts of a page that its facts are taken from.
PARTS = ("metas", "links", "times", "scripts", "h1", "title", "text")


def meta_content(metas: Column, attribute: str, value: str) -> Column:
    """Content of the first meta tag whose attribute has the value; blank is null."""
    first = F.get(F.filter(metas, lambda m: m[attribute] == value), 0)["content"]
    return F.nullif(text.stripped(first), F.lit(""))


def json_items(scripts: Column) -> Column:
    """array<variant>: the items of all JSON-LD scripts; lists flat, a graph before its dict."""
    none = F.array().cast("array<variant>")

    def items(script: Column) -> Column:
        v = F.try_parse_json(script)
        as_list, graph = F.try_variant_get(v, "$", "array<variant>"), F.try_variant_get(v, "$['@graph']", "array<variant>")
        is_dict = F.startswith(F.schema_of_variant(v), F.lit("OBJECT"))
        return F.when(v.isNull(), none).when(as_list.isNotNull(), as_list).when(is_dict, F.concat(F.coalesce(graph, none), F.array(v))).otherwise(none)

    return F.flatten(F.transform(scripts, items))


def _first_string(items: Column, path: str) -> Column:
    """The first item's non-blank string at a path."""
    return F.get(F.filter(F.transform(items, lambda v: _string(v, path)), lambda s: s.isNotNull()), 0)


def _string(v: Column, path: str) -> Column:
    inner = F.try_variant_get(v, path, "variant")
    return F.when(F.schema_of_variant(inner) == "STRING", F.nullif(text.stripped(F.try_variant_get(v, path, "string")), F.lit("")))


def headline_of(page: Column, items: Column) -> Column:
    """og:title, else JSON-LD headline, else h1, else title, else empty; cleaned."""
    return text.clean_headline(F.coalesce(meta_content(page["metas"], "property", "og:title"), _first_string(items, "$.headline"), page["h1"], page["title"]))


def subheadline_of(page: Column, items: Column) -> Column:
    metas = page["metas"]
    found = F.coalesce(meta_content(metas, "property", "og:description"), meta_content(metas, "name", "description"), _first_string(items, "$.description"))
    return F.nullif(text.collapse(found), F.lit(""))


def author_of(page: Column, items: Column) -> Column:
    """Metadata, else JSON-LD: a name, a person's name, or a list of either."""

    def of_item(v: Column) -> Column:
        people = F.transform(F.try_variant_get(v, "$.author", "array<variant>"), lambda p: F.coalesce(_string(p, "$.name"), _string(p, "$")))
        return F.coalesce(_string(v, "$.author.name"), F.nullif(F.array_join(F.array_compact(people), ", "), F.lit("")), _string(v, "$.author"))

    listed = F.get(F.array_compact(F.transform(items, of_item)), 0)
    return F.coalesce(meta_content(page["metas"], "name", "author"), meta_content(page["metas"], "property", "article:author"), listed)


def published_of(page: Column, items: Column, now: Column | None = None) -> Column:
    """The first candidate that parses: metadata, JSON-LD, time tags; else a date in the text, which is searched only then. now: what relative dates are relative to."""
    metas = page["metas"]
    named = [meta_content(metas, "property", p) for p in DATE_PROPERTIES] + [meta_content(metas, "name", n) for n in DATE_NAMES]
    listed = F.transform(items, lambda v: F.try_variant_get(v, "$.datePublished", "string"))
    timed = F.flatten(F.transform(page["times"], lambda t: F.array(t["datetime"], t["text"])))
    in_text = F.transform(F.array(page["text"]), lambda s: F.array(*[dates.first_date_text(s, (p,)) for p in (dates.WITH_WEEKDAY, dates.DAY_FIRST, dates.MONTH_FIRST)]))[0]

    def first(candidates: Column) -> Column:
        """One after another; what follows the first that parses is not read."""
        filled = F.array_distinct(F.filter(candidates, lambda c: c.isNotNull() & (c != "")))
        return F.aggregate(filled, F.lit(None).cast("string"), lambda found, c: F.coalesce(found, dates.parse_date(c, now)))

    return F.coalesce(first(F.concat(F.array(*named), listed, timed)), first(in_text))


def canonical_of(page: Column, items: Column, final_url: Column) -> Column:
    """link rel=canonical, else JSON-LD url or mainEntityOfPage, else the final URL; normalised."""
    link = F.get(F.filter(page["links"], lambda t: F.array_contains(t["rel"], "canonical")), 0)
    of_item = lambda v: F.coalesce(_string(v, "$.url"), _string(v, "$.mainEntityOfPage['@id']"), _string(v, "$.mainEntityOfPage"))
    listed = F.get(F.array_compact(F.transform(items, of_item)), 0)
    return urls.normalize_url(F.coalesce(F.nullif(text.stripped(link["href"]), F.lit("")), listed, final_url))


def anchors(html: Column) -> Column:
    """array<struct<href, text>> of all links with a target, in order."""
    return markup.parsed(html, "anchors")["anchors"]


def page_title(html: Column, known: Collection[str] | None = None) -> Column:
    """known: as in markup.decoder."""
    return markup.parsed(html, "title", known=known)["title"]


def probe_words(html: Column, most: int = 200, known: Collection[str] | None = None) -> Column:
    """The first words of a page's visible text, without scripts, styles and titles; known: as in markup.decoder."""
    return F.array_join(F.slice(text.words(markup.parsed(html, "shown", known=known)["shown"]), 1, most), " ")


def access_class(status: Column) -> Column:
    return F.when(status == 200, "HTTP_ACCESS_OK").when(status == 403, "HTTP_ACCESS_BLOCKED").when(status.between(300, 399), "REDIRECT").otherwise(F.concat(F.lit("HTTP_"), status.cast("string")))


def article_text(html: Column) -> Column:
    """The main text of a page (markup.Page.body)."""
    return markup.parsed(html, "body")["body"]


_WEEKDAY = re.compile(dates.WITH_WEEKDAY.replace("(?i)", ""), re.I)
_MONTH = re.compile(dates.MONTH_FIRST.replace("(?i)", "").replace(r"(?:\s+\d{1,2}:\d{2})?", ""), re.I)


def links_with_dates(html: Column) -> Column:
    """Links with the weekday date of the nearest of six ancestors (1,800 characters at most) that shows one."""
    return markup.near(html, 6, 1800, _WEEKDAY)


def links_with_excerpts(html: Column) -> Column:
    """Links with the first paragraph of 40 characters in the nearest of six ancestors (2,500 at most)."""
    return markup.near(html, 6, 2500, None)


def links_with_cards(html: Column) -> Column:
    """Links with date and paragraph of the nearest of seven ancestors (2,200 at most) that shows a date."""
    return markup.near(html, 7, 2200, _MONTH)
