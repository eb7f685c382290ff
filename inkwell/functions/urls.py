"""URL functions, by regular expressions: they never fail on odd URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query keys that only track visitors.
TRACKING_KEYS = ["utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "fbclid", "gclid"]

_URL = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _URL, 1))


def netloc(url: Column) -> Column:
    return F.regexp_extract(url, _URL, 2)


def path(url: Column) -> Column:
    return F.regexp_extract(url, _URL, 3)


def query(url: Column) -> Column:
    return F.regexp_extract(url, _URL, 4)


def host(url: Column) -> Column:
    """Lower-cased host without user and port."""
    return F.lower(F.regexp_replace(F.regexp_replace(netloc(url), "^.*@", ""), r":\d*$", ""))


def _recoded(s: Column) -> Column:
    """Percent-decoded and encoded again, blanks as +."""
    plain = F.coalesce(F.try_url_decode(s), s)
    return F.replace(F.replace(F.url_encode(plain), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def normalize_query(q: Column) -> Column:
    """Tracking keys dropped, the rest in order; a key without value gets an empty one."""
    pairs = F.filter(F.split(q, "&"), lambda p: p != "")
    keyed = F.transform(pairs, lambda p: F.struct(F.regexp_extract(p, "^([^=]*)", 1).alias("k"), F.regexp_extract(p, "^[^=]*=?(.*)$", 1).alias("v")))
    kept = F.filter(keyed, lambda p: ~F.lower(F.coalesce(F.try_url_decode(p["k"]), p["k"])).isin(TRACKING_KEYS))
    return F.array_join(F.transform(kept, lambda p: F.concat(_recoded(p["k"]), F.lit("="), _recoded(p["v"]))), "&")


def _assembled(s: Column, n: Column, p: Column, q: Column) -> Column:
    return F.concat(F.when(s != "", F.concat(s, F.lit(":"))).otherwise(""), F.when(n != "", F.concat(F.lit("//"), n)).otherwise(""), p, F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))


def normalize_url(url: Column) -> Column:
    """Lower scheme and host, no slashes at the path's end, no tracking keys, no fragment."""
    p = path(url)
    trimmed = F.when(p == "/", p).otherwise(F.regexp_replace(p, "/+$", ""))
    return _assembled(scheme(url), F.lower(netloc(url)), trimmed, normalize_query(query(url)))


def domain_matches(url: Column, domain: Column | str) -> Column:
    """The host is the domain or ends with it after a dot."""
    d = F.lower(F.lit(domain) if isinstance(domain, str) else domain)
    return (host(url) == d) | F.endswith(host(url), F.concat(F.lit("."), d))


def _without_dots(segments: Column) -> Column:
    """Path segments with `.` and `..` resolved."""
    empty = F.array().cast("array<string>")
    step = lambda done, x: F.when(x == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).when(x == ".", done).otherwise(F.array_append(done, x))
    tail = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(empty)
    return F.concat(F.aggregate(segments, empty, step), tail)


def absolute_url(base: Column, href: Column) -> Column:
    """href resolved against base, after RFC 3986."""
    rest = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    own, folder = path(href), F.regexp_replace(path(base), "[^/]*$", "")
    joined = F.regexp_replace(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), own), "/{2,}(?=.)", "/")
    inner = F.substr(F.when(F.startswith(own, F.lit("/")), own).otherwise(joined), F.lit(2))
    resolved = F.concat(F.lit("/"), F.array_join(_without_dots(F.split(inner, "/")), "/"))
    root = F.concat(scheme(base), F.lit("://"), netloc(base))
    without_fragment = F.regexp_replace(base, "#.*$", "")
    return (
        F.when(href == "", base)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme(base), F.lit(":"), href))
        .when(F.startswith(href, F.lit("#")), F.concat(without_fragment, href))
        .when(F.startswith(href, F.lit("?")), F.concat(F.regexp_replace(without_fragment, r"\?.*$", ""), href))
        .otherwise(F.concat(root, resolved, rest))
    )


def section_page_by_offset(base: Column, page: Column, size: int = 30) -> Column:
    """Page 1 is the base, page n is base/(n - 1) * size."""
    return F.when(page <= 1, base).otherwise(F.concat(base, F.lit("/"), ((page - 1) * size).cast("string")))


def section_page_by_path(base: Column, page: Column) -> Column:
    return F.when(page <= 1, base).otherwise(F.concat(base, F.lit("page/"), page.cast("string"), F.lit("/")))
