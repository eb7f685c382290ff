"""String functions: white space, hashes, matching form, terms, headlines, identities."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space in the wide sense; Java's \s alone is ASCII.
SPACE = r"[\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: The same characters, for trimming.
BLANK_CHARS = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"

# Publishers whose name may end a headline, and the marks before it, in order of trial.
PUBLISHERS = ["Daily FT", "Ceylon Today", "Daily Mirror", "Daily News", "The Island"]
SUFFIX_MARKS = ["|", "-", "–", "—"]


def collapse(s: Column) -> Column:
    """Runs of white space become one blank; none at the ends."""
    return F.trim(F.regexp_replace(s, SPACE + "+", " "))


def words(s: Column) -> Column:
    return F.filter(F.split(s, SPACE + "+"), lambda w: w != "")


def word_count(s: Column) -> Column:
    return F.regexp_count(F.coalesce(s, F.lit("")), F.lit(f"[^{SPACE[1:-1]}]+")).cast("long")


def sha256_text(s: Column) -> Column:
    """Hex SHA-256; null hashes as the empty string."""
    return F.sha2(F.coalesce(s, F.lit("")), 256)


def content_hash(s: Column) -> Column:
    return sha256_text(collapse(s))


def url_hash(url: Column, length: int = 16) -> Column:
    """The article id: the first hex digits of the URL's hash."""
    return F.substring(sha256_text(url), 1, length)


_KEPT = set("abcdefghijklmnopqrstuvwxyz0123456789%+-'. ")
_DROPPED = "".join(c for c in map(chr, range(1, 128)) if c not in _KEPT)


def matching_form(s: Column) -> Column:
    """Lower case, plain quotes and dashes, all but letters, digits and %+-'. as blanks.

    ASCII goes by one table; a pattern is needed only where other characters are.
    """
    plain = F.translate(F.lower(F.coalesce(s, F.lit(""))), "’‘–—" + _DROPPED, "''--" + " " * len(_DROPPED))
    ascii_only = F.element_at(F.transform(F.array(plain), lambda x: F.when((F.octet_length(x) == F.length(x)) & ~F.contains(x, F.lit("\0")), x).otherwise(F.regexp_replace(x, "[^\\x01-\\x7f]+", " "))), 1)
    return F.trim(F.regexp_replace(ascii_only, " {2,}", " "))


def matching_form_of(term: str) -> str:
    """matching_form for a term of the rules, on the driver."""
    plain = term.lower().translate(str.maketrans("’‘–—", "''--"))
    return re.sub(" +", " ", re.sub(r"[^a-z0-9%+\-'. ]+", " ", plain)).strip()


def contains_term(text: Column, term: Column) -> Column:
    """Whether a term stands in a text without a letter or digit on either side.

    Both are in matching form. The plain search decides most texts; only where
    it finds something do the bounds matter.
    """
    bounded = F.concat(F.lit("(?<![a-z0-9])\\Q"), term, F.lit("\\E(?![a-z0-9])"))
    return (term != "") & F.contains(text, term) & F.regexp_like(text, bounded)


def literals(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def is_word(form: str) -> bool:
    return bool(re.fullmatch("[a-z0-9]+", form))


def word_set(form: Column, terms: list[str]) -> Column:
    """The one-word terms that are among the runs of letters and digits of a text in matching form."""
    vocabulary = sorted({f for f in map(matching_form_of, terms) if is_word(f)})
    return F.array_intersect(F.split(F.translate(form, "%+-'.", "     "), " "), literals(vocabulary))


def matching_terms(form: Column, terms: list[str], words: Column | None = None) -> Column:
    """The terms that stand in a text in matching form, in the order of the list.

    A term of one word is looked up in the text's word set (pass it where it is
    at hand, taken with these terms or more); only others are searched for,
    each with a pattern of its own.
    """
    forms = {t: matching_form_of(t) for t in terms if matching_form_of(t)}
    one = {t: f for t, f in forms.items() if is_word(f)}
    found = [F.array_compact(F.array(*[F.when(F.contains(form, F.lit(f)) & form.rlike(rf"(?<![a-z0-9])\Q{f}\E(?![a-z0-9])"), F.lit(t)) for t, f in forms.items() if t not in one]))] if len(one) < len(forms) else []
    if one:
        held = F.array_intersect(literals(list(one.values())), word_set(form, terms) if words is None else words)
        if any(t != f for t, f in one.items()):
            named = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(f).alias("f")) for t, f in one.items()])
            held = F.transform(F.filter(named, lambda x: F.array_contains(held, x["f"])), lambda x: x["t"])
        found.append(held)
    if not found:
        return literals([])
    return found[0] if len(found) == 1 else F.array_intersect(literals(list(forms)), F.concat(*found))


def shown(s: Column, most: int = 160) -> Column:
    """White space collapsed, cut to what a report shows of a text."""
    return F.substring(collapse(F.coalesce(s, F.lit(""))), 1, most)


def clean_headline(s: Column) -> Column:
    """White space collapsed, one publisher's name cut off the end."""
    h = collapse(F.coalesce(s, F.lit("")))
    suffix = "|".join(rf"\Q{mark} {p}\E" for p in PUBLISHERS for mark in SUFFIX_MARKS)
    return F.trim(F.regexp_replace(h, f"(?iu)({suffix})$", ""))


def normalize_body(s: Column) -> Column:
    """Lines collapsed, blank ones dropped, the rest joined by a blank line."""
    lines = F.transform(F.split(F.coalesce(s, F.lit("")), LINE_BREAK), collapse)
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n\n")


def source_slug(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(name)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def stripped(s: Column) -> Column:
    """Null as the empty string, no white space at the ends."""
    return F.btrim(F.coalesce(s, F.lit("")), F.lit(BLANK_CHARS))


def is_blank(s: Column) -> Column:
    """Null, empty or white space alone; a long text is told by its first characters."""
    return ~F.coalesce(s, F.lit("")).rlike(f"[^{SPACE[1:-1]}]")


def path_parts(path: Column) -> Column:
    return F.filter(F.split(path, r"[/\\]"), lambda p: p != "")


def path_date(path: Column) -> Column:
    """The first component of a path that is a date, or null."""
    return F.get(F.filter(path_parts(path), lambda p: p.rlike(r"^\d{4}-\d{2}-\d{2}$")), 0)


def article_version(version: Column, path: Column) -> Column:
    """The version named in the record, else in the file name vNNN.json, else 0."""
    named = F.regexp_extract(F.element_at(path_parts(path), -1), r"^v(\d+)\.json$", 1)
    return F.coalesce(version.try_cast("int"), named.try_cast("int"), F.lit(0))


def version_name(version: Column) -> Column:
    """vNNN, with three digits at least."""
    v = version.cast("string")
    return F.concat(F.lit("v"), F.when(F.length(v) < 3, F.lpad(v, 3, "0")).otherwise(v))


def article_identity(source: Column, canonical_url: Column, source_url: Column, path: Column) -> Column:
    """Source with the first of: canonical URL, source URL, folder, path."""
    parts = path_parts(path)
    folder = F.get(parts, F.size(parts) - 2)
    filled = [F.nullif(c, F.lit("")) for c in (canonical_url, source_url, folder)]
    return F.concat(source, F.lit("|"), F.coalesce(*filled, path))


def article_id_from_path(path: Column, content_hash: Column, sources: list[str]) -> Column:
    """The folder's name unless it is a source or a date, else the hash's start, else the plain file name."""
    parts = path_parts(path)
    folder = F.get(parts, F.size(parts) - 2)
    usable = folder.isNotNull() & ~folder.isin(sources) & ~folder.rlike(r"^\d{4}-\d{2}-\d{2}$")
    stem = F.regexp_replace(F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", ""), "[^A-Za-z0-9_-]+", "_")
    return F.coalesce(F.when(usable, folder), F.nullif(F.substring(content_hash, 1, 16), F.lit("")), stem)


def list_text(values: Column) -> Column:
    return F.array_join(values, "; ")


def groups_text(groups: Column) -> Column:
    """array<struct<name, terms>> as `name:t1|t2; name2:...`."""
    return F.array_join(F.transform(groups, lambda g: F.concat(g["name"], F.lit(":"), F.array_join(g["terms"], "|"))), "; ")


def run_id(started: Column, salt: Column | None = None) -> Column:
    """Local start as yyyyMMdd_HHmmss, an underscore and eight hex digits."""
    tail = F.substring(F.expr("uuid()"), 1, 8) if salt is None else F.substring(sha256_text(salt), 1, 8)
    return F.concat(F.date_format(started, "yyyyMMdd_HHmmss"), F.lit("_"), tail)
