"""A page of markup, read once: its elements, texts, metadata, links and times.

A state machine over tags, comments and texts. It knows comments, elements whose
content is no markup (script, style, title and others), attributes in quotes and
without, and named and numeric entities (all of HTML, or those that a caller
knows: readers disagree about such as stand without their semicolon); what is no
tag is text, and nothing in a page can fail. `parsed` gives the fields that are asked for as one struct, so
that a page is read once whatever is taken from it.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Collection, Iterator
from functools import cached_property
from hashlib import sha256
from html import unescape
from itertools import accumulate, islice

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from inkwell.session import ship

_NAME = r"[a-zA-Z][^\s/>]*"
_START = re.compile(rf"""<({_NAME})((?:[\s/]*+[^\s/>=][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+)*+)[\s/]*+>""")
_ODD_START = re.compile(rf"<({_NAME})([^>]*+)>")
_END = re.compile(rf"</({_NAME})[^>]*+>")
_ATTRIBUTE = re.compile(r"""([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")

# Elements whose content is no markup, with entities and without.
_TEXT_ONLY, _RAW = {"title", "textarea"}, {"script", "style", "xmp", "iframe", "noembed", "noframes"}
# Elements that hold no article text, elements that hold blocks of it, elements that end a paragraph, elements without an end.
_ASIDE = {"script", "style", "noscript", "nav", "header", "footer", "aside", "form", "table", "figure", "button", "template", "svg", "title"}
_BLOCKS = {"p", "h2", "h3", "h4", "li", "blockquote", "pre"}
_ENDS_P = _BLOCKS | {"div", "ul", "ol", "dl", "table", "section", "article", "aside", "header", "footer", "nav", "form", "h1", "h5", "h6", "hr", "main"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_WITH_ATTRIBUTES = {"meta", "link", "a", "time", "script"}

#: What a character of a link takes from a block's worth.
LINK_COST = 3


def decoder(known: Collection[str] | None = None) -> Callable[[str], str]:
    """Decodes the references that are known, written as in a page (&amp;), the longest that fits; the others stay as they are. None: as HTML does."""
    if known is None:
        return unescape
    fits = re.compile("|".join(map(re.escape, sorted(known, key=len, reverse=True))) or "(?!)")
    return lambda text: fits.sub(lambda m: unescape(m[0]), text)


def attributes(source: str, decode: Callable[[str], str] = unescape) -> dict[str, str]:
    """The attributes of a tag; the last of a name counts, one without value is empty."""
    found = {}
    for name, double, single, plain in _ATTRIBUTE.findall(source):
        value = double or single or plain
        found[name.lower()] = decode(value) if "&" in value else value
    return found


class Page:
    """Elements as (tag, parent, first text, end of text, last element inside, attributes) with the page's texts in order.

    A block ends an open paragraph, an item the open item before it, and an end
    tag all that is open inside its element.
    """

    def __init__(self, page: str | None, decode: Callable[[str], str] = unescape):
        self.decode = decode
        self.tags, self.parents, self.spans, self.attributes = ["#"], [-1], [[0, 0]], [{}]
        self.last, self.aside, self.texts, self.scripts = [0], [False], [], []
        self.open, self.counts = [0], Counter()
        self._read(page or "")
        self._close(0)
        self.ends = list(accumulate((len(x) + 1 for x in self.texts), initial=0))

    def _read(self, page: str) -> None:
        said = at = 0  # what lies between is text that is not said yet
        while (at := page.find("<", at)) >= 0:
            following = page[at + 1 : at + 2]
            if following in ("!", "?"):
                self._say(page[said:at])
                if page.startswith("<!--", at):
                    end = at + 4 if page.startswith(">", at + 4) else page.find("-->", at + 4) + 2
                    said = at = end + 1 if end >= at + 4 else len(page)
                else:
                    said = at = page.find(">", at) + 1 or len(page)
                continue
            if following == "/":
                self._say(page[said:at])
                if m := _END.match(page, at):
                    self._end(m[1].lower())
                said = at = m.end() if m else page.find(">", at) + 1 or len(page)
                continue
            if m := _START.match(page, at) or _ODD_START.match(page, at):
                self._say(page[said:at])
                said = at = self._start(m[1].lower(), m[2], page, m.end())
                continue
            if following.isalpha() and following.isascii():  # a tag that the page ends in
                break
            at += 1
        self._say(page[said : at if at >= 0 else len(page)])

    def _start(self, tag: str, source: str, page: str, end: int) -> int:
        """Open an element; the place where reading goes on."""
        if tag in _ENDS_P:
            self._end("p")
        if tag == "li" and self.tags[self.open[-1]] == "li":
            self._end("li")
        if tag == "a" and self.counts[tag]:  # links don't nest: the open one ends, what it holds stays open
            depth = self._open_at(tag)
            self.spans[self.open[depth]][1], self.last[self.open[depth]] = len(self.texts), len(self.tags) - 1
            del self.open[depth]
            self.counts[tag] -= 1
        up, k = self.open[-1], len(self.tags)
        self.tags.append(tag)
        self.parents.append(up)
        self.spans.append([len(self.texts)] * 2)
        self.last.append(k)
        self.aside.append(self.aside[up] or tag in _ASIDE)
        self.attributes.append(attributes(source, self.decode) if tag in _WITH_ATTRIBUTES else {})
        if tag in _VOID:
            return end
        self.open.append(k)
        self.counts[tag] += 1
        if tag in _RAW or tag in _TEXT_ONLY:
            m = re.compile(f"</{tag}(?=[\\s/>])[^>]*+>?", re.I).search(page, end)
            content, end = page[end : m.start() if m else len(page)], m.end() if m else len(page)
            if tag in _TEXT_ONLY:
                self._say(content)
            elif tag == "script" and self.attributes[k].get("type") == "application/ld+json":
                self.scripts.append(content)
            self._end(tag)
        return end

    def _end(self, tag: str) -> None:
        if self.counts[tag]:
            self._close(self._open_at(tag))

    def _open_at(self, tag: str) -> int:
        depth = len(self.open) - 1
        while self.tags[self.open[depth]] != tag:
            depth -= 1
        return depth

    def _close(self, depth: int) -> None:
        for k in self.open[depth:]:
            self.spans[k][1], self.last[k] = len(self.texts), len(self.tags) - 1
            self.counts[self.tags[k]] -= 1
        del self.open[depth:]

    def _say(self, data: str) -> None:
        if words := (self.decode(data) if "&" in data else data).split():
            self.texts.append(" ".join(words))

    def length(self, k: int) -> int:
        """Characters of said(k)."""
        low, high = self.spans[k]
        return max(0, self.ends[high] - self.ends[low] - 1)

    def said(self, k: int) -> str:
        return " ".join(self.texts[slice(*self.spans[k])])

    def under(self, k: int) -> Iterator[int]:
        while k >= 0:
            yield k
            k = self.parents[k]

    def each(self, tag: str) -> list[int]:
        return [k for k, t in enumerate(self.tags) if t == tag]

    def first(self, tag: str) -> str | None:
        k = next((k for k, t in enumerate(self.tags) if t == tag), None)
        return (self.said(k) or None) if k is not None else None

    # --- fields

    def metas(self) -> list[dict]:
        return [{c: self.attributes[k].get(c) for c in ("property", "name", "content")} for k in self.each("meta")]

    def links(self) -> list[dict]:
        return [{"rel": self.attributes[k].get("rel", "").split(), "href": self.attributes[k].get("href")} for k in self.each("link")]

    def times(self) -> list[dict]:
        return [{"datetime": self.attributes[k].get("datetime"), "text": self.said(k)} for k in self.each("time")]

    def anchors(self) -> list[dict]:
        return [{"href": self.attributes[k]["href"], "text": self.said(k)} for k in self.each("a") if self.attributes[k].get("href")]

    def text(self) -> str:
        return " ".join(self.texts)

    def shown(self) -> str:
        """text without titles."""
        out = set()
        for k in self.each("title"):
            out.update(range(*self.spans[k]))
        return " ".join(t for i, t in enumerate(self.texts) if i not in out)

    @cached_property
    def main(self) -> str:
        """Blocks of text outside navigation, forms, tables and figures, a blank line between them.

        A block is worth its characters less LINK_COST for each that is a
        link's; of runs of blocks the one worth most is taken, so lists of links
        before, between and after the text fall away.
        """
        blocks = [k for k, tag in enumerate(self.tags) if tag in _BLOCKS and not self.aside[k]]
        inner = {self.parents[k] for k in blocks}
        blocks = [k for k in blocks if k not in inner and self.length(k)]
        linked = list(accumulate((self._linked()), initial=0))
        worth = [self.length(k) - LINK_COST * (linked[self.spans[k][1]] - linked[self.spans[k][0]]) for k in blocks]
        low, high = best_run(worth)
        return "\n\n".join(self.said(k) for k, w in list(zip(blocks, worth, strict=True))[low:high] if w > 0)

    def body(self) -> str:
        return self.main

    def words(self) -> int:
        """As text.word_count of the body."""
        return len(self._collapsed.split(" ")) if self.main else 0

    def hash(self) -> str:
        """As text.content_hash of the body."""
        return sha256(self._collapsed.encode()).hexdigest()

    @property
    def _collapsed(self) -> str:
        """The body with single blanks; its blocks have no others."""
        return self.main.replace("\n\n", " ")

    def _linked(self) -> list[int]:
        """For each text its characters if it stands in a link, else 0."""
        inside = [0] * len(self.texts)
        for k in self.each("a"):
            for i in range(*self.spans[k]):
                inside[i] = len(self.texts[i])
        return inside

    def near(self, levels: int, most: int, pattern: re.Pattern | None, shortest: int) -> list[dict]:
        """For every link: the first fitting date and paragraph among its ancestors.

        Lengths come from sums, so only texts of `most` characters are put together.
        """
        found = []
        paragraphs = [k for k in self.each("p") if self.length(k) >= shortest]
        for k in self.each("a"):
            if not (href := self.attributes[k].get("href")):
                continue
            date = excerpt = None
            for u in islice(self.under(self.parents[k]), levels):
                if not 0 < self.length(u) <= most:
                    continue
                m = pattern.search(self.said(u)) if pattern else None
                if pattern and not m:
                    continue
                at = bisect_left(paragraphs, u)
                excerpt = self.said(paragraphs[at]) if at < len(paragraphs) and paragraphs[at] <= self.last[u] else None
                date = m[0] if m else None
                if m or excerpt:
                    break
            found.append({"href": href, "text": self.said(k), "date": date, "excerpt": excerpt})
        return found


def best_run(worth: list[float]) -> tuple[int, int]:
    """The run of greatest sum; the first of equal ones, (0, 0) where nothing is worth anything."""
    best, found, total, start = 0, (0, 0), 0, 0
    for i, w in enumerate(worth):
        if total <= 0:
            total, start = 0, i
        total += w
        if total > best:
            best, found = total, (start, i + 1)
    return found


_STRINGS = pa.list_(pa.string())


def _structs(*names: str) -> pa.DataType:
    return pa.list_(pa.struct([(n, _STRINGS if n == "rel" else pa.string()) for n in names]))


_FIELDS = {
    "metas": ("array<struct<property:string,name:string,content:string>>", _structs("property", "name", "content"), Page.metas),
    "links": ("array<struct<rel:array<string>,href:string>>", _structs("rel", "href"), Page.links),
    "times": ("array<struct<datetime:string,text:string>>", _structs("datetime", "text"), Page.times),
    "anchors": ("array<struct<href:string,text:string>>", _structs("href", "text"), Page.anchors),
    "scripts": ("array<string>", _STRINGS, lambda p: p.scripts),
    "h1": ("string", pa.string(), lambda p: p.first("h1")),
    "title": ("string", pa.string(), lambda p: p.first("title")),
    "text": ("string", pa.string(), Page.text),
    "shown": ("string", pa.string(), Page.shown),
    "body": ("string", pa.string(), Page.body),
    "words": ("bigint", pa.int64(), Page.words),
    "hash": ("string", pa.string(), Page.hash),
}


def parsed(html: Column, *fields: str, known: Collection[str] | None = None) -> Column:
    """struct of the named fields of a page: metas, links, times, anchors, scripts (JSON-LD), h1, title, text, shown, body, words (of the body), hash (of it). Null is an empty page. known: as in decoder."""
    ship(SparkSession.active())
    kind = pa.struct([(f, _FIELDS[f][1]) for f in fields])

    def run(pages: pa.Array) -> pa.Array:
        decode = decoder(known)
        read = [Page(p, decode) for p in pages.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([_FIELDS[f][2](p) for p in read], _FIELDS[f][1]) for f in fields], fields=list(kind))

    return F.arrow_udf(run, f"struct<{','.join(f'{f}:{_FIELDS[f][0]}' for f in fields)}>")(html)


def near(html: Column, levels: int, most: int, pattern: re.Pattern | None, shortest: int = 40) -> Column:
    """array<struct<href, text, date, excerpt>> of Page.near."""
    ship(SparkSession.active())
    kind = _structs("href", "text", "date", "excerpt")

    def run(pages: pa.Array) -> pa.Array:
        return pa.array([Page(p).near(levels, most, pattern, shortest) for p in pages.to_pylist()], kind)

    return F.arrow_udf(run, "array<struct<href:string,text:string,date:string,excerpt:string>>")(html)
