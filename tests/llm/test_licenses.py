"""License scans: phrases by plain search, templates by every reading of their markup and by worked cases."""

import random
import re

import pytest

from inkwell.llm import licenses
from tests.llm.helpers import documents

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def plain(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    found = sorted((at, label) for phrase, label in PHRASES.items() for at in range(len(words)) if words[at : at + len(phrase.split())] == phrase.split())
    return len(words), len(found), found[0][0] if found else None, found[-1][0] if found else None, ",".join(sorted({x for _, x in found}))


def test_base_against_plain(spark):
    rng = random.Random(6)
    bits = ["MIT", "mit", "License", "license", "Apache", "General", "Public", "\n", "-", "é", "x1", ".", "licenses", "(", "İ", "under the"]
    rows = [(k, " ".join(rng.choice(bits) for _ in range(rng.randrange(60)))) for k in range(200)] + [(500, None), (501, ""), (502, "mit-license" * 50_000), (7, "MIT License"), (7, "MIT License")]
    got = licenses.scan_licenses(documents(spark, rows, ("labels", "score"))).collect()
    assert sorted(map(str, [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got])) == sorted(str((i, *plain(t))) for i, t in rows)
    assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) for r in got)
    assert licenses.scan_licenses(documents(spark, [])).collect() == []


def labels(text):
    scanner = licenses.Scanner()
    return {label for base, label, _, _ in scanner.scan(licenses.words_of(text.encode())) if not base}


@pytest.mark.parametrize(
    "text, want",
    [
        ("Released under the MIT License.", {"mit-notice"}),
        ("this fine work is licensed under the terms of the MIT license", {"mit-notice"}),
        ("under the MIT licence", set()),
        ("Licensed under the Apache License, Version 2.0.", {"apache-2.0-notice"}),
        ("This work is licensed under the GNU General Public License, version 3", {"gpl-notice"}),
        ("under the GNU Affero General Public License", {"agpl-notice"}),
        ("under the terms of the GNU Lesser General Public License version 2.1", {"lgpl-notice"}),
        ("licensed under the GNU Library General Public License", {"lgpl-library-notice"}),
        ("released under the GNU GPL v3", {"gpl-short-notice"}),
        ("SPDX-License-Identifier: BSD-3-Clause", {"spdx-identifier"}),
        ("licensed under the 3-clause BSD license", {"bsd-notice"}),
        ("available under the Mozilla Public License", {"mpl-notice"}),
        ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", {"mpl-2.0-header"}),
        ("Distributed under the Boost Software License, Version 1.0.", {"boost-notice"}),
        ("licensed under the Creative Commons Attribution-ShareAlike 4.0 International License", {"cc-by-notice"}),
        ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.", {"cc0-notice"}),
        ("the GPL, the Boost library and Mozilla", set()),
        ("under the GNU wild General Public License", set()),
    ],
)
def test_templates(text, want):
    assert labels(text) == want


def test_mandatory_wording_must_match_word_for_word():
    for label, template in licenses.TEMPLATES.items():
        bare = re.sub(r"<<var;name=\w+;words=(\d+)\.\.\d+>>", lambda m: "anything " * int(m[1]), template)
        whole = re.sub("<<(begin|end)Optional>>", " ", bare)
        least = re.sub("<<beginOptional>>((?!<<beginOptional>>).)*?<<endOptional>>", " ", re.sub("<<beginOptional>>((?!<<beginOptional>>).)*?<<endOptional>>", " ", bare))
        assert label in labels(whole) and label in labels(f"so {least} end")
        words = least.split()
        for k in range(1, len(words)):  # a word more anywhere but at a replaceable region
            if "anything" not in words[k - 1 : k + 1]:
                assert label not in labels(" ".join([*words[:k], "zzz", *words[k:]])), (label, k)


def test_replaceable_regions_have_bounds():
    a = licenses.compile_template("x", "copyright <<var;name=who;words=1..3>> all rights <<beginOptional>>are <<beginOptional>>hereby<<endOptional>><<endOptional>> reserved")
    end = lambda t: a.longest(licenses.words_of(t.encode()), 0)
    assert [end(f"copyright {'w ' * n}all rights reserved") for n in range(5)] == [-1, 5, 6, 7, -1]
    assert end("copyright all all rights are reserved") == 6 and end("copyright a all rights are hereby reserved") == 7 and end("copyright a all rights hereby reserved") == -1


@pytest.mark.parametrize("bad", ["a <<beginOptional>> b", "<<var;name=x;words=0..2>> a", "<<beginOptional>>a<<endOptional>>"])
def test_templates_without_an_anchor_are_refused(bad):
    with pytest.raises(ValueError):
        licenses.compile_template("x", bad)


def plain_ends(template, words, at):
    """Where places that start at `at` may end, by trying every reading of the template one after another."""
    marks = re.compile(r"<<(?:(beginOptional)|(endOptional)|var;name=\w+;words=(\d+)\.\.(\d+))>>")

    def parse(pos, inside):
        items = []
        while pos < len(template):
            m = marks.search(template, pos)
            items += [("word", w) for w in licenses.words_of(template[pos : m.start() if m else None].encode())]
            if not m:
                return items, len(template)
            pos = m.end()
            if m[1]:
                inner, pos = parse(pos, True)
                items.append(("optional", inner))
            elif m[2]:
                return items, pos
            else:
                items.append(("any", int(m[3]), int(m[4])))
        return items, pos

    def ends(items, starts):
        for item in items:
            if item[0] == "word":
                starts = {s + 1 for s in starts if s < len(words) and words[s] == item[1]}
            elif item[0] == "any":
                starts = {s + n for s in starts for n in range(item[1], item[2] + 1) if s + n <= len(words)}
            else:
                starts = starts | ends(item[1], starts)
        return starts

    return ends(parse(0, False)[0], {at})


def test_automata_against_every_reading():
    rng = random.Random(8)
    templates = {
        "a": "a <<beginOptional>>b <<beginOptional>>c<<endOptional>><<endOptional>> <<var;name=x;words=0..2>> d",
        "b": "<<beginOptional>>a<<endOptional>> b <<beginOptional>>b c<<endOptional>> <<var;name=x;words=1..2>> <<beginOptional>>d<<endOptional>> a",
        "c": "a b <<var;name=x;words=1..3>> <<var;name=y;words=1..1>> c",
    }
    for label, template in templates.items():
        a = licenses.compile_template(label, template)
        for _ in range(600):
            words = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randrange(12))]
            for at in range(len(words)):
                assert a.longest(words, at) == max(plain_ends(template, words, at), default=-1), (template, words, at)
    for label, template in licenses.TEMPLATES.items():
        words = [w for w in licenses.words_of(re.sub("<<[^>]*>>", " it ", template).encode())]
        a = licenses.compile_template(label, template)
        for at in range(0, len(words), 7):
            assert a.longest(words, at) == max(plain_ends(template, words, at), default=-1)


@pytest.mark.parametrize("label", ["mit-text", "bsd-2-clause", "bsd-3-clause", "isc-text", "gpl-header", "apache-2.0-header", "mpl-2.0-header", "unlicense-text", "zlib-text", "boost-text"])
def test_a_text_without_its_last_part_is_not_that_license(label):
    whole = re.sub(r"<<var;name=\w+;words=(\d+)\.\.\d+>>", lambda m: "anyone " * int(m[1]), re.sub("<<(begin|end)Optional>>", " ", licenses.TEMPLATES[label]))
    assert label in labels(whole)
    sentences = [x for x in re.split(r"\. (?=[A-Z])", re.sub(r"\b[123]\. ", "", whole)) if x]
    assert len(sentences) > 1
    for k in range(len(sentences)):
        assert label not in labels(". ".join(sentences[:k] + sentences[k + 1 :]))
    words = whole.split()
    assert label not in labels(" ".join(words[: len(words) * 3 // 4]))
