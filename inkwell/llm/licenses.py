"""License scans by template markup.

A template is license wording with two kinds of marked regions:

- ``<<beginOptional>> ... <<endOptional>>``: wording that may be absent;
- ``<<var;name=copyright;words=1..20>>``: a region that any words may replace.

Each template compiles to a token automaton. A place in a text is accepted
when the mandatory wording stands there exactly, word for word; optional and
replaceable regions may differ as marked. Automata are simulated as sets of
states held in the bits of an integer, with the steps taken so far memoised.

Defined cases: a null text is empty; a document without id is answered like any
other; an empty text has no words, no places and
a score of 0; places may overlap and all count; repeated rows are answered one
by one; extra columns of the input are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from inkwell.llm.common import WORD_TABLE, only, out, texts
from inkwell.session import ship, table

# The base phrases and their labels.
BASE = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Public license wording, marked up, each with all of its mandatory parts. Label -> template.
_NOTICE = "<<beginOptional>>this <<var;name=work;words=1..3>> is<<endOptional>> <<beginOptional>>released<<endOptional>> <<beginOptional>>licensed<<endOptional>> under the <<beginOptional>>terms of the<<endOptional>> "
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "<<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "<<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_NAMES = (
    "<<beginOptional>>3.<<endOptional>> Neither the name of <<var;name=owner;words=1..12>> nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. "
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY <<var;name=holder;words=1..12>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. '
    "IN NO EVENT SHALL <<var;name=liable;words=1..12>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
TEMPLATES = {
    "mit-notice": _NOTICE + "MIT license",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
        "IN NO EVENT SHALL <<var;name=holders;words=1..12>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "apache-2.0-notice": "licensed under the Apache License<<beginOptional>>, Version 2.0<<endOptional>> <<beginOptional>>(the \"License\")<<endOptional>>",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at <<var;name=url;words=1..12>> "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "gpl-notice": _NOTICE + "GNU General Public License <<beginOptional>>version <<var;name=version;words=1..2>><<endOptional>>",
    "lgpl-notice": _NOTICE + "GNU Lesser General Public License <<beginOptional>>version <<var;name=version;words=1..2>><<endOptional>>",
    "lgpl-library-notice": _NOTICE + "GNU Library General Public License <<beginOptional>>version <<var;name=version;words=1..2>><<endOptional>>",
    "agpl-notice": _NOTICE + "GNU Affero General Public License <<beginOptional>>version <<var;name=version;words=1..2>><<endOptional>>",
    "gpl-short-notice": _NOTICE + "GNU GPL <<beginOptional>><<var;name=version;words=1..1>><<endOptional>>",
    "spdx-identifier": "SPDX-License-Identifier: <<var;name=identifier;words=1..4>>",
    "bsd-notice": _NOTICE + "<<beginOptional>>new<<endOptional>> <<beginOptional>>simplified<<endOptional>> <<beginOptional>>2<<endOptional>> <<beginOptional>>3<<endOptional>> <<beginOptional>>clause<<endOptional>> BSD license",
    "mpl-notice": _NOTICE + "Mozilla Public License",
    "cc-by-notice": _NOTICE + "Creative Commons Attribution <<var;name=kind;words=1..5>> License",
    "boost-notice": "Distributed under the Boost Software License, Version 1.0",
    "mpl-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
        "If a copy of the MPL was not distributed with this file, You can obtain one at <<var;name=url;words=1..12>>"
    ),
    "cc0-notice": "To the extent possible under law, <<var;name=author;words=1..16>> waived all copyright and related or neighboring rights to <<var;name=work;words=1..16>>",
    "unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. "
        "We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
        "IN NO EVENT SHALL <<var;name=holders;words=1..12>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the <<var;name=authors;words=1..6>> be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
        "<<beginOptional>>1.<<endOptional>> The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. "
        "<<beginOptional>>2.<<endOptional>> Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. "
        "<<beginOptional>>3.<<endOptional>> This notice may not be removed or altered from any source distribution."
    ),
    "boost-text": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") "
        "to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: "
        "The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, "
        "unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor. "
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. "
        "IN NO EVENT SHALL <<var;name=holders;words=1..16>> BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "gpl-header": (
        "This program is free software<<beginOptional>>:<<endOptional>> you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version <<var;name=version;words=1..3>> of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. "
        "You should have received a copy of the GNU General Public License along with this program. If not, <<var;name=where;words=1..24>>"
    ),
    "bsd-2-clause": _BSD_HEAD + _BSD_END,
    "bsd-3-clause": _BSD_HEAD + _BSD_NAMES + _BSD_END,
    "isc-text": (
        "Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. "
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
}

_MARK = re.compile(r"<<(beginOptional|endOptional|var;name=(\w+);words=(\d+)\.\.(\d+))>>")


def words_of(text: bytes | None) -> list[bytes]:
    """A-Z lower-cased, then the runs of letters, digits and non-ASCII."""
    return (text or b"").translate(WORD_TABLE).split()


@dataclass
class Automaton:
    """States 0..n; a state has steps by word, steps by any word and free steps."""

    label: str
    steps: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    anyword: list[int] = field(default_factory=lambda: [0])
    free: list[int] = field(default_factory=lambda: [0])
    memo: dict[tuple[int, bytes], int] = field(default_factory=dict)
    accept: int = 0

    def _new(self) -> int:
        self.steps.append({})
        self.anyword.append(0)
        self.free.append(0)
        return len(self.steps) - 1

    def finish(self, end: int) -> Automaton:
        self.accept = 1 << end
        self.start = self._close(1)
        self.first = {w for s in self._bits(self.start) for w in self.steps[s]}
        if any(self.anyword[s] for s in self._bits(self.start)) or self.start & self.accept:
            raise ValueError(f"{self.label}: a template begins with wording that is not replaceable")
        self.words = {w for s in self.steps for w in s}
        return self

    @staticmethod
    def _bits(mask: int) -> Iterator[int]:
        while mask:
            low = mask & -mask
            yield low.bit_length() - 1
            mask ^= low

    def _close(self, mask: int) -> int:
        todo = mask
        while todo:
            more = 0
            for s in self._bits(todo):
                more |= self.free[s]
            todo = more & ~mask
            mask |= more
        return mask

    def step(self, mask: int, word: bytes) -> int:
        key = (mask, word if word in self.words else b"")
        to = self.memo.get(key)
        if to is None:
            to = 0
            for s in self._bits(mask):
                to |= self.anyword[s] | self.steps[s].get(word, 0)
            to = self._close(to)
            if len(self.memo) > 50_000:
                self.memo.clear()
            self.memo[key] = to
        return to

    def longest(self, words: list[bytes], at: int) -> int:
        """Where the longest accepted place that starts at `at` ends, or -1."""
        mask, end = self.start, -1
        for i in range(at, len(words)):
            mask = self.step(mask, words[i])
            if not mask:
                break
            if mask & self.accept:
                end = i + 1
        return end


def compile_template(label: str, template: str) -> Automaton:
    """Template markup to automaton; optional regions may nest."""
    a = Automaton(label)
    now, open_at, at = 0, [], 0

    def literal(text: str) -> None:
        nonlocal now
        for w in words_of(text.encode()):
            new = a._new()
            a.steps[now][w] = a.steps[now].get(w, 0) | 1 << new
            now = new

    for m in _MARK.finditer(template):
        literal(template[at : m.start()])
        at = m.end()
        if m[1] == "beginOptional":
            new = a._new()
            a.free[now] |= 1 << new
            now = new
            open_at.append(now)
        elif m[1] == "endOptional":
            new = a._new()
            a.free[now] |= 1 << new
            a.free[open_at.pop()] |= 1 << new
            now = new
        else:
            least, most = int(m[3]), int(m[4])
            ends = [now] if not least else []
            for k in range(1, most + 1):
                new = a._new()
                a.anyword[now] |= 1 << new
                now = new
                if k >= least:
                    ends.append(now)
            last = a._new()
            for e in ends:
                a.free[e] |= 1 << last
            now = last
    literal(template[at:])
    if open_at:
        raise ValueError(f"{label}: an optional region is not closed")
    return a.finish(now)


class Scanner:
    """All automata by the words that can begin them."""

    def __init__(self, base: dict[str, str] = BASE, templates: dict[str, str] = TEMPLATES):
        self.base = [compile_template(label, phrase) for phrase, label in base.items()]
        self.more = [compile_template(label, t) for label, t in templates.items()]
        self.by_first: dict[bytes, list[tuple[bool, Automaton]]] = {}
        for is_base, all_of in ((True, self.base), (False, self.more)):
            for a in all_of:
                for w in a.first:
                    self.by_first.setdefault(w, []).append((is_base, a))

    def scan(self, words: list[bytes]) -> Iterator[tuple[bool, str, int, int]]:
        """(base, label, start, end) of every accepted place, in order of start."""
        by_first = self.by_first
        for at in [i for i, w in enumerate(words) if w in by_first]:
            for is_base, a in by_first[words[at]]:
                if (end := a.longest(words, at)) >= 0:
                    yield is_base, a.label, at, end


SCHEMA = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
)


def scan_licenses(docs: DataFrame, base: dict[str, str] = BASE, templates: dict[str, str] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """License places of every document, one row each.

    score is the share of a document's words that stand in an accepted place.
    No shuffle: each text is read once where it lies.
    """
    ship(docs.sparkSession)

    def run(batches):
        scanner = Scanner(base, templates)
        for part, all_texts in texts(batches):
            got: dict[str, list] = {f.name: [] for f in _ARROW}
            for text in all_texts:
                words = words_of(text)
                base_at, base_labels, labels, covered, reach = [], set(), set(), 0, 0
                for is_base, label, start, end in scanner.scan(words):
                    labels.add(label)
                    if is_base:
                        base_at.append(start)
                        base_labels.add(label)
                    covered += max(0, end - max(start, reach))
                    reach = max(reach, end)
                got["n_words"].append(len(words))
                got["n_base"].append(len(base_at))
                got["first_word"].append(base_at[0] if base_at else None)
                got["last_word"].append(base_at[-1] if base_at else None)
                got["base_labels"].append(",".join(sorted(base_labels)))
                got["labels"].append(",".join(sorted(labels)))
                got["score"].append(covered / len(words) if words else 0.0)
            got["doc_id"] = part.column(0)
            yield out(_ARROW, got)

    return only(docs, doc_id=id_col, text=text_col).mapInArrow(run, SCHEMA)


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
