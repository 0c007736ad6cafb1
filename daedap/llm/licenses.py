"""License notices in documents, by fingerprints and banded alignment.

Templates are cut into runs of three words, in an inverted index; of templates over
``LONG`` words, only the run with the smallest hash of every three neighbors. All runs of
a document are looked up. Equal runs name a template and where it would begin; places
that agree are one candidate, and its words are aligned to the template's in a band
around. Any three words (five of a long template) that stand in both unchanged are seen.

A template's family and version ("gnu general public license", "version 3") have to stand
in the document word by word, or it is another license. The first two words of the family
are in the index too, so that no word of a short template but these has to stand beside
its neighbor. Of matches at one place, that with the most matched words, missing ones taken
off, is reported.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daedap.llm.shingles import windows, word_hashes

RUN, KEEP = 3, 3
LEAST_COVERAGE = 0.8
LONG = 200  # words of the longest template that is indexed in full
SHORT = 20  # words of the longest one of which every two words are indexed, if it has no family
GAP = 0.25  # what a skipped or foreign word costs, a matching one gaining 1

# Templates travel with every task; more than this is refused.
MOST_TEMPLATE_BYTES = 32_000_000

WORD = re.compile(rb"[a-z0-9\x80-\xff]+")

# Wordings of public licenses and notices.
TEMPLATES = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "MIT line": "Released under the MIT License.",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0.",
    "Apache-2.0 notice": """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
        file except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under
        the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY
        KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License.""",
    "MIT": """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify,
        merge, publish, distribute, sublicense, and/or sell copies of the Software, and to
        permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice shall be included
        in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
        "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED
        TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND
        NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
        CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS
        IN THE SOFTWARE.""",
    "ISC": """
        Permission to use, copy, modify, and/or distribute this software for any purpose with
        or without fee is hereby granted, provided that the above copyright notice and this
        permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR
        DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES
        OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
        DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
        LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER
        TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
        SOFTWARE.""",
    "GPL-3.0 notice": """
        This program is free software: you can redistribute it and/or modify it under the terms
        of the GNU General Public License as published by the Free Software Foundation, either
        version 3 of the License, or (at your option) any later version. This program is
        distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
        the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "CC-BY-4.0 line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0 line": "Licensed under CC BY-SA 4.0.",
}


def _gnu(name: str, version: str, program: str = "program") -> str:
    either = f"either version {version} of the License, or (at your option) any later version"
    return f"""
        This {program} is free software: you can redistribute it and/or modify it under the
        terms of the GNU {name} as published by the Free Software Foundation; {either}.
        This {program} is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
        PARTICULAR PURPOSE. See the GNU {name} for more details. You should have received a copy
        of the GNU {name} along with this {program}."""


def _bsd(*conditions: str) -> str:
    each = " ".join(f"{i}. {c}" for i, c in enumerate(conditions, 1))
    return f"""
        Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met: {each}
        THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY
        EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
        THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
        SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT
        OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
        INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
        LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
        OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""


_GPL, _LESSER, _LIBRARY, _AFFERO = (
    f"{n}General Public License" for n in ("", "Lesser ", "Library ", "Affero ")
)
_SOURCE = """Redistributions of source code must retain the above copyright notice, this list of
    conditions and the following disclaimer."""
_BINARY = """Redistributions in binary form must reproduce the above copyright notice, this list of
    conditions and the following disclaimer in the documentation and/or other materials provided
    with the distribution."""
_NAMES = """Neither the name of the copyright holder nor the names of its contributors may be used
    to endorse or promote products derived from this software without specific prior written
    permission."""
_CREDIT = """All advertising materials mentioning features or use of this software must display the
    following acknowledgement: This product includes software developed by the organization."""

# More families and versions, named as in the SPDX list.
MORE_TEMPLATES = {
    "GPL-1.0 notice": _gnu(_GPL, "1"),
    "GPL-2.0 notice": _gnu(_GPL, "2"),
    "LGPL-2.0 notice": _gnu(_LIBRARY, "2", "library"),
    "LGPL-2.1 notice": _gnu(_LESSER, "2.1", "library"),
    "LGPL-3.0 notice": _gnu(_LESSER, "3"),
    "AGPL-3.0 notice": _gnu(_AFFERO, "3"),
    **{
        f"{short}-{version} line": f"This work is licensed under the GNU {name}, version {text}."
        for short, name, version, text in (
            ("GPL", _GPL, "1.0", "1"),
            ("GPL", _GPL, "2.0", "2"),
            ("LGPL", _LIBRARY, "2.0", "2"),
            ("LGPL", _LESSER, "2.1", "2.1"),
            ("LGPL", _LESSER, "3.0", "3"),
            ("AGPL", _AFFERO, "3.0", "3"),
        )
    },
    "BSD-2-Clause": _bsd(_SOURCE, _BINARY),
    "BSD-3-Clause": _bsd(_SOURCE, _BINARY, _NAMES),
    "BSD-4-Clause": _bsd(_SOURCE, _BINARY, _CREDIT, _NAMES),
    "BSD-2-Clause line": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause line": "Released under the BSD 3-Clause License.",
    "Apache-1.1 line": "Licensed under the Apache License, Version 1.1.",
    "ISC line": "Released under the ISC License.",
    "MPL-1.1 notice": """
        The contents of this file are subject to the Mozilla Public License Version 1.1 (the
        "License"); you may not use this file except in compliance with the License. You may
        obtain a copy of the License at http://www.mozilla.org/MPL/""",
    "MPL-2.0 notice": """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a
        copy of the MPL was not distributed with this file, You can obtain one at
        http://mozilla.org/MPL/2.0/.""",
    "EPL-1.0 notice": """
        All rights reserved. This program and the accompanying materials are made available under
        the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is
        available at http://www.eclipse.org/legal/epl-v10.html""",
    "EPL-2.0 notice": """
        This program and the accompanying materials are made available under the terms of the
        Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/""",
    "MPL-2.0 line": "Licensed under the Mozilla Public License, version 2.0.",
    "EPL-1.0 line": "Licensed under the Eclipse Public License, version 1.0.",
    "EPL-2.0 line": "Licensed under the Eclipse Public License, version 2.0.",
    "CC0-1.0 line": "Licensed under CC0 1.0 Universal.",
    **{
        f"CC-{kind.replace(' ', '-')}-{v} line": f"Licensed under CC {kind} {v}."
        for kind in ("BY", "BY SA", "BY ND", "BY NC", "BY NC SA", "BY NC ND")
        for v in ("3.0", "4.0")
        if (kind, v) not in (("BY", "4.0"), ("BY SA", "4.0"), ("BY NC", "4.0"))
    },
}

# Whole texts of public licenses, a file each.
TEXTS = Path(__file__).parent / "license_texts"


def all_templates() -> dict[str, str]:
    """The notices, and the whole texts as "NAME text"."""
    texts = {f"{p.stem} text": p.read_text("utf-8") for p in sorted(TEXTS.glob("*.txt"))}
    return TEMPLATES | MORE_TEMPLATES | texts


# Names of licenses, and versions, that have to match; looked for near a template's begin.
FAMILY = re.compile(
    rb"gnu (?:(?:lesser|library|affero) )?general public license|gnu free documentation license"
    rb"|(?:apache|mit|isc|mozilla public|eclipse public|sil open font) license"
    rb"|bsd \d clause|cc0 \d \d|cc by(?: (?:nc|nd|sa))* \d \d"
    rb"|attribution(?: (?:noncommercial|noderivatives|sharealike))* \d \d"
)
VERSION = re.compile(rb"\b(?:version|v\.?)\s*\d+(?:\.\d+)*")
BARE_VERSION = re.compile(VERSION.pattern + rb"|\b\d+\.\d+\b")  # whole texts number their parts so
KEY_WORDS = 60

# What makes another version of a number it follows; zeros do not.
LONGER = re.compile(rb"\.(?!0+(?![0-9]))[0-9]")

MATCHES = (
    "doc_id long, license string, coverage double, matched_words int, start long, end long"
)


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of a text in UTF-8, and the bytes where each begins and ends."""
    found = list(WORD.finditer(data.lower()))
    spans = np.array([m.span() for m in found], np.int64).reshape(-1, 2)
    return word_hashes([m.group() for m in found]), spans[:, 0], spans[:, 1]


def winnowed(words: np.ndarray) -> np.ndarray:
    """Where fingerprints stand: the smallest hash of ``KEEP`` neighbors, the last of equals."""
    runs = windows(words, RUN)
    if len(runs) <= KEEP:
        return np.array([len(runs) - 1 - np.argmin(runs[::-1])]) if len(runs) else np.zeros(0, int)
    near = np.lib.stride_tricks.sliding_window_view(runs, KEEP)[:, ::-1]
    return np.unique(np.arange(len(near)) + KEEP - 1 - np.argmin(near, 1))


def keys_of(data: bytes) -> tuple[list[list[range]], list[int]]:
    """Where each name and version of a template stands, and where the names begin.

    They are those among its first ``KEY_WORDS`` words, with all their places in words.
    """
    found = [m for m in WORD.finditer(data.lower())]
    words = [m.group() for m in found]
    begin = words[:KEY_WORDS]
    head = data.lower()[: found[len(begin) - 1].end()] if begin else b""
    names = {tuple(m.group().split()) for m in FAMILY.finditer(b" ".join(begin))}
    version = VERSION if len(words) > LONG else BARE_VERSION
    versions = {tuple(WORD.findall(m.group())) for m in version.finditer(head)}

    def places(key: tuple) -> list[range]:
        n = len(key)
        return [range(i, i + n) for i in range(len(words) - n + 1) if tuple(words[i : i + n]) == key]

    each = [places(k) for k in sorted(names | versions)]
    return [p for p in each if p], sorted(p.start for k in names for p in places(k))


class Index:
    """Runs of words of templates, each with the templates and places it stands at."""

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        self.words, self.keys = [], []
        rows: dict[int, list] = {2: [], RUN: []}
        for t, name in enumerate(self.names):
            data = templates[name].encode()
            words = words_of(data)[0]
            keys, named = keys_of(data)
            self.words.append(words)
            self.keys.append(keys)
            n = len(words) - RUN + 1
            at = {RUN: winnowed(words).tolist() if len(words) > LONG else range(max(n, 0))}
            at[2] = named if named or len(words) > SHORT else range(max(n + 1, 0))
            for size, places in at.items():
                runs = windows(words, size)
                rows[size] += [(int(runs[i]), t, i) for i in places if len(words) >= RUN]
        self.known = [np.unique(w) for w in self.words]
        self.prints, self.places = {}, {}
        for size, found in rows.items():
            found.sort()
            self.prints[size] = np.array([r[0] for r in found], np.uint64)
            self.places[size] = [r[1:] for r in found]

    def candidates(self, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Templates, and from which to which word of the document each would begin."""
        begins: dict[int, set[int]] = {}
        for size, prints in self.prints.items():
            runs = windows(words, size)
            first = np.searchsorted(prints, runs)
            hits = np.flatnonzero(prints[np.minimum(first, len(prints) - 1)] == runs) if len(prints) else []
            for i in hits:
                k = first[i]
                while k < len(prints) and prints[k] == runs[i]:
                    template, place = self.places[size][k]
                    begins.setdefault(template, set()).add(int(i) - place)
                    k += 1
        for template, found in begins.items():
            band = self.band(template)
            low = high = None
            for begin in sorted(found):
                # Long stretches of begins are looked at piece by piece.
                if low is None or begin > high + band or begin > low + 8 * band:
                    if low is not None:
                        yield template, low, high
                    low = begin
                high = begin
            yield template, low, high

    def may_cover(self, template: int, words: np.ndarray, low: int, high: int, least: float) -> bool:
        """Whether enough words of the stretch are in the template at all."""
        n = len(self.words[template])
        near = words[max(low, 0) : max(high + n, 0)]
        known = self.known[template]
        return (known[np.minimum(np.searchsorted(known, near), len(known) - 1)] == near).sum() >= least * n

    def is_license(self, template: int, pairs: list[tuple[int, int]], ends: np.ndarray, data: bytes) -> bool:
        """At least half of the places of each name and version stand there word by word."""
        at = dict(pairs)

        def stands(place: range) -> bool:
            first = at.get(place.start)
            if first is None or any(at.get(i) != first + i - place.start for i in place):
                return False
            end = int(ends[first + len(place) - 1])
            return not (data[end - 1 : end].isdigit() and LONGER.match(data, end))

        return all(2 * sum(map(stands, places)) >= len(places) for places in self.keys[template])

    def band(self, template: int) -> int:
        return max(2, len(self.words[template]) // 8)


def aligned(template: np.ndarray, words: np.ndarray, low: int, high: int) -> list[tuple[int, int]]:
    """Best alignment of a template to a stretch of words, as pairs of equal words.

    Template word i may stand at words ``i + low`` to ``i + high``. A pair gains 1; words
    skipped between pairs, in either, cost ``GAP`` each, those before the first and
    behind the last cost nothing.
    """
    width = high - low + 1
    score = np.zeros(width)
    best, at = 0.0, (0, 0)
    step = np.zeros((len(template) + 1, width), np.int8)  # 1 pair, 2 skip word, 3 skip template
    slope = GAP * np.arange(width)
    # Begins with what stands around the text, which equals no word of a template.
    padded = np.full(len(template) + width, -1, np.int64)
    inside = np.zeros(len(padded), bool)
    first, last = max(low, 0), min(low + len(padded), len(words))
    if last > first:
        padded[first - low : last - low] = words[first:last].view(np.int64)
        inside[first - low : last - low] = True
    for i, word in enumerate(template.view(np.int64), 1):
        equal = (padded[i - 1 : i - 1 + width] == word) & inside[i - 1 : i - 1 + width]
        pair = np.where(equal, score + 1, -np.inf)
        up = np.append(score[1:] - GAP, -np.inf)
        own = np.maximum(np.maximum(pair, up), 0.0)
        score = np.maximum.accumulate(own + slope) - slope
        left = np.append(-np.inf, score[:-1] - GAP)
        step[i] = np.where(up == score, 3, np.where(left == score, 2, np.where(pair == score, 1, 0)))
        k = int(np.argmax(score))
        if score[k] > best:
            best, at = score[k], (i, k)
    i, k = at
    pairs = []
    while step[i, k]:
        if step[i, k] == 1:
            pairs.append((int(i) - 1, int(i) - 1 + low + int(k)))
            i -= 1
        elif step[i, k] == 2:
            k -= 1
        else:
            i, k = i - 1, k + 1
    return pairs[::-1]


def scan(index: Index, data: bytes, least: float) -> list[tuple[str, float, int, int, int]]:
    """License, coverage, matched words, and from which to which byte, of each notice.

    The best-fitting template of each place is reported.
    """
    words, starts, ends = words_of(data)
    found = set()
    for template, low, high in index.candidates(words):
        band, n = index.band(template), len(index.words[template])
        if not index.may_cover(template, words, low - band, high + band, least):
            continue
        pairs = aligned(index.words[template], words, low - band, high + band)
        coverage = len(pairs) / n
        if pairs and coverage >= least and index.is_license(template, pairs, ends, data):
            span = int(starts[pairs[0][1]]), int(ends[pairs[-1][1]])
            found.add((len(pairs) - n, len(pairs), *span, index.names[template]))
    kept: list[tuple] = []
    # One that lies in a better one for more than half is the same place.
    for one in sorted(found, key=lambda f: (-f[0] - f[1], *f[2:])):
        _, _, begin, end, _ = one
        if all(
            2 * (min(end, e) - max(begin, b)) <= min(end - begin, e - b) for _, _, b, e, _ in kept
        ):
            kept.append(one)
    rows = [(name, n / (n - less), n, b, e) for less, n, b, e, name in kept]
    return sorted(rows, key=lambda f: (f[3], f[0], f[4]))


def license_matches(
    docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST_COVERAGE
) -> DataFrame:
    """License notices and texts in whole texts of ``docs(doc_id, text)``, one row each.

    ``coverage`` is the part of the template's words that is there in order, ``start`` and
    ``end`` count the text's characters. A template of less than three words is never
    found. Null and empty texts have no notices; null ids are kept, rows that repeat
    an id give their notices again. Raises ValueError if the templates are too large
    to travel with every task.
    """
    templates = all_templates() if templates is None else templates
    size = sum(len(t.encode()) for t in templates.values())
    if size > MOST_TEMPLATE_BYTES:
        raise ValueError(f"templates of {size} bytes; at most {MOST_TEMPLATE_BYTES} are allowed")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(templates)
        for batch in batches:
            rows = []
            keys, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
            for key, data in zip(keys, texts.to_pylist()):
                for name, coverage, n, begin, end in scan(index, data or b"", least):
                    before = len(data[:begin].decode("utf-8", "replace"))
                    length = len(data[begin:end].decode("utf-8", "replace"))
                    rows.append((key, name, coverage, n, before, before + length))
            types = (pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int64(), pa.int64())
            columns = zip(*rows) if rows else [()] * len(types)
            names = [c.split()[0] for c in MATCHES.split(", ")]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, MATCHES)
