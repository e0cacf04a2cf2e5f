"""License scans by patience alignment (operator 1).

A text can cover a share t of a template of L words inside a window of some
more words only if that window holds t * L words of the template; such windows
are found by counting. In each, words that are unique in both the window and
the template are anchors; the longest increasing subsequence of their places is
kept, and the gaps between anchors are aligned in the same way. Coverage is the
share of the template's words that have found a partner.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

THRESHOLD = 0.8
#: A window may hold this many words for each word of the template.
SLACK = 1.25

#: Notices and license texts; placeholders for names and years are left out, so they cost no coverage.
TEMPLATES: dict[str, str] = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MPL-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    "SPDX-MIT": "SPDX-License-Identifier: MIT",
    "SPDX-Apache-2.0": "SPDX-License-Identifier: Apache-2.0",
    "SPDX-GPL-3.0": "SPDX-License-Identifier: GPL-3.0-or-later",
    "SPDX-BSD-3-Clause": "SPDX-License-Identifier: BSD-3-Clause",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        'You may obtain a copy of the License at. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "MIT": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, '
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. '
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
        "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. '
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
}

MATCH = "array<struct<license:string,coverage:double,matched:int,start:int,end:int>>"
_WORD = re.compile(r"[0-9]+(?:\.[0-9]+)+|[a-z0-9]+(?:[+-][a-z0-9]+)*")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def increasing(values: list[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence, by patience piles."""
    tops: list[int] = []
    at: list[int] = []
    back = [-1] * len(values)
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        if pile == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[pile], at[pile] = v, i
        back[i] = at[pile - 1] if pile else -1
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(text: list, template: list) -> list[tuple[int, int]]:
    """Partners (place in the text, place in the template), both increasing."""
    pairs: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and text[a0] == template[b0]:
            pairs.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and text[a1 - 1] == template[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            pairs.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        places: dict = {}
        for b in range(b0, b1):
            places[template[b]] = -1 if template[b] in places else b
        seen: dict = {}
        for a in range(a0, a1):
            seen[text[a]] = -1 if text[a] in seen else a
        anchors = [(a, places[w]) for w, a in seen.items() if a >= 0 and places.get(w, -1) >= 0]
        kept = [anchors[i] for i in increasing([b for _, b in anchors])]
        if not kept:
            continue
        pairs += kept
        edges = [(a0 - 1, b0 - 1), *kept, (a1, b1)]
        todo += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:]) if p + 1 < r and q + 1 < s]
    return sorted(pairs)


@dataclass
class Template:
    name: str
    ids: list[int]
    member: np.ndarray  # by word id
    window: int
    need: int


class Scanner:
    """Finds templates in texts. Words outside all templates have id 0."""

    def __init__(self, templates: Mapping[str, str], threshold: float):
        split = {name: words(text) for name, text in templates.items()}
        self.ids: dict[str, int] = {}
        for ws in split.values():
            for w in ws:
                self.ids.setdefault(w, len(self.ids) + 1)
        self.threshold = threshold
        self.templates = []
        for name, ws in split.items():
            if ws:
                ids = [self.ids[w] for w in ws]
                member = np.zeros(len(self.ids) + 1, bool)
                member[ids] = True
                self.templates.append(Template(name, ids, member, max(len(ws) + 1, math.ceil(SLACK * len(ws))), math.ceil(threshold * len(ws) - 1e-9)))

    def scan(self, text: str | None) -> list[tuple[str, float, int, int, int]]:
        """(license, coverage, matched words, first word, word after the last) of all matches, by first word, then name."""
        ws = words(text or "")
        if not ws:
            return []
        ids = np.fromiter(map(self.ids.get, ws, [0] * len(ws)), np.int64, len(ws))
        places = np.flatnonzero(ids)
        if not len(places):
            return []
        known = ids[places]
        out = []
        for t in self.templates:
            hits = places[t.member[known]]
            if len(hits) < t.need:
                continue
            # A window that starts at a hit and reaches the need-th hit after it.
            spread = hits[t.need - 1 :] - hits[: len(hits) - t.need + 1]
            starts = hits[: len(spread)][spread < t.window]
            if not len(starts):
                continue
            held = np.searchsorted(hits, starts + t.window) - np.searchsorted(hits, starts)
            taken: list[tuple[int, int]] = []
            used = np.zeros(len(ws), bool)
            for i in np.lexsort((starts, -held)):
                a = int(starts[i])
                b = min(a + t.window, len(ws))
                if used[a]:
                    continue
                # Another match may begin in the window: it ends there.
                b = a + int(used[a:b].argmax()) if used[a:b].any() else b
                if np.searchsorted(hits, b) - np.searchsorted(hits, a) < t.need:
                    continue
                pairs = align(ids[a:b].tolist(), t.ids)
                if len(pairs) >= t.need:
                    first, last = a + pairs[0][0], a + pairs[-1][0] + 1
                    taken.append((first, last))
                    used[first:last] = True
                    out.append((t.name, len(pairs) / len(t.ids), len(pairs), first, last))
        return sorted(out, key=lambda x: (x[3], x[0]))


def scan(df: DataFrame, text_col: str = "text", out_col: str = "licenses", templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with the licenses that a text holds as ``out_col``: array of (license, coverage, matched, start, end); places count words.

    Matches of one template do not overlap; those of different templates may.
    A null or empty text has none, long texts are scanned whole, repeated rows
    each; an empty table stays empty; an existing ``out_col`` is replaced, other
    columns pass through. Only licenses with a template are found: MIT and ISC by
    their full texts, others by the usual notice, file header or SPDX line.
    """
    templates = dict(templates)

    @F.pandas_udf(MATCH)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scanner = Scanner(templates, threshold)
        keys = ("license", "coverage", "matched", "start", "end")
        for texts in batches:
            yield pd.Series([[dict(zip(keys, m)) for m in scanner.scan(t)] for t in texts], dtype=object)

    return df.withColumn(out_col, found(common.col(text_col)))
