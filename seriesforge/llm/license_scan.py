"""License scans by patience alignment.

A template is found in a text by aligning the two word by word: words that occur once in both are
anchors, the longest increasing run of anchors is kept, and the gaps between are aligned in the same
way, after their common ends are matched. Coverage is the share of the template's words that align.

A text may be long and hold a template many times, which would leave no word unique. So alignment
looks at windows: an occurrence of one of the template's rarer words implies where the template would
start. It is the first anchor, so copies on either side of a window leave no word in doubt. The window is first the
template's own, then reaches a slack beyond it on both sides, twice as far each time: up to twice the
template's length, and on as long as coverage grows. Enough words are taken as
rare that a text which covers the template must hold at least one of them: no match is lost by it.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesforge.llm.common import documents, slices

COVERAGE = 0.8

_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
_BSD_TAIL = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)


def _gnu(kind: str, version: str) -> str:
    return (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        f"{kind} Public License as published by the Free Software Foundation, either version {version} of the License, or (at "
        "your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU "
        f"{kind} Public License for more details. You should have received a copy of the GNU {kind} Public License along "
        "with this program. If not, see https://www.gnu.org/licenses/"
    )


#: Notices looked for by default; a parameter. One-liners with their neighbours, then whole short licences and
#: the whole headers that the long ones ask for.
TEMPLATES: dict[str, str] = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "Proprietary": "All rights reserved.",
    "ISC": "Released under the ISC License.",
    "BSD": "Released under the BSD License.",
    "Unlicense": "Released under the Unlicense.",
    "MPL-2.0": "Licensed under the Mozilla Public License, Version 2.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software. " + _WARRANTY + " IN "
        "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
        "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE."
    ),
    "BSD-2-Clause": _BSD_HEAD + _BSD_TAIL,
    "BSD-3-Clause": _BSD_HEAD + (
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission. "
    ) + _BSD_TAIL,
    "ISC-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES '
        "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
        "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE."
    ),
    "Unlicense-text": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors "
        "of this software dedicate any and all copyright interest in the software to the public domain. We make this "
        "dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this "
        "dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under "
        "copyright law. " + _WARRANTY + " IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
        "OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote "
        "the original software. If you use this software in a product, an acknowledgment in the product documentation would be "
        "appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
        "distribution."
    ),
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."
    ),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "CC0-1.0-notice": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to "
        "this software to the public domain worldwide. This software is distributed without any warranty. You should have "
        "received a copy of the CC0 Public Domain Dedication along with this software. If not, see "
        "http://creativecommons.org/publicdomain/zero/1.0/."
    ),
    "GPL-header": _gnu("General", "3"),
    "GPL-2.0-header": _gnu("General", "2"),
    "LGPL-header": _gnu("Lesser General", "3"),
    "AGPL-header": _gnu("Affero General", "3"),
}

_WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _increasing(pairs: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs, in order of the first number, whose second numbers increase: patience piles."""
    tops: list[int] = []
    top_pair: list[int] = []
    before = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        if pile:
            before[k] = top_pair[pile - 1]
        if pile == len(tops):
            tops.append(j)
            top_pair.append(k)
        else:
            tops[pile], top_pair[pile] = j, k
    out, k = [], top_pair[-1] if top_pair else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def align(text: Sequence[str], template: Sequence[str]) -> list[tuple[int, int]]:
    """Aligned (text word, template word) positions, increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and text[a0] == template[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and text[a1 - 1] == template[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        here: dict[str, list[int]] = {}
        for i in range(a0, a1):
            here.setdefault(text[i], []).append(i)
        there: dict[str, list[int]] = {}
        for j in range(b0, b1):
            there.setdefault(template[j], []).append(j)
        unique = sorted((here[w][0], js[0]) for w, js in there.items() if len(js) == 1 and len(here.get(w, ())) == 1)
        anchors = _increasing(unique)
        out += anchors
        if anchors:
            for (i, j), (k, m) in zip([(a0 - 1, b0 - 1), *anchors], [*anchors, (a1, b1)]):
                if i + 1 < k and j + 1 < m:
                    todo.append((i + 1, k, j + 1, m))
    return sorted(out)


def tighten(pairs: list[tuple[int, int]], text: Sequence[str]) -> list[tuple[int, int]]:
    """The same alignment drawn together: a word that occurs again nearer to the middle is taken there."""
    out, middle = list(pairs), len(pairs) // 2
    for k in range(middle - 1, -1, -1):
        out[k] = (next(i for i in range(out[k + 1][0] - 1, -1, -1) if text[i] == text[out[k][0]]), out[k][1])
    for k in range(middle + 1, len(out)):
        out[k] = (next(i for i in range(out[k - 1][0] + 1, len(text)) if text[i] == text[out[k][0]]), out[k][1])
    return out


class Template:
    def __init__(self, name: str, text: str, coverage: float):
        self.name, self.words = name, words_of(text)
        n = len(self.words)
        self.least = math.ceil(coverage * n - 1e-9)
        self.slack = n // 4 + 2
        self.counts = Counter(self.words)
        # Longer words first: they are the rarer ones. Their occurrences outnumber what may be missing.
        self.rare: set[str] = set()
        held = 0
        for w in sorted(set(self.words), key=lambda w: (-len(w), w)):
            if held > n - self.least:
                break
            self.rare.add(w)
            held += self.words.count(w)
        self.places = {w: [j for j, x in enumerate(self.words) if x == w] for w in self.rare}


def prepare(templates: Mapping[str, str], coverage: float = COVERAGE) -> list[Template]:
    """Templates with at least one word, in order of name."""
    return [t for t in (Template(k, v, coverage) for k, v in sorted(templates.items())) if t.words]


Match = tuple[int, int, str, int, int]  # start, end (code points), template, aligned words, words


def windows(words: Sequence[str], t: Template, start: int, anchor: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """Beginning and alignment of ever wider windows around ``start``; ``words[anchor]`` is aligned with the word that implies it."""
    n, before, slack = len(t.words), 0, 0
    while True:
        low, high = max(0, start - slack), min(len(words), start + n + slack)
        i, j = anchor - low, anchor - start
        left = align(words[low:anchor], t.words[:j])
        right = align(words[anchor + 1 : high], t.words[j + 1 :])
        pairs = [*left, (i, j), *((i + 1 + k, j + 1 + m) for k, m in right)]
        yield low, pairs
        if len(pairs) == n or (slack >= 2 * n and len(pairs) <= before) or (low == 0 and high == len(words)):
            return
        before, slack = len(pairs), 2 * slack or t.slack


def scan_text(text: str, templates: Sequence[Template]) -> list[Match]:
    """Matches that don't overlap: those of more aligned and fewer skipped words of the template first, then by coverage, place and name."""
    low = text.lower()
    likely = [t for t in templates if any(w in low for w in t.rare)]
    if not likely:
        return []
    if len(low) == len(text):
        places = [m.span() for m in _WORD.finditer(low)]
        words = [low[s:e] for s, e in places]
    else:  # a character grew in lower case
        places = [m.span() for m in _WORD.finditer(text)]
        words = [text[s:e].lower() for s, e in places]
    held = set(words)
    likely = [t for t in likely if sum(c for w, c in t.counts.items() if w in held) >= t.least]
    if not likely:
        return []
    wanted: dict[str, list[Template]] = {}
    for t in likely:
        for w in t.rare:
            wanted.setdefault(w, []).append(t)
    starts: dict[str, dict[int, int]] = {}  # implied start to the first word that implies it
    for i, w in enumerate(words):
        for t in wanted.get(w, ()):
            for j in t.places[w]:
                starts.setdefault(t.name, {}).setdefault(i - j, i)
    found = []
    for t in likely:
        for s, i in sorted(starts.get(t.name, {}).items()):
            for low_, pairs in windows(words, t, s, i):
                if len(pairs) >= t.least:
                    pairs = tighten(pairs, words[low_ : low_ + pairs[-1][0] + 1])
                    span = words[low_ + pairs[0][0] : low_ + pairs[-1][0] + 1]
                    skipped = sum(w in t.counts for w in span) - len(pairs)  # of another copy
                    found.append((places[low_ + pairs[0][0]][0], places[low_ + pairs[-1][0]][1], t.name, len(pairs), len(t.words), skipped))
    out: list[Match] = []
    for m in sorted(set(found), key=lambda m: (m[5] - m[3], -m[3], -m[3] / m[4], m[1] - m[0], m[0], m[2])):
        if all(m[1] <= o[0] or m[0] >= o[1] for o in out):
            out.append(m[:5])
    return sorted(out)


def _scanned(templates: Mapping[str, str], coverage: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prepared = prepare(templates, coverage)
        item = pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())])
        for batch in slices(batches):
            rows = [
                [{"license": name, "start": s, "end": e, "coverage": got / of} for s, e, name, got, of in scan_text(text, prepared)]
                for text in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(item))], ["doc_id", "matches"])

    return run


def license_scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_matches, licenses, coverage, matches.

    matches: license, start and end in code points, and coverage of every match, by place. licenses:
    the distinct names, sorted, comma-joined; coverage: the largest, 0 without a match. Null and empty
    texts match nothing; repeated rows repeat.
    """
    schema = "doc_id long, matches array<struct<license:string,start:long,end:long,coverage:double>>"
    found = documents(docs).mapInArrow(_scanned(dict(templates), coverage), schema)
    return found.select(
        "doc_id", F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct("matches.license")), ",").alias("licenses"),
        F.coalesce(F.array_max("matches.coverage"), F.lit(0.0)).alias("coverage"), "matches",
    )
