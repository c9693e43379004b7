"""License scan (operator 9) by patience alignment.

Words of text and template are runs of letters, digits and characters beyond
ASCII, ASCII letters in lower case. A text is first narrowed down to places, at
most twice as long as a template, that hold enough of its words; such words
bound the coverage from above, so nothing is dropped. Each place is then
aligned with the template: words that occur once in both are anchors, the
longest increasing subsequence of them is kept, and the gaps between anchors
are aligned the same way after taking off equal heads and tails. Coverage is
the share of the template's words that the alignment matches; from ``least``
on it is a finding.

Null texts have no words and no findings. Repeated rows and ids each give
their own row. A text may hold several licenses, or one several times; of
places that overlap, the one with the most matched words counts, then the better
coverage, then the first template in their order. An empty table gives no rows, a very long text is
searched whole, other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from aerolens.llm.common import ALNUM, blocks, documents, text_array, words

# The parts that the BSD licenses share.
BSD_OPENING = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: "
)
BSD_CONDITIONS = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list "
    "of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution. "
)
BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission. "
)
BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
    "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
    "DAMAGE."
)
# Short notices, opening paragraphs and whole bodies of public licenses.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    (
        "MIT-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions:",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0-text",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-text",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
    ),
    (
        "BSD-text",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("All-rights-reserved", "All rights reserved."),
    (
        "MPL-2.0-text",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    (
        "LGPL-3.0-text",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
    ),
    (
        "AGPL-3.0-text",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
    ),
    (
        "MIT-body",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", "
        "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
        "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE.",
    ),
    (
        "ISC-body",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
        "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
        "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING "
        "OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("BSD-2-Clause-body", BSD_OPENING + BSD_CONDITIONS + BSD_DISCLAIMER),
    ("BSD-3-Clause-body", BSD_OPENING + BSD_CONDITIONS + BSD_NAMES + BSD_DISCLAIMER),
    (
        "Zlib-body",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
        "be held liable for any damages arising from the use of this software. Permission is granted to anyone to "
        "use this software for any purpose, including commercial applications, and to alter it and redistribute it "
        "freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; "
        "you must not claim that you wrote the original software. If you use this software in a product, an "
        "acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source "
        "versions must be plainly marked as such, and must not be misrepresented as being the original software. "
        "3. This notice may not be removed or altered from any source distribution.",
    ),
    (
        "Unlicense-body",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize "
        "copyright laws, the author or authors of this software dedicate any and all copyright interest in the "
        "software to the public domain. We make this dedication for the benefit of the public at large and to the "
        "detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in "
        "perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS "
        "PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
        "THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT "
        "OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
        "SOFTWARE.",
    ),
)


def longest_increasing(values: list[int]) -> list[int]:
    """Positions of a longest strictly increasing subsequence (patience piles)."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        back.append(at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[pile], at[pile] = v, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(text: list, template: list) -> list[tuple[int, int]]:
    """Matched positions (text, template), increasing in both."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a == b or c == d:
            continue
        mine, theirs = Counter(text[a:b]), Counter(template[c:d])
        places = {w: j for j, w in enumerate(template[c:d], c) if theirs[w] == 1}
        pairs = [(i, places[w]) for i, w in enumerate(text[a:b], a) if mine[w] == 1 and w in places]
        if not pairs:  # no word is unique to both: take the first that both hold
            first = next((i for i in range(a, b) if text[i] in theirs), None)
            if first is None:
                continue
            pairs = [(first, template.index(text[first], c, d))]
        kept = [pairs[k] for k in longest_increasing([j for _, j in pairs])]
        for (i, j), (k, m) in zip([(a - 1, c - 1), *kept], [*kept, (b, d)], strict=True):
            if i + 1 < k and j + 1 < m:
                todo.append((i + 1, k, j + 1, m))
        found += kept
    return sorted(found)


class Scanner:
    """Templates as word hashes, and the search of one text for all of them."""

    def __init__(self, templates: tuple[tuple[str, str], ...], least: float):
        self.names, self.least = [name for name, _ in templates], least
        texts = pa.array([text for _, text in templates], pa.large_string())
        self.words: list[list[int]] = []
        for block in blocks(texts):
            found = words(block, ALNUM, lower=True)
            self.words += [found.hash[a:b].tolist() for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
        self.counts = [Counter(w) for w in self.words]
        self.vocabulary = np.unique(np.array([h for w in self.words for h in w], np.uint64))
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.vocabulary >> np.uint64(48)).astype(np.int64)] = True
        #: which template holds which word of the vocabulary
        self.holds = np.array([np.isin(self.vocabulary, np.array(w, np.uint64)) for w in self.words])

    def marks(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions that hold a word of some template, and which."""
        at = np.flatnonzero(self.maybe[(hashes >> np.uint64(48)).astype(np.int64)])
        where = np.searchsorted(self.vocabulary, hashes[at])
        where[where == len(self.vocabulary)] = 0
        good = self.vocabulary[where] == hashes[at]
        return at[good], where[good]

    def places(self, own: np.ndarray, at: np.ndarray, word: np.ndarray, t: int) -> Iterator[tuple[int, int]]:
        """Stretches (start, end) of a text, at most twice the template long,
        whose words could reach the coverage; one for each start that can."""
        mine = at[self.holds[t][word]]
        size, need = len(self.words[t]), self.least * len(self.words[t])
        reach, counts = 2 * size, self.counts[t]
        # Enough of the template's words, repeats included, within reach.
        if len(mine) < need:
            return
        last = np.searchsorted(mine, mine + reach)
        until = 0
        for k in np.flatnonzero(last - np.arange(len(mine)) >= need).tolist():
            start, end = int(mine[k]), int(mine[last[k] - 1]) + 1
            if end <= until:
                continue
            held = Counter(own[mine[k : last[k]]].tolist())
            if sum(min(n, counts[w]) for w, n in held.items()) >= need:
                yield start, end
                until = end

    def scan(self, own: np.ndarray, at: np.ndarray, word: np.ndarray) -> list[tuple[int, int, int, float]]:
        """(template, start, end, coverage) of the findings, in words."""
        found = []
        for t, template in enumerate(self.words):
            for start, end in self.places(own, at, word, t):
                while start < end:  # the stretch may hold the template more than once
                    pairs = align(own[start:end].tolist(), template)
                    coverage = len(pairs) / len(template)
                    if coverage < self.least:
                        break
                    found.append((t, start + pairs[0][0], start + pairs[-1][0] + 1, coverage))
                    start += pairs[-1][0] + 1
        chosen: list[tuple[int, int, int, float]] = []
        # Most words matched first, then the better coverage.
        for t, start, end, coverage in sorted(found, key=lambda x: (-round(len(self.words[x[0]]) * x[3]), -x[3], x[0], x[1])):
            if all(end <= s or e <= start for _, s, e, _ in chosen):
                chosen.append((t, start, end, coverage))
        return sorted(chosen, key=lambda x: x[1])


def licenses(
    df: DataFrame,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    least: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_words and findings (license, coverage, start and end in words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, least)
        kind = pa.struct(
            [("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int32()), ("end", pa.int32())]
        )
        for batch in batches:
            n, out = [], []
            for block in blocks(text_array(batch)):
                found = words(block, ALNUM, lower=True)
                at, word = scanner.marks(found.hash)
                cut = np.searchsorted(at, found.first)
                for row in range(block.rows):
                    first, last = int(found.first[row]), int(found.first[row + 1])
                    own = slice(cut[row], cut[row + 1])
                    hits = scanner.scan(found.hash[first:last], at[own] - first, word[own])
                    n.append(last - first)
                    out.append([
                        {"license": scanner.names[t], "coverage": c, "start": s, "end": e} for t, s, e, c in hits
                    ])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(out, pa.list_(kind))], ["doc_id", "n_words", "findings"]
            )

    schema = "doc_id long, n_words long, findings array<struct<license:string,coverage:double,start:int,end:int>>"
    return documents(df, id_col, text_col).mapInArrow(run, schema)
