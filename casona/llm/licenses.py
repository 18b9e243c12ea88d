"""License scans: winnowed fingerprints of templates pick candidates, banded alignment measures them.

The fingerprints are the words that winnowing leaves of a template: of each two
neighbours the one that is rarer in the templates, or every word of a template
too short for that.  They form an inverted index to their places.  A document is
winnowed in the same way, and where hits on near diagonals of a template are as
many as any text that qualifies must have, a banded alignment tells how much of
the template is there, and where.  So no text that qualifies is lost.

How many hits that are: let ``lost`` be the words that may be missing and ``near``
the band.  The diagonal can grow by ``2 * near + lost`` in all, so what is found
is in at most ``1 + 2 * lost + 2 * near`` runs, and all other neighbours among
the found words lie side by side in the text too.  Each such pair leaves a
fingerprint at the same place of both, and a place serves two pairs at most.
Longer grams would promise nothing: with a fifth of the words changed, no three
words in a row need be left.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casona.llm.shared import text_pieces

WORD = re.compile(r"[^\W_]+")
#: Words by which an alignment may leave its diagonal; half a template's words if that is less.
BAND = 8
#: Share of a template's words that must be found, in order.
COVERAGE = 0.8
#: Share of the words from the first found one to the last that must be found ones.
DENSITY = 0.7
FOUND = "doc_id long, license string, coverage double, start int, stop int, matched_words int, template_words int"

WARRANTY = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
BSD_START = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."


def gnu_header(name: str, version: str) -> str:
    """The notice by which a file is put under one of the GNU licenses."""
    return f"This program is free software: you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details."


# License texts and notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "MIT-notice": "Released under the MIT License",
    "all-rights-reserved": "All rights reserved",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. " + WARRANTY,
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "BSD-2-Clause": BSD_START + " " + BSD_END,
    "BSD-3-Clause": BSD_START + " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. " + BSD_END,
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "BSL-1.0": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "GPL-2.0-header": gnu_header("GNU General Public License", "2"),
    "GPL-3.0-header": gnu_header("GNU General Public License", "3"),
    "LGPL-3.0-header": gnu_header("GNU Lesser General Public License", "3"),
    "AGPL-3.0-header": gnu_header("GNU Affero General Public License", "3"),
}


def words(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


def winnowed(ranks: np.ndarray) -> np.ndarray:
    """Places of the lesser rank of each two neighbours, the right one of equal ones; pairs with a negative rank leave none."""
    a, b = ranks[:-1], ranks[1:]
    left = np.flatnonzero((a >= 0) & (b >= 0))
    return np.unique(left + (b[left] <= a[left]))


class Postings:
    """Places by word: ``of`` gives, for the words of a text at some places, the templates, their places and the diagonals that are hit."""

    def __init__(self, found: list[tuple[int, int, int]], n_words: int):
        rows = np.array(sorted(found), np.int64).reshape(-1, 3)  # (word, template, place)
        self.template, self.place = rows[:, 1], rows[:, 2]
        self.first = np.searchsorted(rows[:, 0], np.arange(n_words + 1))

    def of(self, ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        word = ids[at]
        n = self.first[word + 1] - self.first[word]
        which = np.repeat(self.first[word] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        return self.template[which], self.place[which], np.repeat(at, n) - self.place[which]


class TemplateIndex:
    """The templates' words, fingerprints, and how many hits a text that qualifies must have of each template."""

    def __init__(self, templates: dict[str, str], band: int = BAND, coverage: float = COVERAGE):
        self.names = sorted(templates)
        counts = Counter(w for n in self.names for w in words(templates[n]))
        self.vocabulary = {w: k for k, w in enumerate(sorted(counts, key=lambda w: (counts[w], w)))}  # the rarest first
        self.tokens = [np.array([self.vocabulary[w] for w in words(templates[n])], np.int64) for n in self.names]
        if empty := [n for n, t in zip(self.names, self.tokens, strict=True) if not len(t)]:
            raise ValueError(f"templates without a word: {', '.join(empty)}")
        self.needed = [math.ceil(coverage * len(t) - 1e-9) for t in self.tokens]
        self.near = np.array([min(band, max(1, len(t) // 2)) for t in self.tokens], np.int64)
        pairs = [need - 1 - 2 * (len(t) - need) - 2 * near for t, need, near in zip(self.tokens, self.needed, self.near.tolist(), strict=True)]
        self.hits = np.array([-(-p // 2) if p > 0 else need for p, need in zip(pairs, self.needed, strict=True)], np.int64)
        places = [(t, winnowed(ids) if pairs[t] > 0 else np.arange(len(ids))) for t, ids in enumerate(self.tokens)]
        posted = lambda long: [(int(self.tokens[t][k]), t, int(k)) for t, at in places if (pairs[t] > 0) == long for k in at]
        self.every, self.few = (Postings(posted(long), len(self.vocabulary)) for long in (False, True))

    def candidates(self, ids: np.ndarray) -> dict[int, list[int]]:
        """Diagonals of each template around which a text hits enough of its places."""
        found = [self.every.of(ids, np.flatnonzero(ids >= 0)), self.few.of(ids, winnowed(ids))]
        template, place, diagonal = (np.concatenate([x[j] for x in found]) for j in range(3))
        width = 2 * self.near + 1
        zero, longest = max(len(t) for t in self.tokens), max(len(t) for t in self.tokens)
        # what a band reaches lies in two neighbouring stripes of its width, so these must have enough places
        stripe = (diagonal + zero) // width[template] + template * (len(ids) + 2 * zero + 2)
        pairs = np.unique(stripe * longest + place) // longest
        stripes, n = np.unique(pairs, return_counts=True)
        after = np.append(np.where(np.diff(stripes) == 1, n[1:], 0), 0) if len(n) else n
        before = np.append(0, np.where(np.diff(stripes) == 1, n[:-1], 0)) if len(n) else n
        enough = n + np.maximum(after, before) >= self.hits[stripes // (len(ids) + 2 * zero + 2)]
        live = np.isin(stripe, stripes[enough])
        out: dict[int, list[int]] = {}
        for t in np.unique(template[live]).tolist():
            own = live & (template == t)
            order = np.argsort(diagonal[own], kind="stable")
            hit, at, near = diagonal[own][order], place[own][order], int(self.near[t])
            around = np.unique(hit[:, None] + np.arange(-near, near + 1))
            low, high = np.searchsorted(hit, around - near), np.searchsorted(hit, around + near, side="right")
            some = np.flatnonzero(high - low >= self.hits[t])
            kept = [k for k in some.tolist() if len(set(at[low[k] : high[k]].tolist())) >= self.hits[t]]
            if kept:
                out[t] = around[kept].tolist()
        return out

    def scan(self, text: str) -> list[tuple[str, float, int, int, int, int]]:
        """``(license, coverage, start, stop, matched, words)`` of a text, offsets in characters, in order of license and start.

        Of findings of one license that overlap, the best stays; a notice that lies
        within a better covered, longer one of another license is reported too.
        """
        found_words, get = WORD.findall(text), self.vocabulary.get
        ids = np.array([get(w.lower(), -1) for w in found_words], np.int64)
        out: list[tuple[str, float, int, int, int, int]] = []
        spans: list[tuple[int, int]] | None = None
        for t, diagonals in self.candidates(ids).items() if (ids >= 0).any() else ():
            size, near = len(self.tokens[t]), int(self.near[t])
            best: set[tuple[int, int, int]] = set()
            done = -(10**9)
            for diagonal in diagonals:
                if diagonal <= done:
                    continue
                matched, first, last = aligned(self.tokens[t], ids, diagonal, near)
                if matched >= self.needed[t] and matched >= DENSITY * (last - first + 1):
                    best.add((matched, first, last))
                if matched == size and last - first == size - 1 and 4 * near <= size:
                    done = first + near  # what else these diagonals reach overlaps the whole text just found
            kept: list[tuple[int, int, int]] = []  # (first, last, matched), in order, none overlapping
            for m, i, j in sorted(best, key=lambda x: (-x[0], x[2] - x[1], x[1])):
                at = bisect.bisect_left(kept, (i, j, m))
                if (at == 0 or kept[at - 1][1] < i) and (at == len(kept) or kept[at][0] > j):
                    kept.insert(at, (i, j, m))
            for i, j, m in kept:
                spans = spans or [x.span() for x in WORD.finditer(text)]
                out.append((self.names[t], m / size, spans[i][0], spans[j][1], m, size))
        return out


def aligned(template: np.ndarray, ids: np.ndarray, diagonal: int, band: int) -> tuple[int, int, int]:
    """``(matched, first, last)``: most words of the template found in order, and the places of the first and last.

    Word k of the template may meet the text's words ``diagonal + k`` plus or
    minus ``band``.  Of equal matches, the one that spans the fewest words.
    """
    lo, hi = max(0, diagonal - band), min(len(ids), diagonal + len(template) + band)
    # best[j]: (matched, first, -last) of alignments whose last word is the j-th of the text
    best: dict[int, tuple[int, int, int]] = {}
    for k, word in enumerate(template.tolist()):
        i0 = max(lo, diagonal + k - band)
        i1 = max(i0, min(hi, diagonal + k + band + 1))
        new: dict[int, tuple[int, int, int]] = {}
        for j in (np.flatnonzero(ids[i0:i1] == word) + i0).tolist():
            before = max((v for p, v in best.items() if p < j), default=(0, 0, 0))
            new[j] = (before[0] + 1, before[1] if before[0] else j, -j)
        for j, v in new.items():
            if v > best.get(j, (0, 0, 0)):
                best[j] = v
        for j in [j for j in best if j < i0 - band]:  # out of reach, but still the best so far may lie there
            v = best.pop(j)
            best[i0 - band - 1] = max(v, best.get(i0 - band - 1, (0, 0, 0)))
    if not best:
        return 0, 0, 0
    matched, first, last = max(best.values())
    return matched, first, -last


def license_spans(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", band: int = BAND, coverage: float = COVERAGE) -> DataFrame:
    """A row for each template found in whole texts: ``(doc_id, license, coverage, start, stop, matched_words, template_words)``.

    Offsets are characters of the text.  The templates are a parameter of a
    size that the caller sets; they and their index go to every task.  Texts that
    are null, empty or without a notice have no rows; rows that repeat come
    back as often.  A template without a word is an error.
    """
    index = TemplateIndex(TEMPLATES if templates is None else templates, band, coverage)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.float64(), *[pa.int32()] * 4]
        names = ["doc_id", "license", "coverage", "start", "stop", "matched_words", "template_words"]
        for batch, texts in (x for b in batches for x in text_pieces(b, 1, binary=False)):
            rows = [(doc, *x) for doc, text in zip(batch.column(0).to_pylist(), texts, strict=True) if text for x in index.scan(text)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, FOUND)
