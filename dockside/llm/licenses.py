"""License scans: winnowed fingerprints of templates pick candidates, banded alignment measures what matches.

Templates are cut into three-word shingles; of every ``WINNOW`` neighbouring shingles the one with the smallest hash goes
into an inverted index (shingle -> template and place). Every shingle of a document is looked up, so that a template which
stands in a text whole is always found. Hits that lie on nearby diagonals make one candidate; it is aligned with the template
word by word within a band around its diagonal. The share of template words matched in order is the coverage.

Licenses that stand in a text whole have a template for each paragraph (``*-text``), so each paragraph gives a row of its own.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from dockside.llm.storage import small_batches, text_slices
from dockside.llm.words import read_words

SHINGLE, WINNOW = 3, 4
COVERAGE = 0.85
_SLICE = 4 << 20

PARAGRAPH = 12  # words that a paragraph's template has at least: headings go with what follows


def paragraphs(name: str, text: str) -> list[tuple[str, str]]:
    """``text`` as templates of one name: its paragraphs, short ones together with the next, the last with the one before."""
    parts: list[str] = []
    for paragraph in re.split(r"\n\s*\n", text.strip()):
        if parts and len(re.findall(r"\S*[^\W_]\S*", parts[-1])) < PARAGRAPH:
            parts[-1] += "\n\n" + paragraph
        else:
            parts.append(paragraph)
    if len(parts) > 1 and len(re.findall(r"\S*[^\W_]\S*", parts[-1])) < PARAGRAPH:
        parts[-2:] = ["\n\n".join(parts[-2:])]
    return [(name, part) for part in parts]


_TEXTS = Path(__file__).parent / "license_texts"
_BODIES = [
    ("MIT-warranty", 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("BSD-text", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("BSD-text", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-text", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-text", 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("ISC-warranty", 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    *[(f"{name}-text", part) for name in ("Apache-2.0", "GPL-3.0", "MPL-2.0") for _, part in paragraphs(name, (_TEXTS / f"{name}.txt").read_text())],
]

#: name, text: short notices and the usual headers of public licenses, then the paragraphs of whole licenses.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0-header", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT-text", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *_BODIES,
]

#: Notices that reserve rights instead of granting any.
NOTICES = [
    ("All-rights-reserved", "All rights reserved."),
    ("Proprietary", "Proprietary and confidential."),
    ("Unauthorized-copying", "Unauthorized copying of this file, via any medium, is strictly prohibited."),
]


def align(template: list[int], words: list[int], diagonal: int, band: int) -> tuple[int, int, int]:
    """(matched, first, end): the most template words matched in order by ``words``, and the words that they span.

    Word i of the template may only meet word i + diagonal + d of the text with \\|d\\| <= ``band``. Of equally good alignments
    the one with the shortest span is taken.
    """
    width, none = 2 * band + 1, (0, 0, 0)  # (matched, -span, first) of the best alignment that ends at or before a place
    latest = operator.itemgetter(0, 2)  # whatever follows, of two that match as much the one that begins later spans less
    above = [none] * (width + 2)
    best = none
    for i, want in enumerate(template):
        row = [none] * (width + 2)
        for k in range(1, width + 1):
            j = i + diagonal + k - 1 - band
            take = max(above[k + 1], row[k - 1], key=latest)
            if 0 <= j < len(words) and words[j] == want:
                matched, _, first = above[k]
                first = first if matched else j
                take = max(take, (matched + 1, first - j - 1, first), key=latest)
            elif latest(above[k]) > latest(take):
                take = above[k]
            row[k] = take
            best = max(best, take, key=lambda x: x[:2])
        above = row
    return best[0], best[2], best[2] - best[1]


class Index:
    """Templates (name, text) with a word each at least."""

    def __init__(self, templates: list[tuple[str, str]]):
        ids, starts, names = read_words(pa.array([t for _, t in templates], pa.string()))
        self.names, self.words = names, [ids[s:e].tolist() for s, e in zip(starts, starts[1:])]
        self.titles, self.size = [n for n, _ in templates], len(names)
        found: dict[int, list[tuple[int, int]]] = {}
        for t, words in enumerate(self.words):
            n = min(SHINGLE, len(words))
            keys = [self._key((words[k : k + n] + [0] * SHINGLE)[:SHINGLE]) for k in range(len(words) - n + 1)]
            hashes = [xxhash.xxh64_intdigest(str(k)) for k in keys]
            picked = set()
            for w in range(max(len(keys) - WINNOW + 1, 1)):
                window = range(w, min(w + WINNOW, len(keys)))
                picked.add(min(window, key=lambda k: (hashes[k], -k)))
            for k in picked:
                found.setdefault(keys[k], []).append((t, k))
        self.keys = np.array(sorted(found), np.int64)
        self.posts = [found[k] for k in self.keys.tolist()]

    def _key(self, words: list[int]) -> int:
        a, b, c = words
        return (a * self.size + b) * self.size + c

    def candidates(self, ids: np.ndarray, starts: np.ndarray, names: pa.Array) -> dict[int, list[tuple[int, int]]]:
        """Text -> (template, diagonal) of its hits."""
        term = pc.fill_null(pc.index_in(names, value_set=self.names), -1).to_numpy().astype(np.int64)
        word = term[ids] if len(ids) else ids
        ends = np.repeat(starts[1:], np.diff(starts))
        at = np.nonzero(word >= 0)[0]
        at = at[at + SHINGLE <= ends[at]] if len(at) else at
        at = at[(word[at + 1] >= 0) & (word[at + 2] >= 0)] if len(at) else at
        keys = (word[at] * self.size + word[at + 1]) * self.size + word[at + 2]
        slot = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        out: dict[int, list[tuple[int, int]]] = {}
        for place, k in zip(at[self.keys[slot] == keys].tolist(), slot[self.keys[slot] == keys].tolist()):
            d = int(np.searchsorted(starts, place, side="right")) - 1
            for t, nth in self.posts[k]:
                out.setdefault(d, []).append((t, place - int(starts[d]) - nth))
        self._word = word
        return out

    def found(self, ids: np.ndarray, starts: np.ndarray, names: pa.Array) -> dict[int, list[tuple]]:
        """Text -> (name, coverage, first word, end word), by place; of those that overlap the one that matches most."""
        out = {}
        for d, hits in self.candidates(ids, starts, names).items():
            words, matches = self._word[starts[d] : starts[d + 1]].tolist(), []
            last: dict[int, int] = {}
            for t, diagonal in sorted(set(hits)):
                band = max(2, len(self.words[t]) // 10)
                if t in last and diagonal <= last[t] + band:
                    continue  # within the band of the one before
                last[t] = diagonal
                lo = max(diagonal - 2 * band, 0)
                part = words[lo : diagonal + len(self.words[t]) + 2 * band]
                matched, first, end = align(self.words[t], part, diagonal - lo, 2 * band)
                if matched >= COVERAGE * len(self.words[t]):
                    matches.append((matched, matched / len(self.words[t]), lo + first, lo + end, t))
            kept: list[tuple] = []
            for m in sorted(matches, key=lambda m: (-m[0], -m[1], m[2], m[4])):
                if all(m[3] <= k[2] or k[3] <= m[2] for k in kept):
                    kept.append(m)
            if kept:
                out[d] = [(self.titles[t], coverage, first, end) for _, coverage, first, end, t in sorted(kept, key=lambda m: m[2])]
        return out


def _places(text: str) -> list[tuple[int, int]]:
    """Where the words that ``read_words`` gives for ``text`` begin and end, in code points."""
    return [m.span() for m in re.finditer(r"\S+", text) if re.search(r"[^\W_]", m[0])]


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(doc_id, license, coverage, start, stop): one row per match, from whole texts; the places are code points.

    Null and empty texts and texts without a template give no rows; repeated rows give repeated rows; a null doc_id stays null. Templates
    without words are left out; without templates there are no rows. Other columns are not read.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, license string, coverage double, start int, stop int"
    usable = [(n, t) for n, t in templates if re.search(r"[^\W_]", t)]
    if not usable:
        return source.sparkSession.createDataFrame([], schema)
    index = Index(usable)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = [x.split()[0] for x in schema.split(", ")], [pa.int64(), pa.string(), pa.float64(), pa.int32(), pa.int32()]
        for batch in batches:
            for part in text_slices(batch, "text", _SLICE):
                rows = []
                for d, matches in sorted(index.found(*read_words(part.column("text"))).items()):
                    own, places = part.column("doc_id")[d].as_py(), _places(part.column("text")[d].as_py())
                    rows += [(own, name, coverage, places[first][0], places[end - 1][1]) for name, coverage, first, end in matches]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 5, kinds)], names)

    return small_batches(source).mapInArrow(run, schema)
