"""License scans: winnowed fingerprints of templates, an inverted index, banded alignment.

Notices of up to ``NOTICE`` characters are looked for as wholes. An alignment of a template of m characters
within k edits leaves at least m + 1 - q * (k + 1) of its q-grams; with 4-grams that is more than none for
every template at a coverage of 0.85, so all of them are indexed, votes are counted for each (template,
diagonal band), and bands with that many votes are aligned in full. No match within the edits is lost.

Longer texts are looked for in part as well. Of every ``window`` consecutive q-gram hashes of a template
the least is kept (winnowing), so that every stretch of q + window - 1 characters holds a kept one. Kept
ones that a text has lie along diagonals; each run of them is aligned within a band, locally, which tells
the stretch of the text, the stretch of the template and how many characters of it are there.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from atlasweave.llm.common import own_key, read_table, resident, TextBlocks
from atlasweave.llm.passages import Block, GramIndex, banded, best_spans, gram_keys, local, normal, normal_block, regions, unedited

_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution. """
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT
SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING
IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the {0} as published by the
Free Software Foundation, either version {1} of the License, or (at your option) any later version. This program is distributed in the hope
that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
See the {0} for more details. You should have received a copy of the {0} along with this program."""

#: Notices and bodies of common licenses (fixed texts).
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may
obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See
the License for the specific language governing permissions and limitations under the License.""",
    ],
    "MIT": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software. """
        + _AS_IS,
    ],
    "ISC": [
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL
WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE
FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2", _GNU.format("GNU General Public License", "2")],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        _GNU.format("GNU General Public License", "3"),
    ],
    "LGPL-3.0": [_GNU.format("GNU Lesser General Public License", "3")],
    "AGPL-3.0": [_GNU.format("GNU Affero General Public License", "3")],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "Creative Commons Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"],
    "BSD": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "BSD-2-Clause": [_BSD_START + _BSD_END],
    "BSD-3-Clause": [
        _BSD_START
        + """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this
software without specific prior written permission. """
        + _BSD_END
    ],
    "BSL-1.0": [
        """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation
covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative
works of the Software, and to permit third-parties to whom the Software is furnished to do so""",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file,
You can obtain one at https://mozilla.org/MPL/2.0/.""",
    ],
    "Unlicense": [
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    ],
    "Zlib": [
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising
from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions""",
    ],
}
FOUND = "license string, coverage double, start int, end int, edits int, matched int, template_start int, template_end int"
#: The longest template, in normal form, that is looked for as a whole only.
NOTICE = 160
Hit = tuple[str, float, int, int, int, int, int, int]


def winnow(keys: np.ndarray, window: int) -> np.ndarray:
    """Positions of the least key of every window, the last of equals."""
    if len(keys) <= window:
        return np.array([len(keys) - 1 - int(keys[::-1].argmin())], np.int64) if len(keys) else np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(keys, window)
    return np.unique(np.arange(len(views)) + window - 1 - views[:, ::-1].argmin(axis=1))


class LicenseIndex:
    """Templates found as wholes."""

    def __init__(self, templates: dict[str, list[str]], q: int, window: int, coverage: float):
        self.names, self.coverage, patterns = [], coverage, []
        for name in sorted(templates):
            for t in templates[name]:
                codes = normal(t)
                if len(codes):
                    self.names.append(name)
                    patterns.append(codes)
        chosen = [winnow(gram_keys(p, q), window) for p in patterns]
        sizes = np.array([len(p) for p in patterns], np.int64)
        self.edits = np.floor(sizes * (1 - coverage)).astype(np.int64)
        #: an edit breaks at most q fingerprints
        votes = np.array([len(c) for c in chosen], np.int64) - q * self.edits
        #: templates that may be left without fingerprint are aligned with the whole text
        self.unsure = np.flatnonzero(votes < 1)
        self.votes = np.where(votes < 1, np.iinfo(np.int64).max, votes)
        self.index = GramIndex(patterns, q, chosen)
        #: sorted 4-grams of each template, and how many of its 4-grams an alignment leaves at least
        self.fours = [np.unique(gram_keys(p, 4)) for p in patterns]
        self.shared = sizes + 1 - 4 * (self.edits + 1)

    def possible(self, p: int, window: np.ndarray) -> bool:
        """Whether the stretch of text has enough of the template's 4-grams, each counted as often as
        it occurs; no alignment within the edits has fewer."""
        if self.shared[p] <= 0:
            return True
        keys = gram_keys(window, 4)
        at = np.minimum(np.searchsorted(self.fours[p], keys), len(self.fours[p]) - 1)
        return int((self.fours[p][at] == keys).sum()) >= self.shared[p]

    def search(self, block: Block) -> dict[int, list[Hit]]:
        found: dict[tuple[int, str], list[tuple[int, int, int, int]]] = {}
        if not self.names:
            return {}
        everywhere = (
            (text, int(p), low, 0)
            for text in range(len(block.starts) - 1)
            for p in self.unsure
            for low in range(-int(self.edits[p]), int(block.starts[text + 1] - block.starts[text]), int(self.edits[p]) + 1)
        )
        exact: dict[int, list[tuple[int, int]]] = {}
        others = []
        for text, p, low, _ in chain(regions(self.index, block, self.edits + 1, self.votes), everywhere):
            pattern, codes = self.index.patterns[p], block.codes[block.starts[text] : block.starts[text + 1]]
            half, budget = int(self.edits[p]) + 1, int(self.edits[p])
            if not self.possible(p, codes[max(0, low - budget) : low + 2 * half + budget + len(pattern)]):
                continue
            at = unedited(pattern, codes, low + half, half + budget)
            if at is None:
                others.append((text, p, low, half, budget))
            else:
                exact.setdefault(text, []).append((at, at + len(pattern)))
                found.setdefault((text, self.names[p]), []).append((0, at, at + len(pattern), len(pattern)))
        for text, p, low, half, budget in others:
            pattern = self.index.patterns[p]
            # wherever it aligned, it would overlap an unedited template that is as long, and be dropped
            if any(b - a >= len(pattern) and low + 2 * half + budget < b and low - budget + len(pattern) - budget > a for a, b in exact.get(text, ())):
                continue
            hit = banded(pattern, block.codes[block.starts[text] : block.starts[text + 1]], low + half, half + budget, budget)
            if hit:
                found.setdefault((text, self.names[p]), []).append((*hit, len(pattern)))
        out: dict[int, list[Hit]] = {}
        for (text, name), hits in sorted(found.items()):
            size = {h[:3]: h[3] for h in hits}
            for hit in best_spans(h[:3] for h in hits):
                edits, start, end = hit
                out.setdefault(text, []).append((name, 1 - edits / size[hit], *places(block, text, start, end), edits, size[hit] - edits, 0, size[hit]))
        return {text: closest(hits) for text, hits in out.items()}


class BodyIndex:
    """Longer templates, found in part."""

    def __init__(self, templates: dict[str, list[str]], q: int, window: int, least: int):
        self.least, self.window, found = least, window, [(name, normal(t)) for name in sorted(templates) for t in templates[name]]
        found = [(name, codes) for name, codes in found if len(codes) > NOTICE]
        self.names = [name for name, _ in found]
        self.index = GramIndex([c for _, c in found], q, [winnow(gram_keys(c, q), window) for _, c in found])

    def runs(self, block: Block, apart: int = 400) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(text, template, least and greatest diagonal, least and greatest position) of fingerprints
        that lie along a band: neighbours by position, no more than ``apart`` characters and a
        quarter of their distance in diagonals from each other."""
        at, p, position = self.index.hits(block.codes)
        if not len(at):
            return
        text = np.searchsorted(block.starts, at, side="right") - 1
        diagonal, key = at - block.starts[text] - position, text * len(self.names) + p
        order = np.lexsort((position, at, key))
        cuts = np.flatnonzero(np.diff(key[order], prepend=-1))
        for lo, hi in zip(cuts, [*cuts[1:], len(order)], strict=True):
            own = order[lo:hi]
            runs: list[list[int]] = []
            for d, x in zip(diagonal[own].tolist(), position[own].tolist(), strict=True):
                for run in reversed(runs[-32:]):
                    if 0 <= x - run[3] <= apart and abs(d - run[4]) <= 16 + (x - run[3]) // 4:
                        run[0], run[1], run[3], run[4] = min(run[0], d), max(run[1], d), x, d
                        break
                else:  # one that could have gone on is aligned by itself
                    runs.append([d, d, x, x, d])
            for least, most, first, last, _ in runs:
                yield int(key[own[0]] // len(self.names)), int(key[own[0]] % len(self.names)), least, most, first, last

    def search(self, block: Block) -> dict[int, list[Hit]]:
        """Parts of ``least`` characters and more."""
        out: dict[int, list[Hit]] = {}
        for text, p, lo, hi, first, last in self.runs(block):
            codes, pattern = block.codes[block.starts[text] : block.starts[text + 1]], self.index.patterns[p]
            a, b, margin = first, last + self.index.q, 48
            while True:  # on either side until the alignment ends by itself
                a, b = max(0, a - margin), min(len(pattern), b + margin)
                found = local(pattern[a:b], codes, lo + a - 32, hi + a + 32)
                grow = found is not None and ((found[2] == 0 and a > 0) or (found[3] == b - a and b < len(pattern)))
                if not grow:
                    break
                margin *= 2
            if found is None or found[0] < self.least:
                continue
            matched, edits, p0, p1, start, end = found
            out.setdefault(text, []).append((self.names[p], matched / len(pattern), *places(block, text, start, end), edits, matched, a + p0, a + p1))
        return {text: closest(hits) for text, hits in out.items()}


def places(block: Block, text: int, start: int, end: int) -> tuple[int, int]:
    """Code points of the text from its codes' places, without a space in front."""
    own = block.places[block.starts[text] : block.starts[text + 1]]
    while end - start > 1 and int(block.codes[block.starts[text] + start]) == 32:
        start += 1
    return int(own[start]), int(own[end - 1]) + 1


def closest(hits: list[Hit]) -> list[Hit]:
    """Without those that overlap one of another license, or of theirs in place, which has as many
    characters and fewer edits, or as few and more characters."""

    def worse(a: Hit, b: Hit) -> bool:
        return a[2] < b[3] and b[2] < a[3] and b[5] >= a[5] and b[4] <= a[4] and (b[5], -b[4]) != (a[5], -a[4])

    return [a for a in sorted(set(hits), key=lambda h: (h[2], h[3], h[0])) if not any(worse(a, b) for b in hits)]


class Scanner:
    def __init__(self, templates: dict[str, list[str]], q: int, window: int, coverage: float, body_q: int, body_window: int, least: int):
        self.whole = LicenseIndex({n: [t for t in ts if len(normal(t)) <= NOTICE] for n, ts in templates.items()}, q, window, coverage)
        self.bodies = BodyIndex(templates, body_q, body_window, least)

    def search(self, block: Block) -> dict[int, list[Hit]]:
        whole = self.whole.search(block)
        for text, parts in (self.bodies.search(block) if self.bodies.names else {}).items():
            own = whole.setdefault(text, [])
            # a part that says little more than a notice in it says nothing
            more = [p for p in parts if not any(p[0] == w[0] and p[2] < w[3] and w[2] < p[3] and 2 * p[5] <= 3 * w[5] for w in own)]
            # and a notice within most of the body of another license belongs to that
            own[:] = [w for w in own if not any(p[0] != w[0] and p[2] <= w[2] and w[3] <= p[3] and p[1] >= 0.5 for p in more)]
            own[:] = closest(own + more)
        return {text: hits for text, hits in whole.items() if hits}


def worker_index(key: str, shared) -> Scanner:
    return resident(key, lambda: pickle.loads(shared.value))


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, list[str]] | None = None,
    text: str = "text",
    key: str = "doc_id",
    q: int = 4,
    window: int = 1,
    coverage: float = 0.85,
    body_q: int = 12,
    body_window: int = 8,
    least: int = 60,
) -> DataFrame:
    """(key, license, coverage, start, end, edits, matched, template_start, template_end): each stretch of
    a text that matches a template, or a part of one, in normal form.

    ``matched`` characters of the template, from ``template_start`` to ``template_end``, stand in the text
    from ``start`` to ``end`` (code points, end exclusive) with ``edits`` edits; ``coverage`` is their share
    of the template. Templates of up to NOTICE characters are reported as wholes, from a coverage of
    ``coverage`` on; all of those are found. Longer ones are reported from ``least`` matched characters
    on; those that share body_q + body_window - 1 characters in a row with the text are found. Of matches that
    overlap, those are dropped that another one covers with no fewer characters and fewer edits. Of a body and a
    notice of the same license at one place only the notice is reported if the body's part has no more than one
    and a half times its characters; a notice within a part of half the body or more of another license is dropped.

    Null and empty texts match nothing; texts may be of any length; repeated rows are reported each; an
    empty table gives an empty result; other columns are ignored, whatever their names. Templates too
    short for a q-gram to survive the edits are aligned with every text in full; empty ones match nothing.
    """
    own_key(key, FOUND)
    kind = docs.schema[key].dataType.simpleString()
    index = Scanner(TEMPLATES if templates is None else templates, q, window, coverage, body_q, body_window, least)
    shared, name = docs.sparkSession.sparkContext.broadcast(pickle.dumps(index)), uuid.uuid4().hex
    fields = [key, *(x.split()[0] for x in FOUND.split(", "))]
    kinds = (pa.string(), pa.float64(), *[pa.int32()] * 6)

    def run(batches):
        index = worker_index(name, shared)
        for batch in batches:
            ids, columns = batch.column(0), [[] for _ in range(1 + len(kinds))]
            for first, some in TextBlocks(1 << 20)(batch.column(1).to_pylist()):
                for i, hits in sorted(index.search(normal_block(some)).items()):
                    for hit in hits:
                        for column, value in zip(columns, (first + i, *hit), strict=True):
                            column.append(value)
            arrays = [pa.array(c, t) for c, t in zip(columns[1:], kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(columns[0], pa.int64())), *arrays], fields)

    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, {FOUND}")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))
