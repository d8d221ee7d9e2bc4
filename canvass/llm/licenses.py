"""Operator 6: licence scans.

Templates (short notices, headers and whole licence texts) and overlapping windows of documents are turned
into MinHash signatures of their word shingles.  Bands of rows, more for longer templates, retrieve candidates:
with b bands of r rows a window of similarity s meets its template with probability 1 - (1 - s^r)^b, and
:func:`bands_for` raises b until that is at least the wanted bound at the similarity a window that holds the
whole template must have.  Candidates are verified by exact containment of the template's shingles.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._words import LETTERS_DIGITS, Words, in_batches, mix, slices, text_bytes

# Notices and licence texts in common use, by SPDX-like name.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "MIT": "Released under the MIT License",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "all-rights-reserved": "All rights reserved",
    "MIT-full": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to '
        "deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or "
        "sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        'copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", '
        "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "BSD-2-Clause-full": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        'materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
        "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, "
        "BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
        "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
        "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSD-3-Clause-full": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in "
        "binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
        'CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A '
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
        "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
        "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "ISC-full": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        'copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD '
        "TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
        "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "Zlib-full": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from "
        "the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
        "redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you "
        "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not "
        "required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may "
        "not be removed or altered from any source distribution."
    ),
    "Unlicense-full": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute "
        "this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy '
        "of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the "
        'License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific '
        "language governing permissions and limitations under the License."
    ),
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be "
        "useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details."
    ),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can "
        "obtain one at https://mozilla.org/MPL/2.0/."
    ),
}

SHINGLE = 2
PROBABILITY = 0.9999
CONTAINMENT = 0.9


def rows_for(words: int) -> int:
    """Rows of a band for templates of so many words: the longer a template, the more it takes to be its candidate."""
    return 1 if words < 16 else 2 if words < 64 else 3


def bands_for(similarity: float, rows: int = 1, probability: float = PROBABILITY) -> int:
    """Fewest bands with which a pair of this similarity is retrieved with the wanted probability."""
    hit = similarity**rows
    return 1 if hit >= 1 else math.ceil(math.log(1 - probability) / math.log(1 - hit))


def _salt(seed: int) -> np.uint64:
    return np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))


def _minhash(shingles: np.ndarray, starts: np.ndarray, seed: int) -> np.ndarray:
    """Smallest seeded hash of each run of shingles."""
    return np.minimum.reduceat(mix(shingles ^ _salt(seed)), starts)


class Matcher:
    """Band tables of the templates of each length, and their shingle sets."""

    def __init__(self, templates: dict[str, str], probability: float = PROBABILITY, containment: float = CONTAINMENT) -> None:
        self.containment, self.sets = containment, {}
        lengths: dict[int, list[str]] = defaultdict(list)
        for name, text in sorted(templates.items()):
            words = Words(*text_bytes(pa.array([text])), LETTERS_DIGITS)
            if len(words.hash) >= SHINGLE:
                self.sets[name] = np.unique(words.windows(SHINGLE)[0])
                lengths[len(words.hash)].append(name)
        self.any = np.unique(np.concatenate([np.zeros(0, np.uint64), *self.sets.values()]))
        # A window of twice the template's words, moved by the template's words, holds any occurrence whole.
        self.plans = []
        for n, names in sorted(lengths.items()):
            window = 2 * n
            worst = containment * (n - SHINGLE + 1) / (window - SHINGLE + 1 + (1 - containment) * (n - SHINGLE + 1))
            rows = rows_for(n)
            bands = bands_for(worst, rows, probability)
            tables = []
            for b in range(bands):
                table: dict[tuple[int, ...], list[str]] = defaultdict(list)
                for name in names:
                    table[tuple(int(_minhash(self.sets[name], np.zeros(1, np.int64), b * rows + r)[0]) for r in range(rows))].append(name)
                # The templates' own shingles with the smallest hash of the band's first row, as a mark on all shingles of templates.
                anchors = np.isin(mix(self.any ^ _salt(b * rows)), np.array([k[0] for k in table], np.uint64))
                tables.append((dict(table), anchors))
            self.plans.append((n, window, rows, tables))

    @staticmethod
    def _candidates(h: np.ndarray, begin: np.ndarray, end: np.ndarray, at: np.ndarray, which: np.ndarray, rows: int, tables: list[tuple[dict, np.ndarray]]) -> dict[int, set[str]]:
        """By window: the templates that share a band with it.

        ``at`` are the places of shingles that some template has, ``which`` their numbers.  A window's smallest hash is a
        template's only where it holds that very shingle, so each band is looked up for the windows around such places.
        """
        found: dict[int, set[str]] = defaultdict(set)
        for b, (table, anchors) in enumerate(tables):
            places = at[anchors[which]]
            if not len(places):
                continue
            # Windows begin in order; the ones that hold a place are those after the last that ended before it.
            low, high = np.searchsorted(end, places, "right"), np.searchsorted(begin, places, "right")
            windows = np.unique(np.concatenate([np.minimum(low + k, high) for k in range(int((high - low).max(initial=0)))] or [low[:0]]))
            windows = windows[windows < len(begin)]
            if not len(windows):
                continue
            size = end[windows] - begin[windows]
            edges = np.cumsum(size) - size
            own = h[np.arange(size.sum()) - np.repeat(edges - begin[windows], size)]
            keys = [_minhash(own, edges, b * rows + r) for r in range(rows)]
            for i, key in enumerate(zip(*(k.tolist() for k in keys), strict=True)):
                if key in table:
                    found[int(windows[i])].update(table[key])
        return found

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> dict[int, dict[str, float]]:
        """By text: verified templates with the share of their shingles that a window contains."""
        words = Words(data, offsets, LETTERS_DIGITS)
        h, at = words.windows(SHINGLE)
        out: dict[int, dict[str, float]] = defaultdict(dict)
        if not len(h):
            return out
        some = np.flatnonzero(np.isin(h, self.any))
        if not len(some):
            return out
        which = np.searchsorted(self.any, h[some])
        owner = words.of_text(at)
        first = np.searchsorted(owner, np.arange(len(offsets)))
        for n, window, rows, tables in self.plans:
            # Windows begin every n words; a text's last one may be shorter.
            counts = np.diff(first)
            has = np.flatnonzero(counts)
            per = np.maximum(1, -(-(counts[has] - 1) // n))
            text = np.repeat(has, per)
            begin = first[text] + n * (np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per))
            end = np.minimum(begin + window - SHINGLE + 1, first[text + 1])
            for w, names in self._candidates(h, begin, end, some, which, rows, tables).items():
                own = h[begin[w] : end[w]]
                for name in names:
                    share = float(np.isin(self.sets[name], own).mean())
                    if share >= self.containment:
                        row = int(text[w])
                        out[row][name] = max(share, out[row].get(name, 0.0))
        return out


def licences(documents: DataFrame, templates: dict[str, str] = TEMPLATES, *, containment: float = CONTAINMENT, probability: float = PROBABILITY) -> DataFrame:
    """doc_id, licences (array of (name, containment), in order of name): a row per row; empty where none is found.

    Null, empty and one-word texts hold none; repeated rows and rows without an id are scanned like others; of
    several windows that hold a template the largest containment counts, and templates do not exclude each other.  Templates of one word are not scanned for.  Whole texts are
    read, however long; the templates, a few kilobytes, are broadcast.
    """
    sent = documents.sparkSession.sparkContext.broadcast(Matcher(templates, probability=probability, containment=containment))
    kind = documents.schema["doc_id"].dataType.simpleString()

    def read(batches):
        for batch in batches:
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for row, _, data, offsets in slices(batch.column("text")):
                for r, names in sent.value.scan(data, offsets).items():
                    found[row + r] = [{"name": n, "containment": s} for n, s in sorted(names.items())]
            kinds = pa.list_(pa.struct([("name", pa.string()), ("containment", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kinds)], names=["doc_id", "licences"])

    return in_batches(documents.select("doc_id", "text")).mapInArrow(read, f"doc_id {kind}, licences array<struct<name:string,containment:double>>")


def report(documents: DataFrame) -> DataFrame:
    """doc_id, n_licences, licences (names joined by a bar) of every document."""
    found = licences(documents)
    names = F.transform("licences", lambda x: x["name"])
    return found.select("doc_id", F.size("licences").cast("long").alias("n_licences"), F.array_join(names, "|").alias("licences"))
