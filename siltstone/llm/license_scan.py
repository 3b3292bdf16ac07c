"""License scans: winnowed fingerprints pick candidates, banded alignment measures them.

Templates are cut into k-grams of words; of each window of w the least hash is kept, and
an inverted index leads from hashes to places in templates. A document's k-grams that are
in the index mark diagonals; hits on near diagonals make a candidate place, where the
template is aligned with the document within a band around them. What comes out is the
share of the template's words that are matched and where. Of places of one template that
overlap, the one with most matches is reported.

k and w follow from the length n of a template and the coverage asked for: if m = (1 -
coverage) n words are replaced or missing, a run of (n - m) / (m + 1) words is intact, and
winnowing keeps a k-gram of every run of k + w - 1 words. So every place that reaches the
coverage by replacing or leaving out words is a candidate; a place with further words put
in between needs one such run of its own.

The built-in templates are notices, headers and short licenses. `read_templates` reads
others, such as the full texts of long licenses, from text files.

Results for odd input: a null or empty text has no match; a null id stays null; repeated
rows each get their matches; an empty table gives no rows; templates without words are
ignored. Columns besides id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm._scratch import NULL_ID, chunks, small_batches
from siltstone.llm.decontamination import Words, words_of

U = np.uint64
K, BAND = 3, 8
COVERAGE = 0.8
#: License notices as they are commonly written.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT-short": "This project is licensed under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "BSD-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "LGPL-3.0-header": "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "AGPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "CC0-1.0-notice": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty.",
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "MIT-warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "ISC": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause-third": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSD-warranty": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}
SCHEMA = "doc_id long, license_id string, coverage double, start_word long, end_word long, spans array<struct<start:long,end:long>>"


def read_templates(spark: SparkSession, path: str) -> dict[str, str]:
    """Templates from text files of a folder, named by their files. They go to the driver: a stated set, not data."""
    rows = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(?:\.txt)?$", 1), "value").collect()
    return {name: text for name, text in rows}


def gram_and_window(n: int, coverage: float) -> tuple[int, int]:
    """k and w for a template of n words, so that no place of that coverage goes without a hit."""
    missing = int((1 - coverage) * n + 1e-9)
    run = -(-(n - missing) // (missing + 1))
    k = min(K, run)
    return k, run - k + 1


class TemplateIndex:
    """Inverted index, by length of gram, from kept hashes to (template, position)."""

    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE) -> None:
        self.names = sorted(templates)
        self.words = [words_of(templates[n].encode()) for n in self.names]
        shapes = [gram_and_window(len(w), coverage) if w else (0, 0) for w in self.words]
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for size in sorted({k for k, _ in shapes} - {0}):
            own = [i for i, (k, _) in enumerate(shapes) if k == size]
            words = Words([templates[self.names[i]].encode() for i in own])
            p, h = words.grams(size)
            place = p - words.start[words.text[p]]
            keep = np.zeros(len(p), bool)
            for i, t in enumerate(own):
                mine = np.flatnonzero(words.text[p] == i)
                w = min(shapes[t][1], len(mine))
                for a in range(len(mine) - w + 1):
                    keep[mine[a + int(np.argmin(h[mine[a : a + w]]))]] = True
            order = np.flatnonzero(keep)[np.argsort(h[keep], kind="stable")]
            self.tables[size] = (h[order], np.array(own)[words.text[p[order]]], place[order])


def align(template: list[bytes], words: list[bytes], start: int, band: int = BAND) -> list[tuple[int, int]]:
    """Matched (template, document) positions of a best alignment whose diagonals lie within band of start."""
    n = len(template)
    width = 2 * band + 1
    score = [[0] * width for _ in range(n + 1)]
    step = [[0] * width for _ in range(n + 1)]
    for i in range(1, n + 1):
        for d in range(width):
            j = start + i - 1 + d - band  # document word beside template word i - 1
            up = score[i - 1][d + 1] if d + 1 < width else -1
            left = score[i][d - 1] if d else -1
            best, how = (up, 1) if up >= left else (left, 2)
            if 0 <= j < len(words) and template[i - 1] == words[j] and score[i - 1][d] + 1 >= best:
                best, how = score[i - 1][d] + 1, 3
            elif score[i - 1][d] > best:
                best, how = score[i - 1][d], 4
            score[i][d], step[i][d] = best, how
    i, d = n, max(range(width), key=lambda x: (score[n][x], -abs(x - band)))
    out = []
    while i > 0:
        how = step[i][d]
        if how == 3:
            out.append((i - 1, start + i - 1 + d - band))
        if how == 2:
            d -= 1
        else:
            i, d = i - 1, d + (how == 1)
    return out[::-1]


def scan_texts(index: TemplateIndex, texts: list[bytes], coverage: float) -> list[tuple[int, str, float, list[int]]]:
    """(text, license, coverage, matched document words), places in order of text and start."""
    docs = Words(texts)
    hits: dict[tuple[int, int], list[int]] = {}
    for size, (hashes, template, place) in index.tables.items():
        p, h = docs.grams(size)
        a = np.searchsorted(hashes, h, "left")
        found = np.flatnonzero(hashes[np.minimum(a, len(hashes) - 1)] == h)
        b = np.searchsorted(hashes, h[found], "right")
        for pos, first, last in zip(p[found].tolist(), a[found].tolist(), b.tolist(), strict=True):
            d = int(docs.text[pos])
            for m in range(first, last):
                hits.setdefault((d, int(template[m])), []).append(pos - int(docs.start[d]) - int(place[m]))
    out = []
    cache: dict[int, list[bytes]] = {}
    for (d, t), diagonals in sorted(hits.items()):
        if d not in cache:
            cache = {d: words_of(texts[d])}
        found = []
        band = band_of(len(index.words[t]))
        for first, last in bands(sorted(set(diagonals)), band):
            pairs = align(index.words[t], cache[d], (first + last) // 2, band + (last - first + 1) // 2)
            if len(pairs) >= coverage * len(index.words[t]) - 1e-9:
                found.append([j for _, j in pairs])
        taken: list[list[int]] = []
        for at in sorted(found, key=lambda at: (-len(at), at[-1] - at[0], at)):
            if all(at[-1] < x[0] or at[0] > x[-1] for x in taken):
                taken.append(at)
        out += [(d, index.names[t], len(at) / len(index.words[t]), at) for at in sorted(taken)]
    return out


def band_of(n: int) -> int:
    """Of a template of n words: so narrow that two places side by side are two."""
    return min(BAND, max(1, n // 2))


def bands(diagonals: list[int], band: int) -> list[tuple[int, int]]:
    """First and last of runs of near diagonals, none wider than two bands; the bands of neighbours overlap."""
    out: list[tuple[int, int]] = []
    first = last = None
    for x in diagonals:
        if first is None or x - last > band or x - first >= 2 * band:
            if first is not None:
                out.append((first, last))
            first = x
        last = x
    if first is not None:
        out.append((first, last))
    return out


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """A row for each place of a document that matches a template: doc_id, license_id, coverage, first and last matched word (end exclusive), and runs of matched words."""
    small_batches(docs.sparkSession)
    index = docs.sparkSession.sparkContext.broadcast(TemplateIndex(templates if templates is not None else TEMPLATES, coverage))

    def run(batches):
        for ids, texts in chunks(batches, 1 << 20):
            rows = []
            for d, name, share, at in scan_texts(index.value, texts, coverage):
                spans = []
                for j in at:
                    if spans and spans[-1]["end"] == j:
                        spans[-1]["end"] = j + 1
                    else:
                        spans.append({"start": j, "end": j + 1})
                rows.append({"doc_id": None if ids[d] == NULL_ID else int(ids[d]), "license_id": name, "coverage": share, "start_word": at[0], "end_word": at[-1] + 1, "spans": spans})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("doc_id", pa.int64()), ("license_id", pa.string()), ("coverage", pa.float64()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]))

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, SCHEMA)
