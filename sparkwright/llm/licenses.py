"""License scans: winnowed fingerprints pick candidates, alignment confirms.

A template is cut into words, every ``GRAM`` consecutive words are hashed, and
of each ``WINDOW`` consecutive hashes the smallest is kept (winnowing).  The
kept hashes and their places form an inverted index.  A document is winnowed
alike; since the choice depends on the window alone, any run of ``GRAM +
WINDOW - 1`` words that it shares with a template has a common fingerprint.
The fingerprints found put the template on a diagonal (place in the document
minus place in the template).  Diagonals within ``BAND`` of each other form a candidate, and around
it a banded local alignment (match +2, mismatch and gap -1) gives the template
words that are matched and the span.  Matches inside a larger one are left out.

Scale: the index is made of the templates alone.  Templates are taken in blocks
of ``BLOCK_WORDS`` words, each sent along with the tasks of one pass over the
texts, which are never shuffled; more templates make more passes.  A document
is aligned around its candidates only, so the work is linear in its words.

Defined results: a null or empty text has no match; repeated rows give
repeated matches; equal ids are scanned apart; templates with fewer words than
``GRAM`` are refused; an empty table or list of templates gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import make_importable

GRAM, WINDOW, BAND = 3, 2, 8
BLOCK_WORDS = 200_000
_WORD = re.compile(r"[^\W_]+")
_FAR_HASH = np.uint64(0xFFFFFFFFFFFFFFFF)

# Notices and short full texts as projects write them, by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT "
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
        "IN THE SOFTWARE.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        "PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this "
        "work.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at "
        "your option) any later version.",
    ),
    "LGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
    ),
    "AGPL-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version.",
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
        "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
        "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
        "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
        "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
        "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
        "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
}


def words_of(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def default_templates() -> list[tuple[str, str]]:
    return [(name, text) for name, texts in TEMPLATES.items() for text in texts]


# -- fingerprints -----------------------------------------------------------


def winnow(hashes: np.ndarray) -> np.ndarray:
    """Places of the smallest hash (the last of equal ones) of each window."""
    if len(hashes) <= WINDOW:
        return np.array([len(hashes) - 1 - int(hashes[::-1].argmin())]) if len(hashes) else np.zeros(0, "i8")
    views = np.lib.stride_tricks.sliding_window_view(hashes, WINDOW)[:, ::-1]
    return np.unique(np.arange(len(views)) + WINDOW - 1 - views.argmin(axis=1))


def gram_hashes(ids: np.ndarray) -> np.ndarray:
    """Hash of each ``GRAM`` words.  ``ids`` are numbers of template words; 0
    is any other word, and a gram with one is never chosen over another."""
    n = len(ids) - GRAM + 1
    if n <= 0:
        return np.zeros(0, "u8")
    total = np.zeros(n, "u8")
    other = np.zeros(n, bool)
    for k in range(GRAM):
        part = ids[k : k + n]
        total = (total ^ part) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
        other |= part == 0
    return np.where(other, _FAR_HASH, total)


class Index:
    """Inverted index of the templates' fingerprints."""

    def __init__(self, templates: list[tuple[str, str]]):
        self.templates = templates
        self.words = [words_of(text) for _, text in templates]
        if any(len(w) < GRAM for w in self.words):
            raise ValueError(f"templates need {GRAM} words or more")
        self.number = {w: xxhash.xxh3_64_intdigest(w) | 1 for words in self.words for w in words}
        self.ids = [np.array([self.number[w] for w in words], "u8") for words in self.words]
        places: dict[int, list[tuple[int, int]]] = {}
        for t, ids in enumerate(self.ids):
            hashes = gram_hashes(ids)
            for at in winnow(hashes).tolist():
                places.setdefault(int(hashes[at]), []).append((t, at))
        self.places = places
        self.keys = np.array(sorted(places), "u8")

    def candidates(self, ids: np.ndarray) -> list[tuple[int, int, int]]:
        """Template, lowest and highest diagonal of each candidate."""
        hashes = gram_hashes(ids)
        at = winnow(hashes)
        if not len(at):
            return []
        found = hashes[at]
        slot = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
        hits = [(t, a - p) for a, h in zip(at[self.keys[slot] == found].tolist(), found[self.keys[slot] == found].tolist()) for t, p in self.places[h]]
        out: list[tuple[int, int, int]] = []
        for t, diagonal in sorted(hits):
            if out and out[-1][0] == t and diagonal - out[-1][1] <= BAND:
                out[-1] = (t, out[-1][1], diagonal)
            else:
                out.append((t, diagonal, diagonal))
        return out


# -- alignment --------------------------------------------------------------


def align(template: np.ndarray, document: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """Best local alignment with diagonals from low to high: template words
    matched, and the first and last document word of the span (end excluded).
    Of equal scores the earliest end in template, then document, counts."""
    width = high - low + 1
    score = [0] * (width + 2)  # of the previous template word, by diagonal
    came = [(0, 0)] * (width + 2)  # matched words and start of the alignment
    best = (0, 0, 0, 0)
    known, length = template.tolist(), len(document)
    text = document[max(0, low) : max(0, high + len(known))].tolist()
    for i, word in enumerate(known):
        here, from_ = [0] * (width + 2), [(0, 0)] * (width + 2)
        for d in range(1, width + 1):
            j = i + low + d - 1
            if not 0 <= j < length:
                continue
            same = text[j - max(0, low)] == word
            value = score[d] + (2 if same else -1)
            matched, start = came[d] if score[d] else (0, j)
            path = (matched + same, start)
            if score[d + 1] - 1 > value:  # a template word left out
                value, path = score[d + 1] - 1, came[d + 1]
            if here[d - 1] - 1 > value:  # a document word left out
                value, path = here[d - 1] - 1, from_[d - 1]
            if value > 0:
                here[d], from_[d] = value, path
                if value > best[0]:
                    best = (value, path[0], path[1], j + 1)
        score, came = here, from_
    return best[1:]


def scan_words(index: Index, words: list[str], least: float) -> list[tuple[int, int, int, int]]:
    """Matches of a document: template, matched words, first word, end."""
    ids = np.array(list(map(index.number.get, words, [0] * len(words))), "u8")
    found, left, of = [], ids, None
    for t, low, high in index.candidates(ids):  # by template
        if t != of:
            left, of = ids.copy(), t
        while True:  # again without what was found, for notices in a row
            matched, start, end = align(index.ids[t], left, low - BAND, high + BAND)
            if matched < least * len(index.ids[t]):
                break
            found.append((t, matched, start, end))
            left[start:end] = 0
    return found


def largest(matches: list[tuple], sizes: list[int]) -> list[tuple]:
    """Without matches that lie within the span of one with more words
    matched (of equal ones that of the shorter template, then the first)."""
    out, starts, ends = [], [], []  # kept spans that lie in no other, so both ascend
    for m in sorted(matches, key=lambda m: (-m[1], sizes[m[0]], m[2], m[0])):
        at = bisect_right(starts, m[2])
        if at and ends[at - 1] >= m[3]:
            continue
        out.append(m)
        low = bisect_left(starts, m[2])
        high = bisect_right(ends, m[3])
        starts[low:high], ends[low:high] = [m[2]], [m[3]]
    return sorted(out, key=lambda m: (m[2], m[3], m[0]))


def _blocks(templates: list[tuple[str, str]]) -> list[list[tuple[str, str]]]:
    out: list[list[tuple[str, str]]] = [[]]
    held = 0
    for name, text in templates:
        n = len(words_of(text))
        if held and held + n > BLOCK_WORDS:
            out.append([])
            held = 0
        out[-1].append((name, text))
        held += n
    return out


def scan(documents: DataFrame, templates: list[tuple[str, str]] | None = None, least: float = 0.8) -> DataFrame:
    """One row per match: ``doc_id, license, template`` (its number),
    ``matched`` words, ``coverage`` of the template, ``start`` and ``end`` (code
    points of the text) and the ``span`` itself."""
    make_importable(documents.sparkSession)
    templates = default_templates() if templates is None else templates
    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, license string, template int, matched int, coverage double, start int, end int, span string"
    if not templates:
        kinds = dict(c.split() for c in schema.split(", "))
        return documents.where("false").select("doc_id", *(F.lit(None).cast(t).alias(c) for c, t in kinds.items() if c != "doc_id"))
    out, first = None, 0
    for block in _blocks(templates):
        rows = documents.select("doc_id", "text").mapInArrow(_scanner(Index(block), first, least, schema), schema)
        out = rows if out is None else out.unionByName(rows)
        first += len(block)
    return out


def _scanner(index: Index, first: int, least: float, schema: str):
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [None, pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.string()]

    sizes = list(map(len, index.words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            for k, text in enumerate(batch.column(1).to_pylist()):
                words = words_of(text or "")
                if len(words) < GRAM:
                    continue
                matches = largest(scan_words(index, words, least), sizes)
                if matches:
                    spans = [m.span() for m in _WORD.finditer(text)]
                for t, matched, begin, end in matches:
                    a, b = spans[begin][0], spans[end - 1][1]
                    share = matched / len(index.ids[t])
                    found.append((k, index.templates[t][0], first + t, matched, share, a, b, text[a:b]))
            columns = list(zip(*found)) or [()] * len(names)
            ids = batch.column(0).take(pa.array(columns[0], pa.int64()))
            rest = [pa.array(c, t) for c, t in zip(columns[1:], kinds[1:])]
            yield pa.RecordBatch.from_arrays([ids, *rest], names)

    return run


def by_document(documents: DataFrame, matches: DataFrame) -> DataFrame:
    """Distinct licenses per document id, sorted; documents without a match
    have none."""
    held = matches.groupBy("doc_id").agg(F.array_sort(F.collect_set("license")).alias("licenses"))
    ids = documents.select("doc_id").distinct()
    joined = ids.join(held, ids["doc_id"].eqNullSafe(held["doc_id"]), "left").select(ids["doc_id"], "licenses")
    return joined.select("doc_id", F.coalesce("licenses", F.array().cast("array<string>")).alias("licenses"))
