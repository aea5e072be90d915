"""License scans: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies them."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from herdframe.llm.words import _MULTIPLIERS, bare_words, distinct_sorted, shingles, slices

CONTAINMENT = 0.8
RECALL = 0.9999
TEMPLATES_PER_PASS = 2_000

# Public license notices and complete texts.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "LGPL-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "BSD-clauses": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "ISC-full": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
        "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "MIT-full": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        "the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "BSD-3-Clause-full": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must "
        "retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
        "CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, "
        "OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def _multiplier(k: int) -> np.uint64:
    """Odd factor of the band's hash; there are as many as the bands need."""
    if k < len(_MULTIPLIERS):
        return _MULTIPLIERS[k]
    return np.uint64(np.random.default_rng([20240, k]).integers(1 << 62, 1 << 63) | 1)


class Scanner:
    """Bands of a set of templates. Templates of up to L shingles are looked for in windows of two blocks of L shingles that begin at
    every block, so any L+1 shingles in a row lie in one window.

    A template of n shingles of which the share ``containment`` is in a window has a Jaccard similarity of at least
    need / (2L + n - need) with it, need being the least number of shared shingles. Bands of one row are then enough in number when
    (1 - similarity) ** bands <= 1 - recall; each class of lengths has as many as its least similarity needs.
    """

    def __init__(self, templates: dict[str, str], containment: float, recall: float):
        self.names = list(templates)
        words, starts = bare_words(pa.array(list(templates.values()), pa.string()))
        self.length = np.diff(starts)
        values, self.at = distinct_sorted(*shingles(words, starts))
        self.values, self.containment = values, containment
        self.need = np.ceil(np.diff(self.at) * containment - 1e-9).astype(np.int64)
        self.classes: dict[int, tuple[np.ndarray, int]] = {}
        count = np.diff(self.at)
        for width in sorted({1 << max(1, int(n).bit_length()) for n in count if n}):
            mine = np.flatnonzero((count > 0) & (np.array([1 << max(1, int(n).bit_length()) for n in count]) == width))
            similarity = (self.need[mine] / (2 * width + count[mine] - self.need[mine])).min()
            self.classes[width] = mine, math.ceil(math.log(1 - recall) / math.log(1 - similarity))

    def scan(self, texts: pa.Array) -> list[tuple[int, int, float, int, int]]:
        """(text, template, containment, first word, word after the last) of each occurrence."""
        words, starts = bare_words(texts)
        values, at = shingles(words, starts)
        found = []
        count = np.diff(at)
        for width, (mine, bands) in self.classes.items():
            blocks = -(-count // width)
            first = np.concatenate([[0], np.cumsum(blocks)])
            if not first[-1]:
                continue
            owner = np.repeat(np.arange(len(count)), blocks)
            begin = at[owner] + (np.arange(first[-1]) - first[owner]) * width
            follows = np.append(owner[1:] == owner[:-1], False)
            hits: set[tuple[int, int]] = set()
            for k in range(bands):
                least = np.minimum.reduceat(values * _multiplier(k), begin)
                least = np.where(follows, np.minimum(least, np.append(least[1:], least[-1])), least)
                wanted = np.array([(self.values[self.at[t] : self.at[t + 1]] * _multiplier(k)).min() for t in mine])
                maybe = np.zeros(1 << 16, bool)
                maybe[(wanted >> np.uint64(48)).astype(np.int64)] = True
                rows = np.flatnonzero(maybe[(least >> np.uint64(48)).astype(np.int64)])
                order = np.argsort(wanted, kind="stable")
                low, high = np.searchsorted(wanted[order], least[rows], "left"), np.searchsorted(wanted[order], least[rows], "right")
                for r, a, b in zip(rows[high > low], low[high > low], high[high > low], strict=True):
                    hits.update((int(r), int(mine[t])) for t in order[a:b])
            for w, t in hits:
                text, here = int(owner[w]), int(begin[w])
                stop = min(here + 2 * width, int(at[text + 1]))
                inside = np.isin(values[here:stop], self.values[self.at[t] : self.at[t + 1]])
                shared = len(np.unique(values[here:stop][inside]))
                if shared >= self.need[t]:
                    places = np.flatnonzero(inside) + here - at[text]
                    last = int(places[-1]) + min(5, int(starts[text + 1] - starts[text]))
                    found.append((text, t, shared / (self.at[t + 1] - self.at[t]), int(places[0]), last))
        return self._merged(found)

    @staticmethod
    def _merged(found: list[tuple]) -> list[tuple]:
        """Windows that see the same occurrence overlap in words; of those the best containment and the joint place are kept."""
        out: list[tuple] = []
        for text, t, share, a, b in sorted(found, key=lambda x: (x[0], x[1], x[3], x[4])):
            if out and out[-1][:2] == (text, t) and a < out[-1][4]:
                out[-1] = (text, t, max(share, out[-1][2]), out[-1][3], max(b, out[-1][4]))
            else:
                out.append((text, t, share, a, b))
        return out


_FOUND = "license string, containment double, word_from long, word_to long"


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, containment: float = CONTAINMENT, recall: float = RECALL) -> DataFrame:
    """Every occurrence of every template in the whole texts: doc_id, license, containment, word_from, word_to (the word after the last).

    Containment is the share of the template's distinct shingles of five words that the place holds; a template of fewer words is one
    shingle and matches a whole text only. Words are lower-case without punctuation at their ends. Texts are scanned where
    they are read, nothing is shuffled. Templates are a list in the code or a configuration; more than ``TEMPLATES_PER_PASS``
    are scanned in several passes, so what goes to the executors is bounded. Null and empty texts have no occurrence, a null id is
    returned as it is, repeated rows are scanned each, an empty table or list gives an empty result, other columns are ignored.
    """
    rows = docs.select("doc_id", "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    out = None
    for part in batched(templates.items(), TEMPLATES_PER_PASS) if templates else [()]:
        scanner = Scanner(dict(part), containment, recall)

        def run(batches: Iterator[pa.RecordBatch], scanner: Scanner = scanner) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in slices(batch):
                    if found := scanner.scan(piece["text"]):
                        text, t, share, a, b = zip(*found, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [piece["doc_id"].take(pa.array(text)), pa.array([scanner.names[i] for i in t]), pa.array(share, pa.float64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                            names=["doc_id", "license", "containment", "word_from", "word_to"],
                        )

        one = rows.mapInArrow(_plain(run), f"doc_id {id_type}, {_FOUND}")
        out = one if out is None else out.unionByName(one)
    return out


def _plain(fn):
    """Spark counts a function's parameters; the bound one is hidden."""
    return lambda batches: fn(batches)
