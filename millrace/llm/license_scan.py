"""License texts and notices in documents.

Templates are cut into runs of words; winnowing keeps some of their hashes,
which form an inverted index held by every task, as the templates are few.  All
runs of words of a document are looked up in it.  Where hits of a template lie
on about one diagonal, template and document are aligned word by word within a
band around it, and the share of template words that match is the coverage.
"""

import re
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.words import WordHashes, shingle_hashes

_WORD = re.compile(r"[^\W_]+")


class Settings(NamedTuple):
    run: int = 3
    window: int = 4
    band: int = 12
    least_coverage: float = 0.8


# Public license texts and the notices that refer to them.
TEMPLATES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all
        copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY
        KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
        PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR
        ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
        OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain the above
        copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form
        must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License.""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of the
        GNU General Public License as published by the Free Software Foundation, either version 3 of the License,
        or (at your option) any later version. This program is distributed in the hope that it will be useful,
        but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
        PURPOSE. See the GNU General Public License for more details.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software, either in source code form or as a
        compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "MIT notice": "Released under the MIT License.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "All rights reserved": "All rights reserved.",
}


def words_of(text) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def winnowed(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions of the smallest hash (the last of equals) of every window."""
    if len(hashes) <= window:
        return np.array([len(hashes) - 1 - np.argmin(hashes[::-1])]) if len(hashes) else np.empty(0, int)
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)[:, ::-1]
    return np.unique(np.arange(len(views)) + window - 1 - views.argmin(1))


class TemplateIndex:
    def __init__(self, templates: dict[str, str], settings: Settings):
        self.settings, self.hashes = settings, WordHashes()
        self.names = list(templates)
        self.words = [self.hashed(templates[name]) for name in self.names]
        found = []
        for number, words in enumerate(self.words):
            runs = shingle_hashes(words, settings.run)
            found += [(int(runs[at]), number, int(at)) for at in winnowed(runs, settings.window)]
        found.sort()
        self.keys = np.array([f[0] for f in found], np.uint64)
        self.template = np.array([f[1] for f in found], np.int64)
        self.at = np.array([f[2] for f in found], np.int64)

    def hashed(self, text) -> np.ndarray:
        return self.hashes.of([w.encode() for w in words_of(text)])

    def hits(self, words: np.ndarray):
        """(template, diagonal) of every indexed run in a text, sorted."""
        runs = shingle_hashes(words, self.settings.run)
        first = np.searchsorted(self.keys, runs)
        counts = np.searchsorted(self.keys, runs, "right") - first
        where = np.flatnonzero(counts)
        entries = np.concatenate([np.arange(first[p], first[p] + counts[p]) for p in where] or [np.empty(0, int)])
        places = np.repeat(where, counts[where])
        return sorted(set(zip(self.template[entries].tolist(), (places - self.at[entries]).tolist())))

    def found(self, text):
        """(license, matched words, template words, first word, last word) of a text."""
        words = self.hashed(text)
        band, out = self.settings.band, []
        start = 0
        hits = self.hits(words) if len(words) else []
        for at in range(1, len(hits) + 1):
            if at < len(hits) and hits[at][0] == hits[start][0] and hits[at][1] - hits[at - 1][1] <= band:
                continue
            template, low, high = hits[start][0], hits[start][1], hits[at - 1][1]
            start = at
            pairs = aligned(self.words[template], words, low - band, high + band)
            size = len(self.words[template])
            if pairs and len(pairs) >= self.settings.least_coverage * size:
                out.append((self.names[template], len(pairs), size, pairs[0][1], pairs[-1][1]))
        # What lies within a longer match is part of it.
        out.sort(key=lambda f: (-f[1], f[3], f[0]))
        kept = []
        for one in out:
            if not any(k[3] <= one[3] and one[4] <= k[4] for k in kept):
                kept.append(one)
        return sorted(kept, key=lambda f: (f[3], f[0]))


def aligned(template: np.ndarray, words: np.ndarray, low: int, high: int) -> list[tuple[int, int]]:
    """Most equal (template, text) positions in order, on the diagonals low to high."""
    width = high - low + 1
    # best[i][d]: matches of the first i template words in the text before word i + low + d
    best = np.zeros((len(template) + 1, width), np.int32)
    equal = np.zeros((len(template), width), bool)
    for i in range(len(template)):
        first = i + low
        inside = np.arange(max(0, -first), max(0, min(width, len(words) - first)))
        equal[i, inside] = words[first + inside] == template[i]
        # Without the template word, the same place in the text is one diagonal down.
        skipped = np.append(best[i][1:], best[i][-1])
        best[i + 1] = np.maximum.accumulate(np.maximum(skipped, best[i] + equal[i]))
    i, d, pairs = len(template), width - 1, []
    while i and best[i][d]:
        here = best[i][d]
        if d and best[i][d - 1] == here:
            d -= 1
        elif equal[i - 1, d] and best[i - 1][d] + 1 == here:
            pairs.append((i - 1, i - 1 + low + d))
            i -= 1
        else:
            i, d = i - 1, min(d + 1, width - 1)
    return pairs[::-1]


def licenses(docs: DataFrame, id_col="doc_id", text_col="text", templates=None, settings=Settings()) -> DataFrame:
    """(id, license, coverage, matched_words, start, end): one row per match.

    ``start`` and ``end`` (exclusive) count code points of the text.  Matches of
    different templates may overlap, but one that lies within a longer one is
    left out.  Null and empty texts have no rows.  Rows without an id and
    repeated rows are scanned like any other.  Other columns are not read.
    """
    chosen = dict(TEMPLATES if templates is None else templates)

    def run(frames):
        index = TemplateIndex(chosen, settings)
        for frame in frames:
            rows = []
            for key, text in zip(frame["id"], frame["text"]):
                found = index.found(text)
                spans = [m.span() for m in _WORD.finditer(text.lower())] if found else []
                rows += [(key, name, n / size, n, spans[a][0], spans[b][1]) for name, n, size, a, b in found]
            yield pd.DataFrame(rows, columns=["id", "license", "coverage", "matched_words", "start", "end"])

    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("license", T.StringType()),
            T.StructField("coverage", T.DoubleType()),
            T.StructField("matched_words", T.LongType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
        ]
    )
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInPandas(run, schema).withColumnRenamed("id", id_col)
