"""License scans by patience alignment of license templates with the text around their words.

Sliding counts of template words find the regions of a text that can hold a template. In a region, words
unique to both the region and the template are anchors; their longest increasing subsequence is kept and
the gaps between anchors are aligned in the same way. Coverage is the share of the template's words that
are aligned. The words that tell a license from its relatives (its name and version) must all be aligned,
neighbours as neighbours, and a short template is found whole or not at all. A long template of which no
dense region is left is aligned with each whole stretch between its notices, so it is found with any amount
of other text between its words.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, table

#: Texts of license notices, by name.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
}
_PHRASES = {  # name as a notice says it -> license
    "MIT License": "MIT", "X11 License": "X11", "BSD License": "BSD", "2-Clause BSD License": "BSD", "3-Clause BSD License": "BSD", "ISC License": "ISC",
    "GNU General Public License, version 2": "GPL-2.0", "GNU General Public License, version 3": "GPL-3.0",
    "GNU Affero General Public License, version 3": "AGPL-3.0", "GNU Lesser General Public License, version 2.1": "LGPL-2.1",
    "GNU Lesser General Public License, version 3": "LGPL-3.0", "Mozilla Public License, version 2.0": "MPL-2.0",
    "CC BY-ND 4.0": "CC-BY-ND-4.0", "CC BY-NC-SA 4.0": "CC-BY-NC-SA-4.0", "CC BY-NC-ND 4.0": "CC-BY-NC-ND-4.0",
}
_HEADS = {  # first lines of whole license texts
    "GNU General Public License Version 2, June 1991": "GPL-2.0", "GNU General Public License Version 3, 29 June 2007": "GPL-3.0",
    "GNU Affero General Public License Version 3, 19 November 2007": "AGPL-3.0", "GNU Lesser General Public License Version 2.1, February 1999": "LGPL-2.1",
    "GNU Lesser General Public License Version 3, 29 June 2007": "LGPL-3.0", "Apache License Version 2.0, January 2004": "Apache-2.0",
    "This is free and unencumbered software released into the public domain.": "Unlicense",
}
_SPDX = "MIT Apache-2.0 GPL-2.0 GPL-3.0 AGPL-3.0 LGPL-2.1 LGPL-3.0 MPL-2.0 ISC X11 Unlicense CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0".split()
_NOTICE = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
_GNU = {"GPL-2.0": ("General Public License", "2"), "AGPL-3.0": ("Affero General Public License", "3"), "LGPL-2.1": ("Lesser General Public License", "2.1"), "LGPL-3.0": ("Lesser General Public License", "3")}
_SPDX_WORD = "spdx-license-identifier"
for _phrase, _of in _PHRASES.items():
    TEMPLATES.setdefault(_of, []).append(f"under {'' if _phrase.startswith('CC') else 'the '}{_phrase}")
for _phrase, _of in _HEADS.items():
    TEMPLATES.setdefault(_of, []).append(_phrase)
for _of, _values in _GNU.items():
    TEMPLATES[_of].append(_NOTICE.format(*_values))
for _of in _SPDX:
    TEMPLATES.setdefault(_of, []).append(f"{_SPDX_WORD}: {_of}")
for _of in ("GPL-2.0", "GPL-3.0", "AGPL-3.0"):
    TEMPLATES[_of] += [f"{_SPDX_WORD}: {_of}-or-later", f"{_SPDX_WORD}: {_of}-only"]
for _id in ("BSD-2-Clause", "BSD-3-Clause"):
    TEMPLATES["BSD"].append(f"{_SPDX_WORD}: {_id}")
#: Templates of up to so many words are short.
SHORT = 12
#: Words that tell licenses apart, and version numbers with the word before them.
NAMES = frozenset("mit x11 isc bsd apache gnu affero lesser general public mozilla mpl cc creative commons unlicense unencumbered 2-clause 3-clause".split())
_VERSION = re.compile(r"v?\d[\d.]*$")
_CC = re.compile(r"by(-[a-z]+)*$|attribution")
COVERAGE = 0.8
#: A dense region is so much longer than its template: room for words put in between.
ROOM = 1.25

_EDGE = re.compile(r"^\W+|\W+$")


def clean_words(text: str) -> list[str]:
    """Lower-case words without punctuation at their ends; a word of punctuation only becomes empty."""
    return [_EDGE.sub("", w) for w in text.lower().split()]


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of pairs (sorted by the first) whose second members increase."""
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, (_, y) in enumerate(pairs):
        j = bisect_left(tails, y)
        tails[j : j + 1], at[j : j + 1] = [y], [k]
        back.append(at[j - 1] if j else -1)
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned word positions of two texts, by patience: equal ends, then unique common words, then the gaps.

    A gap without a unique common word is aligned by its longest common subsequence.
    """
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            out.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            out.append((j, m))
        if i == j or k == m:
            continue
        seen_a: dict[str, int] = {}
        seen_b: dict[str, int] = {}
        for seen, ws, lo, hi in ((seen_a, a, i, j), (seen_b, b, k, m)):
            for p in range(lo, hi):
                seen[ws[p]] = -1 if ws[p] in seen else p
        anchors = increasing(sorted((p, seen_b[w]) for w, p in seen_a.items() if p >= 0 and seen_b.get(w, -1) >= 0))
        if not anchors:  # no word is unique here: the longest common subsequence of what is left
            places: dict[str, list[int]] = {}
            for y in range(m - 1, k - 1, -1):
                places.setdefault(b[y], []).append(y)
            out += increasing([(x, y) for x in range(i, j) for y in places.get(a[x], ())])
            continue
        p, q = i, k
        for x, y in [*anchors, (j, m)]:
            todo.append((p, x, q, y))
            p, q = x + 1, y + 1
        out += anchors
    return sorted(out)


def telling(ws: list[str]) -> list[int]:
    """Positions of a template's words that tell it from other licenses."""
    version = [bool(_VERSION.match(w)) for w in ws]
    cc = "cc" in ws or "creative" in ws
    return [
        i for i, w in enumerate(ws)
        if ws[0] == _SPDX_WORD or w in NAMES or version[i] or cc and _CC.match(w) or w in ("version", "v") and i + 1 < len(ws) and version[i + 1]
    ]


class Scanner:
    """Templates with their vocabularies."""

    def __init__(self, templates: dict[str, list[str]], coverage: float):
        self.items = [(name, [w for w in clean_words(t) if w]) for name, texts in templates.items() for t in texts]
        self.coverage = coverage
        self.words = [frozenset(ws) for _, ws in self.items]
        self.vocabulary = frozenset().union(*self.words)
        self.needs = [len(ws) if len(ws) <= SHORT else int(np.ceil(coverage * len(ws))) for _, ws in self.items]
        self.telling = [telling(ws) for _, ws in self.items]
        self.musts = [frozenset(ws if len(ws) <= SHORT else (ws[i] for i in told)) for (_, ws), told in zip(self.items, self.telling)]

    def regions(self, hit: np.ndarray, k: int):
        """Stretches of words that have enough words of template ``k`` close together."""
        size = len(self.items[k][1])
        need, room = self.needs[k], int(size * ROOM) + 2
        if hit.sum() < need:
            return
        total = np.concatenate([[0], np.cumsum(hit)])
        ends = np.minimum(np.arange(len(hit)) + room, len(hit))
        starts = np.flatnonzero((total[ends] - total[:-1] >= need) & (hit == 1))
        at = -1
        for s in starts.tolist():
            if s >= at:
                at = yield s, int(ends[s])

    def possible(self, k: int, present: set[str]) -> bool:
        """Whether a text with these template words can hold template ``k``."""
        return self.musts[k] <= present and sum(w in present for w in self.items[k][1]) >= self.needs[k]

    def tells(self, k: int, pairs: list[tuple[int, int]]) -> bool:
        """Whether the telling words are aligned, neighbours as neighbours."""
        at = {j: i for i, j in pairs}
        told = self.telling[k]
        return all(j in at for j in told) and all(at[y] == at[x] + 1 for x, y in zip(told, told[1:]) if y == x + 1)

    def scan(self, text: str) -> list[tuple[str, int, int, float]]:
        """(name, first word, end word, coverage) of every notice, in text order; the best where they overlap."""
        ws = clean_words(text)
        if not ws:
            return []
        present = self.vocabulary & set(ws)
        able = [k for k in range(len(self.items)) if self.possible(k, present)]
        if not able:
            return []
        found = []
        for k in able:
            name, words_ = self.items[k]
            steps = self.regions(np.fromiter((w in self.words[k] for w in ws), np.int64, len(ws)), k)
            region = next(steps, None)
            stretches, last = [], 0
            while region:
                a, b = region
                hit = self.aligned(k, ws, a, b)
                if hit:
                    found.append(hit)
                    stretches.append((last, hit[3]))
                    last = hit[4]
                try:
                    region = steps.send(last if hit else a + 1)
                except StopIteration:
                    region = None
            if len(words_) > SHORT:
                for a, b in [*stretches, (last, len(ws))]:
                    if b - a > len(words_) * ROOM and self.possible(k, self.words[k].intersection(ws[a:b])) and (hit := self.aligned(k, ws, a, b)):
                        found.append(hit)
        best: list[tuple[int, int, str, float]] = []
        for share, n, name, a, b in sorted(found, key=lambda f: (-f[1] * f[0], f[3], f[2])):
            at = bisect_left(best, (a,))
            if (at == len(best) or best[at][0] >= b) and (at == 0 or best[at - 1][1] <= a):
                insort(best, (a, b, name, share))
        return [(name, a, b, share) for a, b, name, share in best]

    def aligned(self, k: int, ws: list[str], a: int, b: int) -> tuple[float, int, str, int, int] | None:
        """(coverage, aligned words, name, first word, end word) of template ``k`` in a stretch; None if it is not there."""
        name, words_ = self.items[k]
        pairs = align(ws[a:b], words_)
        if len(pairs) < self.needs[k] or not self.tells(k, pairs):
            return None
        return len(pairs) / len(words_), len(pairs), name, a + pairs[0][0], a + pairs[-1][0] + 1


def find_licenses(df: DataFrame, text: str = "text", templates: dict[str, list[str]] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """``df`` with ``licenses``: an array of (name, start, end, coverage) per whole text, in word positions.

    Null and empty texts have none. Every row is kept, repeated notices are all reported, and where
    notices overlap the one with the most aligned words stays (ties: the earlier, then by name). A column
    of ``df`` named licenses gets an underscore in front.
    """
    if clash := [c for c in df.columns if c.lower() == "licenses"]:
        df = df.withColumnRenamed(clash[0], free_name(df, "licenses"))
    scanner = Scanner(templates, coverage)

    @F.pandas_udf("array<struct<name:string,start:int,end:int,coverage:double>>")
    def notices(texts: pd.Series) -> pd.Series:
        keys = ("name", "start", "end", "coverage")
        return pd.Series([[dict(zip(keys, x)) for x in scanner.scan(t or "")] for t in texts], index=texts.index, dtype=object)

    return df.withColumn("licenses", notices(F.coalesce(F.col(text), F.lit(""))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = find_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.array_join(F.transform("licenses", lambda x: F.concat_ws(":", x["name"], x["start"], x["end"])), ",")
    names = F.array_join(F.array_sort(F.array_distinct(F.transform("licenses", lambda x: x["name"]))), ",")
    best = F.array_max(F.transform("licenses", lambda x: x["coverage"]))
    return docs.select("doc_id", F.size("licenses").cast("long").alias("n_notices"), names.alias("names"), spans.alias("spans"), best.alias("best_coverage"))
