"""License scans by patience alignment of texts with license templates."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: License notices and short license texts, by name.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        'substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
        "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
    ),
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."
    ),
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed "
        "in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
        "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies."
    ),
    "all-rights-reserved": "All rights reserved.",
}
COVERAGE = 0.8

_WORDS = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def words_of(raw: bytes | None) -> list[bytes]:
    return raw.translate(_WORDS).split() if raw else []


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest increasing subsequence of the second values, by patience sorting; pairs come ordered by the first."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        at = bisect_left(tops, b)
        back.append(piles[at - 1] if at else -1)
        if at == len(tops):
            tops.append(b)
            piles.append(i)
        else:
            tops[at], piles[at] = b, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(text: list[bytes], template: list[bytes]) -> list[tuple[int, int]]:
    """Matched (text place, template place), increasing in both.

    Equal words at both ends are matched first; then words unique to both sides anchor, their
    longest increasing subsequence is kept, and each gap is aligned in the same way. A gap without
    such words stays open.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        in_text, in_template = Counter(text[a:b]), Counter(template[c:d])
        place = {w: i for i, w in enumerate(template[c:d], c) if in_template[w] == 1 and in_text.get(w) == 1}
        anchors = _increasing([(i, place[w]) for i, w in enumerate(text[a:b], a) if w in place])
        if not anchors:
            continue
        out += anchors
        for (i, j), (k, m) in zip([(a - 1, c - 1), *anchors], [*anchors, (b, d)]):
            todo.append((i + 1, k, j + 1, m))
    return sorted(out)


class Templates:
    def __init__(self, templates: dict[str, str], coverage: float):
        self.words = {name: words_of(text.encode()) for name, text in templates.items()}
        self.words = {name: w for name, w in self.words.items() if w}
        self.counts = {name: Counter(w) for name, w in self.words.items()}
        self.all = frozenset(w for ws in self.words.values() for w in ws)
        self.coverage = coverage

    def matches(self, text: list[bytes]) -> list[tuple[str, float, int, int]]:
        """(name, coverage, first word, end) of every region that aligns with at least `coverage` of a template.

        Around each occurrence of the template words that the text holds least often, regions are aligned: the
        template's length where the word has its place in it, the same widened, and one and a half lengths to both
        sides; so alignments stay short in long texts, and each copy of a notice that repeats is tried on its own.
        Exact copies count first, then of regions that overlap that with the densest alignment. Texts that lack too many of a template's words
        are skipped: no alignment of theirs can reach the coverage.
        """
        own = [w for w in text if w in self.all]
        if not own:
            return []
        have, out = Counter(own), []
        places: dict[bytes, list[int]] | None = None
        for name, template in self.words.items():
            counts, need = self.counts[name], self.coverage * len(template)
            if sum(min(have[w], n) for w, n in counts.items() if w in have) < need:
                continue
            if places is None:
                places = {}
                for i, w in enumerate(text):
                    if w in self.all:
                        places.setdefault(w, []).append(i)
            # dropping any (1 - coverage) share of the words must leave one of these in a match
            rarest = sorted((w for w in counts), key=lambda w: (have.get(w, 0), w))
            spare, seeds = len(template) - need, []
            for w in rarest:
                seeds += places.get(w, [])
                spare -= counts[w]
                if spare < 0:
                    break
            out += [(name, n / len(template), a, b) for a, b, n in self._copies(text, template, need, sorted(set(seeds)))]
        return sorted(out, key=lambda m: (m[2], m[0]))

    @staticmethod
    def _copies(text: list[bytes], template: list[bytes], need: float, seeds: list[int]) -> list[tuple[int, int, int]]:
        """(first word, end, words matched) of regions that don't overlap."""
        size, at_place = len(template), {}
        for j, w in enumerate(template):
            at_place.setdefault(w, []).append(j)
        out, end = [], 0
        for start in sorted({at - j for at in seeds for j in at_place[text[at]]}):
            if start >= end and text[start : start + size] == template:
                end = start + size
                out.append((start, end, size))
        todo = list(zip([0, *(m[1] for m in out)], [*(m[0] for m in out), len(text)]))
        while todo:
            low, high = todo.pop()
            inside = seeds[bisect_left(seeds, low) : bisect_left(seeds, high)]
            if high - low < need or not inside:
                continue
            regions = set()
            for at in inside:
                spans = [(at - j - wider, at - j + size + wider) for j in at_place[text[at]] for wider in (0, max(1, size // 4), size // 2)]
                spans.append((at - size - size // 2, at + size + size // 2 + 1))
                regions.update((max(low, a), min(high, b)) for a, b in spans)
            found = set()
            for a, b in regions:
                if b - a >= need and len(pairs := align(text[a:b], template)) >= need:
                    found.add((a + pairs[0][0], a + pairs[-1][0] + 1, len(pairs)))
            chosen: list[tuple[int, int, int]] = []
            for m in sorted(found, key=lambda m: (-m[2] / (size + m[1] - m[0]), m)):
                at = bisect_left(chosen, m)
                if (not at or chosen[at - 1][1] <= m[0]) and (at == len(chosen) or m[1] <= chosen[at][0]):
                    chosen.insert(at, m)
            out += chosen
            if chosen:  # what lies between is tried again without the words taken
                todo += zip([low, *(m[1] for m in chosen)], [*(m[0] for m in chosen), high])
        return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """For every row of docs(doc_id, text): doc_id, n_words, n_matches, licenses (names, sorted, comma-joined),
    best (the longest template matched, then by coverage and name, or null), best_coverage, matches.

    One pass without a shuffle over whole texts. A null or empty text has no matches; null ids and
    repeated rows stay; other columns are ignored. The templates are a small fixed list.
    """
    known = Templates(TEMPLATES if templates is None else templates, coverage)
    source = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    match = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, found = [], []
            for raw in common.binary(b.column(1)):
                words = words_of(raw)
                n_words.append(len(words))
                found.append(known.matches(words))
            best = [max(m, key=lambda x: (len(known.words[x[0]]), x[1], x[0]), default=None) for m in found]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array([len(m) for m in found], pa.int64()),
                    pa.array([",".join(sorted({x[0] for x in m})) for m in found], pa.string()),
                    pa.array([x and x[0] for x in best], pa.string()),
                    pa.array([x[1] if x else 0.0 for x in best], pa.float64()),
                    pa.array([[dict(zip(("license", "coverage", "start", "end"), x)) for x in m] for m in found], match),
                ],
                names=["doc_id", "n_words", "n_matches", "licenses", "best", "best_coverage", "matches"],
            )

    id_type = source.schema["doc_id"].dataType.simpleString()
    return common.mapped(source, run, f"doc_id {id_type}, n_words long, n_matches long, licenses string, best string, best_coverage double, matches array<struct<license:string,coverage:double,start:long,end:long>>")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.table(spark, sf_dir, "documents"))
