"""License scans: winnowed fingerprints of templates pick candidates, banded alignment measures them.

Texts and templates are read as lower-case words without punctuation at their ends. The hashes of all runs of `GRAM` words
of a template are winnowed (the least of every `WINDOW` neighbours stays) into an inverted index, small and fixed, that
every task holds. All runs of a document are looked up there, so any stretch of GRAM + WINDOW - 1 words that it shares with
a template meets the index. Where a match at the threshold may leave only shorter stretches of a template (short ones: four
of five words are two runs of two), its runs of that length are all indexed: whichever words are changed, left out or
replaced, what reaches `coverage` has a hit. Hits of one template at nearby diagonals form a candidate; where the words
around it suffice, it is aligned in a band around its diagonal, and the aligned words give the coverage of the template and
the span in the text, in code points. The rows are one for each match of at least `coverage`.

Defined cases: null and empty texts give no rows; a repeated row gives its matches again; a template found twice in a
text gives two rows; of overlapping candidates of one template the longest match stays (ties: the shorter span, then the
first); a text of any length is scanned whole; a null doc_id is passed through; texts without matches and empty tables give none; other columns are
ignored.
"""

from __future__ import annotations

import bisect
import math
import re
import string
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonewright.llm.common import Remembered, per_process, table

GRAM, WINDOW = 3, 2
BAND = 8
COVERAGE = 0.8
CACHED_WORDS = 150_000

# Notices of public licenses as they are written in practice.
TEMPLATES = {
    "MIT (notice)": "Released under the MIT License.",
    "Apache-2.0 (notice)": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0 (notice)": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 (notice)": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under the Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution."
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
    ),
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

_EDGES = string.punctuation + "“”‘’«»…"
_WORD = re.compile(r"\S+")


def normal(word: str) -> str:
    return word.lower().strip(_EDGES)


class Index:
    """The inverted indexes of the templates' fingerprints, one for each length of run, made for a coverage."""

    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE):
        self.names, self.coverage = list(templates), coverage
        self.words = [[w for w in map(normal, t.split()) if w] for t in templates.values()]
        self.number = {w: i + 1 for i, w in enumerate(dict.fromkeys(w for t in self.words for w in t))}
        self.known = Remembered(lambda w: self.number.get(n, 0) if (n := normal(w)) else -1, CACHED_WORDS)
        self.ids = [[self.number[w] for w in words] for words in self.words]
        self.needed = [math.ceil(coverage * len(words) - 1e-9) for words in self.words]
        # as many words as may be left out shift what follows them
        self.bands = [max(BAND, len(ids) - n) for ids, n in zip(self.ids, self.needed, strict=True)]
        self.times = [Counter(ids) for ids in self.ids]
        self.places: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for k, ids in enumerate(self.ids):
            run = least_run(len(ids), self.needed[k])
            size = min(GRAM, run)
            if size:
                hashes = grams(np.array(ids, np.int64), size)
                at = winnow(hashes) if run >= GRAM + WINDOW - 1 else np.arange(len(hashes))
                for i in at.tolist():
                    self.places[size][int(hashes[i])].append((k, i))
        self.hashes = {size: np.array(sorted(held), np.int64) for size, held in self.places.items()}

    def read(self, text: str) -> np.ndarray:
        """For each word of the text its number in the templates' vocabulary, or 0; words of punctuation only are -1."""
        self.known.trim()
        words = text.split()
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))


def least_run(words: int, needed: int) -> int:
    """The longest run of neighbouring words that is sure to be left of so many when only `needed` are."""
    gaps = words - needed
    return -(-needed // (gaps + 1))


def grams(ids: np.ndarray, size: int) -> np.ndarray:
    """The hashes of all runs of so many words."""
    m = len(ids) - size + 1
    if m < 1:
        return np.zeros(0, np.int64)
    code = np.zeros(m, np.uint64)
    for k in range(size):
        code = (code ^ ids[k : k + m].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
    return (code >> np.uint64(1)).astype(np.int64)


def winnow(hashes: np.ndarray) -> np.ndarray:
    """The places of the fingerprints: the least hash (the rightmost of equals) of every WINDOW in a row."""
    m = len(hashes)
    best = np.arange(min(m, max(1, m - WINDOW + 1)))
    for k in range(1, min(WINDOW, m)):
        other = np.arange(k, k + len(best))
        best = np.where(hashes[other] <= hashes[best], other, best)
    return best[np.concatenate([[True], best[1:] != best[:-1]])] if m else best


def align(template: list[int], ids: list[int], diagonal: int, band: int = BAND) -> tuple[int, int, int]:
    """(matched words, first and last matched place in ids) of the best common subsequence near the diagonal, the one
    with the fewest words skipped among equals."""
    width = 2 * band + 1
    # by offset from the diagonal: (matches, minus words skipped since the first match, first place, last place)
    row = [(0, 0, -1, -1)] * width
    best = (0, 0, -1, -1)
    for i, t in enumerate(template):
        new: list[tuple[int, int, int, int]] = []
        for o in range(width):
            j = i + diagonal + o - band
            state = row[o + 1] if o + 1 < width else (0, 0, -1, -1)  # the template's word is left out
            if new and new[-1][0]:  # the text's word is left out
                a = new[-1]
                state = max(state, (a[0], a[1] - 1, a[2], a[3]))
            if 0 <= j < len(ids) and ids[j] == t:
                a = row[o]
                state = max(state, (a[0] + 1, a[1], a[2] if a[0] else j, j))
            new.append(state)
        row = new
        best = max([best, *row], key=lambda x: x[:2])
    return best[0], best[2], best[3]


def hits(ids: np.ndarray, index: Index) -> dict[int, list[int]]:
    """The diagonals (place in the text less place in the template) of the runs that each template shares with the text."""
    found: dict[int, list[int]] = defaultdict(list)
    for size, known in index.hashes.items():
        hashes = grams(ids, size)
        if len(hashes):
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            for i in np.flatnonzero(known[place] == hashes).tolist():
                for k, t in index.places[size][int(hashes[i])]:
                    found[k].append(i - t)
    return found


def scan(text: str, index: Index) -> list[tuple[str, float, int, int, int, int]]:
    """(template, coverage, start, end, words matched, words of the template) of each match in the text."""
    all_ids = index.read(text)
    real = np.flatnonzero(all_ids >= 0)
    ids = all_ids[real]
    spans, out = None, []
    for k, diagonals in sorted(hits(ids, index).items()):
        template, band, done = index.ids[k], index.bands[k], []
        diagonals.sort()
        start = 0
        while start < len(diagonals):  # hits whose diagonals lie within half a band make one candidate
            end = bisect.bisect_right(diagonals, diagonals[start] + band)
            diagonal = diagonals[(start + end) // 2]
            start = end
            low, high = max(0, diagonal - band), min(len(ids), diagonal + len(template) + band)
            near = ids[low:high].tolist()
            if sum(min(n, near.count(t)) for t, n in index.times[k].items()) < index.needed[k]:
                continue  # too few of the template's words, in whatever order
            n, first, last = align(template, near, diagonal - low, band)
            if n >= index.needed[k]:
                done.append((low + first, low + last, n))
        kept: list[tuple[int, int, int]] = []
        for first, last, n in sorted(done, key=lambda x: (-x[2], x[1] - x[0], x[0])):
            if all(last < a or first > b for a, b, _ in kept):
                kept.append((first, last, n))
        for first, last, n in sorted(kept):
            if spans is None:
                spans = [m.span() for m in _WORD.finditer(text)]
            out.append((index.names[k], n / len(template), spans[real[first]][0], spans[real[last]][1], n, len(template)))
    return out


_OUT = "doc_id long, license string, coverage double, span_start long, span_end long, n_matched long, n_template long"


def _scan(templates: dict[str, str], coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = per_process(f"licenses {coverage} {sorted(templates.items())}", lambda: Index(templates, coverage))
        types = [pa.int64(), pa.string(), pa.float64(), *[pa.int64()] * 4]
        names = [x.split()[0] for x in _OUT.split(", ")]
        for batch in batches:
            rows = [(doc_id, *m) for doc_id, text in zip(batch.column(0).to_pylist(), (t.as_py() for t in batch.column(1)), strict=True) for m in scan(text or "", index)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=names)

    return run


def scan_licenses(docs: DataFrame, *, templates: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """One row per match: doc_id, license, coverage, span_start, span_end (code points), n_matched, n_template."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(_scan(templates or TEMPLATES, coverage), _OUT)


def op7_license_scans(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))
