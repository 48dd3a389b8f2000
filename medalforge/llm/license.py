"""License scan: winnowed template fingerprints, then banded alignment.

Templates and texts are sequences of words (runs of letters and digits,
lower-cased). Of each template, the hashes of GRAM neighbouring words are winnowed:
in every WINDOW neighbouring hashes the smallest is kept, so any run of
GRAM + WINDOW - 1 words that a text shares with a template holds a kept one.
The kept hashes form an inverted index (hash to template and place), small
enough for every task, since templates are a parameter and at most
``MAX_TEMPLATE_WORDS`` words in all. All hashes of all texts are looked up in numpy;
texts without a hit end there.

Hits of a template on nearby diagonals form a run, which is aligned with
the text in a band around it (local alignment of words: match 1, mismatch and
gap -1); a whole copy on a diagonal of the run needs no alignment. A find counts
if the matched words cover at least ``min_coverage`` of the template; of
overlapping finds the one with the most matched words, then the highest
coverage, stays. Each run is aligned again in the words that a find, or an
alignment too weak to count, leaves on its two sides, until none of its hits lies
there; so repeated notices are all found, however near.

A copy that more words are put into than the band holds has no such alignment. Its pieces, words that equal the
template's without a break, ``PIECE`` at least, are chained: the heaviest sequence of pieces that rises in
text and template, over gaps of any length, is a find if it covers enough. It competes with other finds by the words of
its pieces, so what stands in a gap is found too; its span goes from the first piece to the last.
Spans are offsets in characters (code points) of the whole text.

Defined results: null and empty texts have no finds and so no rows; repeated rows
are scanned one by one; a null key is an ordinary value; a template of fewer
than GRAM words is one hash of all its words and is found only whole.
"""

from __future__ import annotations

import bisect
import heapq
import re
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import encoded, steps, strings, table

GRAM, WINDOW, BAND = 3, 2, 8
MIN_COVERAGE = 0.8
PIECE = 8  # words of a piece that is chained over gaps
LONG = 40  # words of a template from which a bound is taken before an alignment
MAX_TEMPLATE_WORDS = 500_000
_WORD = re.compile(r"[^\W_]+")

# Public notices by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License."),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0-or-later-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution."),
    "All-rights-reserved": "All rights reserved.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "BSD-2-Clause-notice": "Licensed under the BSD 2-Clause License.",
    "ISC": "Licensed under the ISC License.",
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "EPL-2.0-header": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    "BSL-1.0-header": "Distributed under the Boost Software License, Version 1.0.",
    "GPL-2.0-or-later-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version."),
    "LGPL-2.1-or-later-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version."),
    "LGPL-3.0-or-later-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version."),
    "AGPL-3.0-or-later-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version."),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-ND-4.0-notice": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-NC-SA-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    "CC-BY-NC-ND-4.0-notice": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    **{f"CC-{kind}-4.0{end}": f"Licensed under CC {kind} 4.0." for kind, end in (
        ("BY", "-short"), ("BY-SA", "-short"), ("BY-ND", ""), ("BY-NC-SA", ""), ("BY-NC-ND", ""))},
}
# Whole license texts, one file each.
TEMPLATES |= {f"{f.stem}-body": f.read_text("utf-8") for f in sorted((Path(__file__).parent / "licenses").glob("*.txt"))}


def word_list(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def word_hash(word: str) -> int:
    raw = word.encode("utf-8", "surrogatepass")
    return zlib.crc32(raw) << 32 | zlib.crc32(raw, 0x5EED)


def gram_hashes(hashes: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every run of ``gram`` word hashes."""
    n = len(hashes) - gram + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        x = np.full(n, gram, np.uint64)
        for k in range(gram):
            x = (x ^ hashes[k:n + k]) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(31)
    return x


def winnow(values: np.ndarray, window: int) -> list[int]:
    """Places of the smallest value (the last of equals) of every ``window`` neighbours."""
    kept = {len(values[s:s + window]) - 1 - int(np.argmin(values[s:s + window][::-1])) + s
            for s in range(max(1, len(values) - window + 1))}
    return sorted(kept) if len(values) else []


class Index:
    """Inverted index of the templates' winnowed fingerprints."""

    def __init__(self, templates: dict[str, str], gram: int = GRAM, window: int = WINDOW):
        self.names = list(templates)
        self.words = [word_list(templates[n]) for n in self.names]
        if sum(map(len, self.words)) > MAX_TEMPLATE_WORDS:
            raise ValueError(f"templates of more than {MAX_TEMPLATE_WORDS} words in all")
        self.hashes = [np.array([word_hash(w) for w in words], np.uint64) for words in self.words]
        self.known = frozenset().union(*self.words)
        self.places: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.grams = sorted({min(gram, len(w)) for w in self.words if w})
        for t, words in enumerate(self.words):
            if words:
                values = gram_hashes(self.hashes[t], min(gram, len(words)))
                for at in winnow(values, window):
                    self.places[int(values[at])].append((t, at))
        self.values = np.array(sorted(self.places), np.uint64)

    def holds(self, values: np.ndarray) -> np.ndarray:
        if not len(self.values):
            return np.zeros(len(values), bool)
        at = np.minimum(np.searchsorted(self.values, values), len(self.values) - 1)
        return self.values[at] == values


def align(template: list[str], words: list[str], start: int, band: int,
          low: int = 0, high: int | None = None) -> tuple[int, int, int]:
    """Best local alignment of words[low:high] with words[start + i + k] facing template[i], |k| <= band: matched
    words, first and one past last word (0, 0, 0 if nothing matches)."""
    width = 2 * band + 1
    high = len(words) if high is None else high
    # per offset k: score, matched, begin
    last = [(0, 0, -1)] * width
    best = (0, 0, 0, 0)
    for i, wanted in enumerate(template):
        row = []
        for k in range(width):
            j = start + i + k - band
            score, matched, begin = 0, 0, -1
            if low <= j < high:
                s, m, b = last[k]
                if words[j] == wanted:
                    score, matched, begin = s + 1, m + 1, b if b >= 0 else j
                elif s > 1:
                    score, matched, begin = s - 1, m, b
                if k + 1 < width and last[k + 1][0] - 1 > score:  # a template word is missing
                    score, matched, begin = last[k + 1][0] - 1, *last[k + 1][1:]
                if k and row[k - 1][0] - 1 > score:  # a word is put in
                    score, matched, begin = row[k - 1][0] - 1, *row[k - 1][1:]
                if score > best[0] or score == best[0] and matched > best[1]:
                    best = (score, matched, begin, j + 1)
            row.append((score, matched, begin))
        last = row
    return best[1], best[2], best[3]


def reachable(template: np.ndarray, hashes: np.ndarray, start: int, band: int, low: int, high: int) -> int:
    """How many template words have an equal word within the band: no alignment there matches more."""
    seen = np.zeros(len(template), bool)
    for shift in range(start - band, start + band + 1):
        a, b = max(0, low - shift), min(len(template), high - shift)
        if a < b:
            seen[a:b] |= template[a:b] == hashes[shift + a:shift + b]
    return int(seen.sum())


class Run:
    """Hits of one template (diagonal, place in the text) whose diagonals are near each other."""

    def __init__(self, t: int, hits: list[tuple[int, int]], gram: int):
        self.t, self.start, self.gram = t, hits[0][0], gram
        self.diagonals = sorted({d for d, _ in hits})
        self.places = sorted(at for _, at in hits)

    def hit_within(self, low: int, high: int) -> bool:
        first = bisect.bisect_left(self.places, low)
        return first < len(self.places) and self.places[first] + self.gram <= high

    def whole_copy(self, template: list[str], words: list[str], low: int, high: int) -> tuple[int, int, int] | None:
        """The first copy of the whole template on a diagonal of the run: no alignment scores higher."""
        n = len(template)
        return next(((n, d, d + n) for d in self.diagonals if low <= d and d + n <= high and words[d:d + n] == template), None)


def runs(t: int, hits: list[tuple[int, int]], size: int, band: int) -> list[Run]:
    """The hits of a template of ``size`` words, cut where a diagonal is more than ``band`` beyond the run's first."""
    cut: list[list[tuple[int, int]]] = []
    for d, at in sorted(hits):
        if not cut or d - cut[-1][0][0] > band:
            cut.append([])
        cut[-1].append((d, at))
    return [Run(t, run, min(GRAM, size)) for run in cut]


def gaps(taken: list[tuple[int, int]], low: int, high: int) -> list[tuple[int, int]]:
    """What the ordered, separate spans in ``taken`` leave of [low, high)."""
    out = []
    at = bisect.bisect(taken, (low, low))
    if at and taken[at - 1][1] > low:
        low = taken[at - 1][1]
    while low < high:
        end = taken[at][0] if at < len(taken) else high
        if end > low:
            out.append((low, min(end, high)))
        if at == len(taken):
            break
        low, at = max(low, taken[at][1]), at + 1
    return out


def pieces(template: list[str], words: list[str], hits: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(first, past last, place in the template) of maximal runs of equal words on the hits' diagonals, PIECE words or more."""
    out = []
    last, end = None, 0
    for d, at in sorted(hits):
        if d != last:
            last, end = d, 0
        if at < end:
            continue
        a = b = at
        while a > max(end, d, 0) and words[a - 1] == template[a - 1 - d]:
            a -= 1
        while b < len(words) and b - d < len(template) and words[b] == template[b - d]:
            b += 1
        end = max(b, at + 1)
        if b - a >= PIECE:
            out.append((a, b, a - d))
    return out


def heaviest_chain(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of pieces those of the most words that follow each other in text and template; overlaps at their ends are trimmed."""
    if not found:
        return []
    slack = PIECE // 2  # two pieces may overlap by so many words, which count once
    order = sorted(range(len(found)), key=lambda k: found[k][0])
    by_end = sorted(range(len(found)), key=lambda k: found[k][1])
    size = max(i + b - a for a, b, i in found) + 1
    tree: list[tuple[int, int]] = [(0, -1)] * (size + 1)  # prefix maxima by end in the template
    weight, before = [0] * len(found), [-1] * len(found)
    at = 0
    for k in order:
        a, b, i = found[k]
        while at < len(by_end) and found[by_end[at]][1] <= a + slack:
            j = by_end[at]
            place = found[j][2] + found[j][1] - found[j][0]
            while place <= size:
                tree[place] = max(tree[place], (weight[j], j))
                place += place & -place
            at += 1
        best, place = (0, -1), min(size, i + slack)
        while place > 0:
            best = max(best, tree[place])
            place -= place & -place
        weight[k], before[k] = best[0] + b - a, best[1]
    k = max(range(len(found)), key=lambda k: (weight[k], -found[k][0]))
    chain = []
    while k >= 0:
        chain.append(found[k])
        k = before[k]
    out: list[tuple[int, int, int]] = []
    for a, b, i in reversed(chain):
        if out:
            over = max(0, out[-1][1] - a, out[-1][2] + out[-1][1] - out[-1][0] - i)
            a, i = a + over, i + over
        if a < b:
            out.append((a, b, i))
    return out


def chained(template: list[str], words: list[str], hits: list[tuple[int, int]], own: list[tuple[int, int]],
            min_coverage: float) -> list[list[tuple[int, int, int]]]:
    """Chains that cover enough of a template, of pieces outside its finds ``own`` and outside each other."""
    out: list[list[tuple[int, int, int]]] = []
    if len(template) < 2 * PIECE:
        return out
    left = [p for p in pieces(template, words, hits) if not any(a < p[1] and p[0] < b for a, b in own)]
    while sum(b - a for a, b, _ in left) >= min_coverage * len(template):
        chain = heaviest_chain(left)
        if sum(b - a for a, b, _ in chain) < min_coverage * len(template):
            break
        out.append(chain)
        left = [p for p in left if not any(a < p[1] and p[0] < b for a, b, _ in chain)]
    return out


def scan_text(index: Index, text: str, min_coverage: float = MIN_COVERAGE, band: int = BAND) -> list[tuple]:
    """(template, coverage, matched, start, end) of a text, in order of place."""
    spans = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    words = [text[a:b].lower() for a, b in spans]
    hashes = np.array([word_hash(w) for w in words], np.uint64)
    hits = defaultdict(list)
    for gram in index.grams:
        values = gram_hashes(hashes, gram)
        for at in np.flatnonzero(index.holds(values)).tolist():
            for t, i in index.places[int(values[at])]:
                hits[t].append((at - i, at))
    heap: list[tuple] = []
    own: dict[int, list[tuple[int, int]]] = defaultdict(list)
    taken: list[tuple[int, int]] = []

    def seek(run: Run, low: int, high: int) -> None:
        """Offer the best find of a run in words[low:high], or those beside it while it is too weak."""
        template, todo = index.words[run.t], [(low, high)]
        while todo:
            low, high = todo.pop()
            if high - low < min_coverage * len(template) or not run.hit_within(low, high):
                continue
            whole = run.whole_copy(template, words, low, high)
            if not whole and len(template) > LONG and (
                    reachable(index.hashes[run.t], hashes, run.start, 2 * band, low, high) < min_coverage * len(template)):
                continue
            matched, a, b = whole or align(template, words, run.start, 2 * band, low, high)
            if matched and matched >= min_coverage * len(template):
                heapq.heappush(heap, (-matched, -matched / len(template), a, run.t, run.start, b, low, high, run))
                own[run.t].append((a, b))
            elif matched:
                todo += [(low, a), (b, high)]

    for t, places in hits.items():
        for run in runs(t, places, len(index.words[t]), band):
            seek(run, max(0, run.start - 2 * band), min(len(words), run.start + len(index.words[t]) + 2 * band))
    for t, places in hits.items():
        for chain in chained(index.words[t], words, places, own[t], min_coverage):
            matched = sum(b - a for a, b, _ in chain)
            heapq.heappush(heap, (-matched, -matched / len(index.words[t]), chain[0][0], t, -1, chain[-1][1], 0, 0, chain))

    def is_free(a: int, b: int) -> bool:
        at = bisect.bisect(taken, (a, b))
        return not (at and taken[at - 1][1] > a) and not (at < len(taken) and taken[at][0] < b)

    kept: list[tuple] = []
    while heap:
        matched, coverage, a, t, _, b, low, high, run = heapq.heappop(heap)
        words_of_it = [(a, b)] if isinstance(run, Run) else [(x, y) for x, y, _ in run]
        if all(is_free(x, y) for x, y in words_of_it):
            for x, y in words_of_it:
                bisect.insort(taken, (x, y))
            kept.append((index.names[t], -coverage, -matched, spans[a][0], spans[b - 1][1]))
        if isinstance(run, Run):
            for free in gaps(taken, low, high):
                seek(run, *free)
    return sorted(kept, key=lambda f: f[3])


def scan(df: DataFrame, templates: dict[str, str] | None = None, text: str = "text", key: str = "doc_id",
         min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """(key, template, coverage, matched, start, end): one row per find."""
    index = Index(TEMPLATES if templates is None else templates)
    source = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    schema = f"_key {source.schema['_key'].dataType.simpleString()}, template string, coverage double, matched int, start long, end long"

    def run(batches):
        for batch in steps(batches, "_text"):
            texts = strings(batch.column("_text"))
            lists = pc.split_pattern_regex(pc.utf8_lower(texts), r"[^\p{L}\p{N}]+")
            rows = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            codes, distinct = encoded(lists.flatten())
            filled = pc.binary_length(distinct).to_numpy(zero_copy_only=False) > 0
            keep = filled[codes] if len(codes) else np.zeros(0, bool)
            codes, rows = codes[keep], rows[keep]
            hashes = np.array([word_hash(w) if w in index.known else i for i, w in enumerate(distinct.to_pylist())], np.uint64)
            values = hashes[codes] if len(codes) else np.zeros(0, np.uint64)
            hit = set()
            for gram in index.grams:
                grams = gram_hashes(values, gram)
                hit.update(rows[np.flatnonzero(index.holds(grams))].tolist())  # runs over two texts are sorted out below
            out = [(row, *find) for row in sorted(hit) for find in scan_text(index, texts[row].as_py(), min_coverage)]
            if out:
                row, name, coverage, matched, start, end = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_key").take(pa.array(row, pa.int64())), pa.array(name), pa.array(coverage), pa.array(matched, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                    ["_key", "template", "coverage", "matched", "start", "end"])

    return source.mapInArrow(run, schema).withColumnRenamed("_key", key)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
