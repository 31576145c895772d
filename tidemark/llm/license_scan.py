"""License scans: winnowed fingerprints pick candidates, banded alignment reports coverage and spans.

Templates and texts become words (ASCII letters and digits, and every other character; A-Z lower-cased). Of a template's
hashes of `GRAM` words, the least of every `WINNOW` consecutive ones are its fingerprints (all of them where it has at
most `ALL_GRAMS` words); an inverted index from
fingerprint to (template, place) is small and goes to the executors. A text's hashes are looked up in it. From each hit
the template is aligned to the text in both directions, in a band of `BAND` diagonals to either side (a match scores 1; a
mismatch or a word left out costs 1); hits that share their best alignment give it once. Alignments covering at least
`MIN_COVERAGE` of their template are candidates. Those with most matched words are reported first (of equal ones that with
the best score); a candidate that overlaps a reported span is aligned again beside it and may still qualify there.

Defined results: a null, empty or wordless text has no spans; equal scores go to the first template by name, then to the
earlier place; every occurrence that holds a fingerprint is reported on its own (what is missed: of a template of five words
one whose middle word differs; of short ones any without `GRAM` unchanged words in a row; of longer ones edited ones without
`GRAM + WINNOW - 1` such words, unless a fingerprint is among them); repeated rows repeat their result; an empty table gives an empty
result; only `doc_id` and `text` are read.
"""

from __future__ import annotations

import bisect
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from tidemark.llm.texts import ASCII_LOWER, Slice, annotate, byte_class, gram_hashes, run_hashes, slices, words

GRAM, WINNOW, BAND, MIN_COVERAGE = 3, 4, 8, 0.8
#: Templates of up to so many words are indexed by every gram; so few grams give too few fingerprints for edited copies.
ALL_GRAMS = 4 * (GRAM + WINNOW - 1)

_WORD = byte_class([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])

_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
    "met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution.")

# Notices by which texts state their license.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
        "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    "bsd-2-clause": _BSD_2,
    "bsd-3-clause": (
        f"{_BSD_2} 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission."),
    "cc-by-4.0": "Licensed under CC BY 4.0",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the "
        "hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details."),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies."),
    "mit": "Released under the MIT License",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software."),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/."),
}


def word_hashes(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    data = ASCII_LOWER[part.data]
    starts, ends, first = words(part, _WORD, data)
    return starts, ends, first, run_hashes(data, starts, ends)


def winnowed(grams: np.ndarray, window: int = WINNOW) -> np.ndarray:
    """Places of the least hash of every `window` consecutive ones (the last of equal ones)."""
    if len(grams) <= window:
        return np.array([len(grams) - 1 - int(grams[::-1].argmin())]) if len(grams) else np.zeros(0, np.int64)
    held = np.lib.stride_tricks.sliding_window_view(grams, window)
    return np.unique(np.arange(len(held)) + window - 1 - held[:, ::-1].argmin(axis=1))


class Index:
    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        self.words = []
        keys, template, place = [], [], []
        for t, name in enumerate(self.names):
            part = next(slices(pa.array([templates[name]])))
            h = word_hashes(part)[3]
            self.words.append(h)
            grams = gram_hashes(h, GRAM)
            at = np.arange(len(grams)) if len(h) <= ALL_GRAMS else winnowed(grams)
            keys.append(grams[at])
            template.append(np.full(len(at), t))
            place.append(at)
        order = np.argsort(np.concatenate(keys), kind="stable")
        self.keys, self.template, self.place = np.concatenate(keys)[order], np.concatenate(template)[order], np.concatenate(place)[order]

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the text, template, place in the template) of all fingerprints met."""
        lo, hi = np.searchsorted(self.keys, grams, "left"), np.searchsorted(self.keys, grams, "right")
        at = np.flatnonzero(hi > lo)
        n = hi[at] - lo[at]
        row = np.repeat(lo[at], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(at, n), self.template[row], self.place[row]


def extend(template: np.ndarray, text: np.ndarray, band: int = BAND) -> tuple[int, np.ndarray]:
    """The best alignment that begins where both do and may end anywhere: its score, and of each template word the matched word of the text or -1."""
    n = len(template)
    met = np.full(n, -1, dtype=np.int64)
    text = text[: n + band]
    if not n or not len(text):
        return 0, met
    if len(text) >= n and np.array_equal(template, text[:n]):
        return n, np.arange(n)
    at = np.arange(2 * band + 1)
    low = -4 * (n + band)
    score = np.full((n + 1, 2 * band + 3), low)  # row: template words used; column: text words used less these, plus band + 1
    score[0, 1:-1] = np.where((at >= band) & (at - band <= len(text)), band - at, low)
    best = (0, 0, band + 1)
    for i in range(1, n + 1):
        j = i + at - band  # text words used
        same = (j >= 1) & (j <= len(text)) & (text[np.clip(j - 1, 0, len(text) - 1)] == template[i - 1])
        value = np.maximum(score[i - 1, 1:-1] + np.where(same, 1, -1), score[i - 1, 2:] - 1)
        value = np.where((j >= 0) & (j <= len(text)), value, low)
        value = np.maximum.accumulate(value + at) - at
        score[i, 1:-1] = np.where(j <= len(text), value, low)
        d = int(value.argmax())
        if value[d] >= best[0]:  # of equal scores the longer one, which has more words matched
            best = (int(value[d]), i, d + 1)
        if value[d] + n - i < best[0]:
            break
    total, i, d = best
    while i > 0:
        j = i + d - 1 - band
        same = 1 <= j <= len(text) and text[j - 1] == template[i - 1]
        if score[i, d] == score[i - 1, d] + (1 if same else -1):
            if same:
                met[i - 1] = j - 1
            i -= 1
        elif score[i, d] == score[i - 1, d + 1] - 1:
            i, d = i - 1, d + 1
        else:
            d -= 1
    return total, met


def _right(words: np.ndarray, h: np.ndarray, place: int, own: int, hi: int) -> tuple[int, np.ndarray]:
    """From a hit on: the score, and of each template word its word of the text or -1 (none before the hit)."""
    met = np.full(len(words), -1, dtype=np.int64)
    score, after = extend(words[own + GRAM :], h[place + GRAM : hi])
    met[own : own + GRAM] = np.arange(place, place + GRAM)
    met[own + GRAM :] = np.where(after < 0, -1, after + place + GRAM)
    return score, met


def _left(words: np.ndarray, h: np.ndarray, place: int, own: int, lo: int) -> tuple[int, np.ndarray]:
    """Back from a hit; like `_right`."""
    met = np.full(len(words), -1, dtype=np.int64)
    score, before = extend(words[:own][::-1], h[lo:place][::-1])
    met[:own] = np.where(before < 0, -1, place - 1 - before)[::-1]
    met[own : own + GRAM] = np.arange(place, place + GRAM)
    return score, met


def _on(met: np.ndarray, place: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which hits an alignment passes."""
    return np.all([met[own + k] == place + k for k in range(GRAM)], axis=0)


def candidates(words: np.ndarray, h: np.ndarray, place: np.ndarray, own: np.ndarray, lo: int, hi: int, least: float):
    """(matched words, score, first word, last word + 1, hits) of the best alignment inside [lo, hi) through each hit of one
    template (ascending by place) that match `least` words; hits on one and the same best alignment give it once."""
    done = np.zeros(len(place), dtype=bool)
    for x in range(len(place)):
        if done[x]:
            continue
        p, o = int(place[x]), int(own[x])
        near = h[max(lo, p - o - BAND) : min(hi, p - o + len(words) + BAND)]
        if np.isin(words, near).sum() < least:
            done[x] = True
            continue
        after, met = _right(words, h, p, o, hi)
        stop = x + int(np.searchsorted(place[x:], met.max(), "right"))
        z = x + int(np.flatnonzero(_on(met, place[x:stop], own[x:stop]))[-1])
        before, back = _left(words, h, int(place[z]), int(own[z]), lo)
        if _on(back, place[x : x + 1], own[x : x + 1])[0]:
            # The best way on from the first hit and the best way back from the last share all between: best for each of them.
            score = before + GRAM + extend(words[own[z] + GRAM :], h[place[z] + GRAM : hi])[0] if z > x else before + GRAM + after
            met[: own[z]] = back[: own[z]]
            own_hits = x + np.flatnonzero(_on(met, place[x:stop], own[x:stop]))
        else:
            before, back = _left(words, h, p, o, lo)
            score = before + GRAM + after
            met[:o] = back[:o]
            own_hits = np.array([x])
        done[own_hits] = True
        held = met[met >= 0]
        if len(held) >= least:
            yield len(held), score, int(held[0]), int(held[-1]) + 1, own_hits


def matches(index: Index, h: np.ndarray, min_coverage: float = MIN_COVERAGE) -> list[tuple[int, int, int, int]]:
    """(template, first word, last word + 1, matched words) of a text's accepted candidates, by place."""
    place, template, own = index.hits(gram_hashes(h, GRAM))
    order = np.lexsort((own, place, template))
    place, template, own = place[order], template[order], own[order]
    heap: list[tuple] = []
    starts: list[int] = []
    ends: list[int] = []

    def push(t: int, hits: np.ndarray) -> None:
        """The candidates of one template's hits in the words that no accepted span holds."""
        at = np.array([bisect.bisect_right(ends, p) for p in place[hits].tolist()], dtype=np.int64)
        free = np.array([g == len(starts) or p + GRAM <= starts[g] for g, p in zip(at.tolist(), place[hits].tolist())], dtype=bool)
        hits, at = hits[free], at[free]
        for gap in np.unique(at):
            inside = hits[at == gap]
            lo, hi = ends[gap - 1] if gap else 0, starts[gap] if gap < len(starts) else len(h)
            for matched, score, first, last, members in candidates(index.words[t], h, place[inside], own[inside], lo, hi, min_coverage * len(index.words[t])):
                heapq.heappush(heap, (-matched, -score, t, first, last, tuple(inside[members])))

    for t in np.unique(template):
        push(int(t), np.flatnonzero(template == t))
    taken: list[tuple[int, int, int, int]] = []
    while heap:
        minus, _, t, first, last, members = heapq.heappop(heap)
        k = bisect.bisect_right(ends, first)
        if k < len(starts) and starts[k] < last:
            push(t, np.array(members))  # what is left of it beside the accepted spans
            continue
        starts.insert(k, first)
        ends.insert(k, last)
        taken.append((t, first, last, -minus))
    return sorted(taken, key=lambda x: (x[1], x[0]))


def scan_licenses(docs: DataFrame, keep: list[str], templates: dict[str, str] = TEMPLATES, name: str = "licenses", min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """`keep` of `docs` and the notices found: (license, start, end, coverage), places in code points, end exclusive."""
    sent = docs.sparkSession.sparkContext.broadcast(Index(templates))

    def run(part: Slice) -> list[pa.Array]:
        index = sent.value
        starts, ends, first, h = word_hashes(part)
        rows: list[list[dict]] = [[] for _ in range(len(part))]
        grams = gram_hashes(h, GRAM)
        # Grams over two texts' border may hit by chance; the text's own are looked up again below.
        met = np.flatnonzero(np.isin(grams, index.keys))
        for i in np.unique(np.searchsorted(first, met, "right") - 1):
            a, b = int(first[i]), int(first[i + 1])
            own = part.data[part.off[i] : part.off[i + 1]]
            point = np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)])
            for t, lo, hi, matched in matches(index, h[a:b], min_coverage):
                rows[i].append({
                    "license": index.names[t], "start": int(point[starts[a + lo] - part.off[i]]), "end": int(point[ends[a + hi - 1] - part.off[i]]),
                    "coverage": matched / len(index.words[t])})
        return [pa.array(rows, pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())])))]

    schema = T._parse_datatype_string("array<struct<license:string,start:long,end:long,coverage:double>>")
    return annotate(docs, keep, T.StructType([T.StructField(name, schema)]), run)
