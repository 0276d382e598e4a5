"""License scan: winnowed template fingerprints in an inverted index, then banded alignment of the candidates.

Templates are the notices below and the whole license texts in ``license_texts/``, named ``<license>-text``.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame

from voltmart.llm.common import WORD_BYTES, encoded, id_text, map_batches, pieces, ragged

GRAM, WINDOW, BAND = 3, 4, 8
#: Templates of at most this many words are indexed by all their pairs of words, as few of their longer grams survive an edit.
SHORT = 12
#: Diagonals that are aligned together, and template words for each of which a candidate needs a hit there.
WIDTH, SPARSE = 64, 20
#: Least share of a template's words that must be aligned.
COVERAGE = 0.8
#: Words of all templates together; the index goes to every task and must stay small.
INDEX_WORDS = 500_000

#: Notices as their licenses prescribe them.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
        and this permission notice shall be included in all copies or substantial portions of the Software.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
        an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any
        later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
        the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to
        endorse or promote products derived from this software without specific prior written permission.""",
    "GPL-2.0-only": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU
        General Public License version 2 as published by the Free Software Foundation. This program is distributed in the
        hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or
        FITNESS FOR A PARTICULAR PURPOSE.""",
    "GPL-2.0": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any
        later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even
        the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "LGPL-2.1": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser
        General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your
        option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
        without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "LGPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
        without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "AGPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
        without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
        was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "EPL-2.0": """This program and the accompanying materials are made available under the terms of the Eclipse Public License
        2.0 which is available at https://www.eclipse.org/legal/epl-2.0/""",
    "BSL-1.0": """Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at
        http://www.boost.org/LICENSE_1_0.txt)""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this software
        for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the
        following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote
        the original software.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE""",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-ND-4.0-notice": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-NC-SA-4.0": """This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International
        License.""",
    "CC0-1.0-notice": """To the extent possible under law, the author has waived all copyright and related or neighboring rights
        to this work.""",
    "GPL-2.0-notice": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "BSD-3-Clause-notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
        publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means.""",
}


def templates() -> dict[str, str]:
    """The notices and the whole texts, by name."""
    folder = Path(__file__).with_name("license_texts")
    return TEMPLATES | {f"{f.stem}-text": f.read_text(encoding="utf-8") for f in sorted(folder.glob("*.txt"))}


def words_of(text: str | None) -> list[bytes]:
    return encoded(text).translate(WORD_BYTES).split()


def _ids(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words))


def _grams(ids: np.ndarray, gram: int) -> np.ndarray:
    n = len(ids) - gram + 1
    total = np.zeros(max(0, n), dtype=np.uint64)
    for k in range(gram if n > 0 else 0):
        total = (total ^ ids[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return total


class _Prints:
    """Fingerprint -> (template, word) lists as arrays."""

    def __init__(self, gram: int, places: dict[int, list[tuple[int, int]]]):
        self.gram, self.prints = gram, np.array(sorted(places), dtype=np.uint64)
        lists = [places[int(p)] for p in self.prints]
        self.sizes = np.array([len(p) for p in lists], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.places = np.array([p for one in lists for p in one], dtype=np.int64).reshape(-1, 2)

    def hits(self, ids: np.ndarray) -> np.ndarray:
        """Rows of (template, document word, diagonal: document word minus template word)."""
        grams = _grams(ids, self.gram)
        if not len(grams) or not len(self.prints):
            return np.zeros((0, 3), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.prints, grams), len(self.prints) - 1)
        word = np.flatnonzero(self.prints[at] == grams)
        at = at[word]
        found = self.places[ragged(self.starts[at], self.sizes[at])]
        word = np.repeat(word, self.sizes[at])
        return np.stack([found[:, 0], word, word - found[:, 1]], axis=1)


class Index:
    """Fingerprints of templates in an inverted index. Templates are winnowed; document grams are all looked up.

    Of each ``WINDOW`` consecutive grams of a template the smallest is indexed, so any ``WINDOW + GRAM - 1`` words shared with
    a document meet in it; of a template of up to ``SHORT`` words all pairs are. A template below ``GRAM`` words is an error.
    """

    def __init__(self, templates: dict[str, str]):
        self.names = sorted(templates)
        self.words = [_ids(words_of(templates[n])) for n in self.names]
        if any(len(w) < GRAM for w in self.words) or sum(map(len, self.words)) > INDEX_WORDS:
            raise ValueError(f"templates need {GRAM} words each and {INDEX_WORDS} in all at most")
        self.counts = [np.unique(w, return_counts=True) for w in self.words]
        pairs, grams_of = defaultdict(list), defaultdict(list)
        for t, ids in enumerate(self.words):
            if len(ids) <= SHORT:
                for i, g in enumerate(_grams(ids, 2).tolist()):
                    pairs[g].append((t, i))
                continue
            grams = _grams(ids, GRAM)
            windows = np.lib.stride_tricks.sliding_window_view(grams, min(WINDOW, len(grams)))
            for i in np.unique(np.arange(len(windows)) + windows.argmin(axis=1)).tolist():
                grams_of[int(grams[i])].append((t, i))
        self.prints = [_Prints(2, pairs), _Prints(GRAM, grams_of)]

    def matches(self, ids: np.ndarray, coverage: float) -> list[tuple[str, int, int, int, int, float]]:
        """(template, first word, end word, aligned words, template words, coverage) of the best match of each region.

        Of overlapping matches, whatever their templates, the one with the most aligned words stays, then the one with
        the greatest coverage, then the first.
        """
        hits = np.concatenate([p.hits(ids) for p in self.prints])
        hits = hits[np.lexsort((hits[:, 2], hits[:, 0]))]
        found = set()
        for part in np.split(hits, np.flatnonzero(np.diff(hits[:, 0])) + 1) if len(hits) else []:
            t = int(part[0, 0])
            if len(ids) >= coverage * len(self.words[t]):
                found.update((t, *m) for m in self._of_template(t, ids, part[:, 1:], coverage))
        ranked = sorted(found, key=lambda m: (-m[3], len(self.words[m[0]]), m[1], m[2], m[0]))
        starts, kept = [], []  # matches kept so far, in order; they do not overlap
        for m in ranked:
            k = bisect_left(starts, m[1])
            if (k == 0 or kept[k - 1][2] <= m[1]) and (k == len(kept) or m[2] <= kept[k][1]):
                starts.insert(k, m[1])
                kept.insert(k, m)
        return [(self.names[t], a, b, n, len(self.words[t]), n / len(self.words[t])) for t, a, b, n in kept]

    def _of_template(self, t: int, ids: np.ndarray, hits: np.ndarray, coverage: float) -> set[tuple[int, int, int]]:
        """(first word, end word, aligned words) of the matches of one template; ``hits`` are ordered by diagonal.

        In long templates, diagonals with many hits are tried on their own first; what they match needs no other. The
        other hits are searched in overlapping windows of ``WIDTH`` diagonals, so the work grows with their number, and
        a match may shift by half a window at least. A window needs a hit for each ``SPARSE`` words of its template.
        """
        size, found = len(self.words[t]), set()
        enough = max(1, size // SPARSE)
        if size > WIDTH:
            lanes, lane_hits = np.unique(hits[:, 1] // BAND, return_counts=True)
            order = np.argsort(-lane_hits, kind="stable")
            for lane in lanes[order][lane_hits[order] >= enough].tolist():
                if (hits[:, 1] // BAND == lane).sum() >= enough:
                    found |= self._search(t, ids, lane * BAND, lane * BAND + BAND - 1, coverage)
                    for a, b, _ in found:
                        hits = hits[(hits[:, 0] < a) | (hits[:, 0] >= b)]
        diagonals, low = hits[:, 1], None
        while len(diagonals):
            first = int(diagonals[0])
            low = first if low is None else max(first, low + WIDTH // 2)
            inside = diagonals[np.searchsorted(diagonals, low) : np.searchsorted(diagonals, low + WIDTH)]
            if len(inside) >= enough:
                found |= self._search(t, ids, low, int(inside[-1]), coverage)
            if low + WIDTH > diagonals[-1]:
                break
            diagonals = diagonals[np.searchsorted(diagonals, low + WIDTH // 2) :]
        return found

    def _search(self, t: int, ids: np.ndarray, low: int, high: int, coverage: float) -> set[tuple[int, int, int]]:
        template, found = self.words[t], set()
        need = math.ceil(coverage * len(template) - 1e-9)
        values, counts = self.counts[t]
        todo = [(max(0, low - BAND), min(len(ids), high + len(template) + BAND))]
        while todo:  # a window may hold several matches: what lies before and after the best one is searched again
            start, end = todo.pop()
            region = ids[start:end]
            if len(region) < need:
                continue
            at = np.minimum(np.searchsorted(values, region), len(values) - 1)
            shared = np.bincount(at[values[at] == region], minlength=len(values))
            if np.minimum(shared, counts).sum() < need:  # no alignment can match more words
                continue
            n, a, b = align(template, region, low - BAND - start, high + BAND - start)
            if n >= need:
                found.add((start + a, start + b, n))
                todo += [(start, start + a), (start + b, end)]
        return found


_SCORE, _WORD = 1 << 42, 1 << 24


def align(template: np.ndarray, region: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """Aligned words and span in ``region`` of the best local alignment with diagonals from ``low`` to ``high``.

    A match scores 2, a mismatch or gap -1; of equal scores the one with more aligned words, then the later start, then
    the earlier end. A cell is one integer of score, aligned words and start, so the greatest is the best; gaps in the
    template are a running maximum over a row.
    """
    m = len(region)
    previous, row, best, end = np.zeros(m + 2, np.int64), np.zeros(m + 2, np.int64), 0, 0
    columns = np.arange(m, dtype=np.int64)
    slope = columns * _SCORE
    for i in range(max(0, -high), min(len(template), m - low)):
        a, b = max(0, i + low), min(m, i + high + 1)
        diagonal = previous[a:b]
        same = region[a:b] == template[i]
        cell = np.where(same, np.where(diagonal < _SCORE, columns[a:b], diagonal) + 2 * _SCORE + _WORD, diagonal - _SCORE)
        np.maximum(cell, previous[a + 1 : b + 1] - _SCORE, out=cell)
        np.maximum(cell, 0, out=cell)
        cell += slope[a:b]
        np.maximum.accumulate(cell, out=cell)
        cell -= slope[a:b]
        cell[cell < _SCORE] = 0
        row[a + 1 : b + 1] = cell
        row[a] = row[b + 1] = 0
        k = int(cell.argmax())
        if cell[k] > best:
            best, end = int(cell[k]), a + k + 1
        previous, row = row, previous
    return best % _SCORE // _WORD, best % _WORD, end


def scan(
    docs: DataFrame, known: dict[str, str] | None = None, coverage: float = COVERAGE,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per match: doc_id, license, start_word, end_word, start_char, end_char, n_aligned, n_template, coverage.

    Words are lower-cased runs of letters and digits; character positions count code points of the text. A document may hold
    several matches; of overlapping matches the best stays, whatever the templates (see ``Index.matches``). Null, empty and
    unlicensed texts have no row, nor has an empty table; repeated rows repeat their matches. Texts of any length are
    searched whole, in time that grows with their words and matches.
    """
    sent = docs.sparkSession.sparkContext.broadcast(Index(templates() if known is None else known))

    def run(batches) -> Iterator[dict]:
        index = sent.value
        names = ("doc_id", "license", "start_word", "end_word", "start_char", "end_char", "n_aligned", "n_template", "coverage")
        for batch in pieces(batches):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                found = index.matches(_ids(words_of(text)), coverage)
                if found:
                    raw = encoded(text)
                    word = np.frombuffer(b" " + raw.translate(WORD_BYTES) + b" ", dtype=np.uint8) != 32
                    begins = np.flatnonzero(word[1:-1] & ~word[:-2])
                    ends = np.flatnonzero(word[1:-1] & ~word[2:]) + 1
                    points = np.concatenate(([0], np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)))
                    rows += [
                        (doc_id, name, a, b, int(points[begins[a]]), int(points[ends[b - 1]]), n, size, share)
                        for name, a, b, n, size, share in found
                    ]
            yield {k: [r[i] for r in rows] for i, k in enumerate(names)}

    return map_batches(
        id_text(docs, id_col, text_col), run,
        "doc_id long, license string, start_word long, end_word long, start_char long, end_char long, n_aligned long,"
        " n_template long, coverage double",
    )
