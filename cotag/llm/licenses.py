"""Licence texts and notices found by the Dice coefficient of word bigrams.

Units of a text (its lines, its paragraphs and the whole) are normalised to lower-case words and
compared with licence templates by 2 |A n B| / (|A| + |B|) over their sets of word bigrams. For a
coefficient of d at least, a set can only match one whose size is within d / (2 - d) and
(2 - d) / d of its own; templates outside of these bounds are never looked at.

Windows of words, over line and paragraph ends, are compared in the same way, so a notice inside a
longer line or a header split by blank lines is found too. A template with n bigrams needs d n /
(2 - d) of them in a text; for the few that have them, the best window from each of the places where
a bigram of the template stands is taken.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cotag.llm.common import arrow_fields, small_batches, texts_of
from cotag.llm.license_texts import TEXTS

# The standard file header of the GNU licences: licence, name in the text, version.
_GNU_HEADER = (
    "This {thing} is free software{stop} you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation{stop2} either version {version} of the License, or (at your option) any later version. This {thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."
)
_GNU = (
    ("GPL-2.0", "program", "General Public License", "2"),
    ("LGPL-2.1", "library", "Lesser General Public License", "2.1"),
    ("LGPL-3.0", "library", "Lesser General Public License", "3"),
    ("AGPL-3.0", "program", "Affero General Public License", "3"),
)
# Identifiers that files name after "SPDX-License-Identifier:", and endings of theirs.
_SPDX = ("Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "ISC", "MIT", "MPL-2.0", "Unlicense")
_SPDX_GNU = ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")

# Notices and licence texts, by the identifier of their licence.
TEMPLATES = (
    *((licence, _GNU_HEADER.format(thing=thing, name=name, version=version, stop=";", stop2=";"))
      for licence, thing, name, version in _GNU),
    *((licence, f"licensed under the GNU {name}, version {version}.") for licence, _, name, version in _GNU),
    *((licence, f"SPDX-License-Identifier: {licence}") for licence in (*_SPDX, *_SPDX_GNU)),
    *((licence, f"SPDX-License-Identifier: {licence}-{end}") for licence in _SPDX_GNU for end in ("only", "or-later")),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    *TEXTS,
)

#: Least Dice coefficient of a find.
LEAST_DICE = 0.85

#: Templates of at most so many bigrams are notices; marks decide between those.
NOTICE = 400

FOUND = "doc_id long, license string, start long, end long, dice_ppm long"

_WORD = re.compile(r"[a-z0-9]+")
_LINE = re.compile(r"[^\n]+")


def bigrams(text: str) -> frozenset[tuple[str, str]]:
    """Distinct pairs of neighbouring normalised words."""
    words = _WORD.findall(text.lower())
    return frozenset(zip(words, words[1:], strict=False))


_VERSIONED = ("version", "v")
_GNU_FAMILIES = ("lesser", "affero", "library")
_CC_PARTS = ("by", "nc", "sa", "nd", "attribution", "noncommercial", "sharealike", "noderivatives")


def is_mark(pair: tuple[str, str]) -> bool:
    """Whether a bigram tells versions or families of licences apart: a version with its number, the
    family in front of "General", a part of a Creative Commons licence with the next one."""
    a, b = pair
    if a in _VERSIONED:
        return b[:1].isdigit()
    if b == "general":
        return a in _GNU_FAMILIES
    return a in _CC_PARTS and (b in _CC_PARTS or b[:1].isdigit())


class Templates:
    """Templates by size, with the licences whose templates hold a bigram."""

    def __init__(self, templates=TEMPLATES, least: float = LEAST_DICE):
        if not 0 < least <= 1:
            raise ValueError("the least coefficient must be above 0 and at most 1")
        self.least = least
        made = sorted(((len(b), name, b) for name, t in templates if (b := bigrams(t))),
                      key=lambda x: (x[0], x[1]))
        self.sizes = [size for size, _, _ in made]
        self.names = [name for _, name, _ in made]
        self.sets = [b for _, _, b in made]
        self.words = frozenset(w for b in self.sets for pair in b for w in pair)
        ratio = least / (2 - least)
        self.smallest = ratio * self.sizes[0] if made else 0
        self.largest = self.sizes[-1] / ratio if made else -1
        self._ratio = ratio
        self._marks = [frozenset(filter(is_mark, b)) for b in self.sets]
        self.holders: dict[tuple[str, str], list[int]] = {}
        for i, b in enumerate(self.sets):
            for pair in b:
                self.holders.setdefault(pair, []).append(i)
        self.needs = np.array([math.ceil(ratio * n - 1e-9) for n in self.sizes], np.int64)
        self._ids = {w: i for i, w in enumerate(sorted(self.words), 1)}
        self._base = len(self._ids) + 1
        coded = sorted((self._ids[a] * self._base + self._ids[b], (a, b)) for a, b in self.holders)
        self._pairs = np.array([c for c, _ in coded], np.int64)
        self._member = np.zeros((len(made), len(coded)), bool)
        for k, (_, pair) in enumerate(coded):
            self._member[self.holders[pair], k] = True
        #: Templates of other licences that a template shares so much with that one shows in the other.
        self.near = [
            {u for u, other in enumerate(self.sets)
             if self.names[u] != self.names[t]
             and len(b & other) >= min(self.needs[t], self.needs[u])}
            for t, b in enumerate(self.sets)
        ]

    def agrees(self, t: int, pairs: Iterable[tuple[str, str]]) -> bool:
        """Whether the marks of a text are those of a notice: it has no other ones, and if the notice
        has a version or a family, one of its own. A few words must not turn one licence into another.
        """
        if self.sizes[t] > NOTICE:
            return True
        own, theirs = self._marks[t], frozenset(filter(is_mark, pairs))
        versions = {p for p in own if p[0] in _VERSIONED}
        return theirs <= own and all(
            not kind or not kind.isdisjoint(theirs) for kind in (versions, own - versions)
        )

    def matches(self, unit: frozenset) -> dict[str, int]:
        """Best coefficient (parts per million) of each licence that reaches the least one."""
        size = len(unit)
        low = bisect.bisect_left(self.sizes, self._ratio * size - 1e-9)
        high = bisect.bisect_right(self.sizes, size / self._ratio + 1e-9)
        found: dict[str, int] = {}
        if low == high:
            return found
        shared = Counter(i for pair in unit for i in self.holders.get(pair, ()) if low <= i < high)
        for i, n in shared.items():
            if 2 * n >= self.least * (size + self.sizes[i]) - 1e-9 and self.agrees(i, unit):
                dice = 2_000_000 * n // (size + self.sizes[i])
                found[self.names[i]] = max(dice, found.get(self.names[i], 0))
        return found

    def _best_windows(self, t: int, codes: np.ndarray, own: np.ndarray, after: np.ndarray,
                      before: np.ndarray):
        """(shared bigrams, ppm, first, last bigram) of the best window from each place of ``t``.

        The best window starts and ends with bigrams of the template, and its first one occurs once,
        as less of it would be at least as good otherwise.
        """
        size, need = self.sizes[t], int(self.needs[t])
        most = math.floor(size / self._ratio + 1e-9)
        places = np.flatnonzero(own)
        upto = np.concatenate([[0], np.cumsum(own)])
        for i in places.tolist():
            limit, length = int(after[i]), most + 8
            while True:
                end = min(i + length, limit)
                fresh = before[i:end] < i
                sizes = np.cumsum(fresh)
                if end == limit or sizes[-1] > most:
                    break
                length *= 2
            end = i + int(np.searchsorted(sizes, most, "right"))
            if upto[end] - upto[i] < need:
                continue
            mine = own[i:end]
            shared = np.cumsum(fresh[: end - i] & mine)
            dice = 2 * shared / (sizes[: end - i] + size)
            dice[~mine] = 0
            j = len(dice) - 1 - int(dice[::-1].argmax())  # repeats of its bigrams belong to it
            n, both = int(shared[j]), int(sizes[j]) + size
            if 2 * n >= self.least * both - 1e-9:
                yield n, 2_000_000 * n // both, i, i + j

    def windows(self, words: list[str]) -> list[tuple[int, int, int, int]]:
        """(template, first, last word, ppm) of windows; those of one licence do not overlap.

        Of windows that do, the one with the most bigrams of its template stays, then the one
        with the best coefficient, then the first. A window of which more than half lies in one of
        a near template that stays goes too, as the text is that licence's.
        """
        if len(words) < 2 or not len(self._pairs):
            return []
        ids = np.fromiter((self._ids.get(w, 0) for w in words), np.int64, len(words))
        pairs = np.where((ids[:-1] > 0) & (ids[1:] > 0), ids[:-1] * self._base + ids[1:], -1)
        at = np.minimum(np.searchsorted(self._pairs, pairs), len(self._pairs) - 1)
        hit = self._pairs[at] == pairs
        present = np.unique(at[hit])
        able = np.flatnonzero(self._member[:, present].sum(axis=1) >= self.needs)
        if not len(able):
            return []
        numbers: dict[tuple[str, str], int] = {}
        codes = np.fromiter(
            (numbers.setdefault(p, len(numbers)) for p in zip(words, words[1:], strict=False)),
            np.int64, len(words) - 1,
        )
        # The place of the same bigram before and after each.
        order = np.argsort(codes, kind="stable")
        same = codes[order[1:]] == codes[order[:-1]]
        before, after = np.full(len(codes), -1), np.full(len(codes), len(codes))
        before[order[1:][same]] = order[:-1][same]
        after[order[:-1][same]] = order[1:][same]
        found = []
        for t in able.tolist():
            own = hit & self._member[t, at]
            found += [(-n, -ppm, i, j, t)
                      for n, ppm, i, j in self._best_windows(t, codes, own, after, before)]
        taken: dict[str, list[tuple[int, int]]] = {}
        kept = []
        for _, ppm, i, j, t in sorted(found):
            spans = taken.setdefault(self.names[t], [])
            k = bisect.bisect_left(spans, (i, i))  # spans do not overlap
            if (k and spans[k - 1][1] >= i) or (k < len(spans) and spans[k][0] <= j + 1):
                continue
            if any(u in self.near[t] and 2 * (min(j + 1, b) - max(i, a)) > j + 1 - i
                   for u, a, b, _ in kept):
                continue
            spans.insert(k, (i, j + 1))
            kept.append((t, i, j + 1, -ppm))
        return kept

    def scan(self, text: str):
        """(licence, start, end, ppm) of all finds, by start, then end.

        A window is a find of its own unless it lies in a find of its licence among the units.
        """
        units = list(self._units(text))
        low = text.lower()
        if len(low) == len(text):
            spans = [m.span() for m in _WORD.finditer(low)]
        else:
            letters = [letter.lower() for letter in text]
            low = "".join(letters)
            places = [place for place, letter in enumerate(letters) for _ in letter]
            spans = [m.span() for m in _WORD.finditer(low)]
        words = [low[a:b] for a, b in spans]
        windows = [
            w for w in self.windows(words)
            if self.agrees(w[0], zip(words[w[1] : w[2]], words[w[1] + 1 : w[2] + 1], strict=True))
        ]
        if not windows:
            return units
        if len(low) != len(text):
            spans = [(places[a], places[b - 1] + 1) for a, b in spans]
        out = set(units)
        for t, i, j, dice in windows:
            name, start, end = self.names[t], spans[i][0], spans[j][1]
            if not any(n == name and a <= start and end <= b for n, a, b, _ in units):
                out.add((name, start, end, dice))
        return sorted(out, key=lambda f: (f[1], f[2], f[0]))

    def _units(self, text: str):
        """(licence, start, end, ppm) of each unit's finds, units by start, then end."""
        units, first, last = set(), 0, -2
        for line in _LINE.finditer(text):
            start, end = line.span()
            if start != last + 1:  # after an empty line
                units.add((first, max(last, first)))
                first = start
            units.add((start, end))
            last = end
        units |= {(first, max(last, first)), (0, len(text))}
        low = text.lower()
        same = len(low) == len(text)  # else a unit is lower-cased by itself
        for start, end in sorted(units):
            unit = low[start:end] if same else text[start:end].lower()
            words = _WORD.findall(unit)
            # Without enough words of templates, or with too many words, nothing can match.
            if len(words) - 1 < self.smallest or self.words.isdisjoint(words):
                continue
            pairs = frozenset(zip(words, words[1:], strict=False))
            if self.smallest <= len(pairs) <= self.largest:
                for name, dice in sorted(self.matches(pairs).items()):
                    yield name, start, end, dice


@lru_cache(maxsize=4)
def _compiled(templates: tuple, least: float) -> Templates:
    return Templates(templates, least)


def scan_licenses(
    docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = LEAST_DICE
) -> DataFrame:
    """Licences in whole texts: (doc_id, license, start, end, dice_ppm).

    One row per unit of a row's text and licence whose best template reaches ``least``, and per
    window of words that does and lies in no such unit; start and end in code points. A
    window inside one that fits a near licence better is part of that licence's text. A paragraph of
    one line is that line. Missing and empty texts hold none,
    repeated rows give repeated finds, units of less than two words match nothing. Scanned where the
    texts are read, without a shuffle; other columns are not read. The templates are a parameter
    of fixed size.
    """
    names, types = zip(*arrow_fields(FOUND), strict=True)

    def run(batches):
        scan = _compiled(templates, least).scan
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            rows = [
                (doc_id, *find)
                for doc_id, text in zip(ids, texts_of(batch), strict=True)
                for find in scan(text)
            ]
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=list(names)
            )

    small_batches(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long"), "text").mapInArrow(run, FOUND)
