"""License notices in texts by conditional compression, confirmed by wording.

Of each template as many rare (long) words are anchors as a match could miss and one more, so every match holds one of
them; texts without an anchor are passed over. The words around anchors, as far as the longest match reaches, are cut
into overlapping blocks. Each block is compressed with every template as a raw zstandard dictionary, unless it lacks too
many of the template's words for any match, and the templates are ranked by the share of bytes they save. In that order
they are laid on the block: template and words are aligned with the fewest words missing, changed or interrupted by
others (Levenshtein distance over words), and a notice is confirmed if these are at most `DIFFERENT` of the template's
words. Every confirmed notice is reported, at the line where it begins, whatever its rank. Of templates that cover the
same words the one with more of them in place wins; of equal ones the one that ranks first.

Texts never leave their task and nothing is shuffled; a very long text is handled alone, its blocks one after another.
Defined results: null and empty texts carry no notice; a row that repeats another reports its own; a notice that occurs
twice in a text is reported twice, also within a line; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textspark.llm.storage import by_slices, kept

DIFFERENT = 0.1
LEVEL = 19

# Wordings of notices by identifier.
TEMPLATES = {
    "All-Rights-Reserved": "All rights reserved.",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-line": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0-line": "Licensed under CC BY 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-SA-4.0-line": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0-line": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT-line": "Released under the MIT License.",
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")


def words_of(text: str) -> list[str]:
    """Letters and digits, lower case; marks count only inside a word."""
    return _WORD.findall(text.lower())


def anchors(words: list[str]) -> set[str]:
    """Words of a template that a match with at most `DIFFERENT` of its words missing cannot all lack, the longest ones."""
    counts, found, held = Counter(words), set(), 0
    for word in sorted(counts, key=lambda w: (-len(w), w)):
        if held > int(DIFFERENT * len(words)):
            break
        found.add(word)
        held += counts[word]
    return found


def places(marked: list[int], size: int, reach: int) -> Iterator[tuple[int, int]]:
    """(first, end) of the words, of `size` in all, within `reach` of a marked one."""
    start = end = None
    for i in marked:
        if end is not None and i - reach > end:
            yield start, min(end, size)
            start = None
        if start is None:
            start = max(0, i - reach)
        end = i + reach + 1
    if start is not None:
        yield start, min(end, size)


def blocks(first: int, end: int, reach: int) -> Iterator[tuple[int, int]]:
    """Cuts a place into blocks so that any `reach` words of it lie whole in one."""
    for start in range(first, max(end - reach, first + 1), 3 * reach):
        yield start, min(start + 4 * reach, end)


def distances(template: list[str], words: list[str], anchored: bool) -> Iterator[int]:
    """After each word, the Levenshtein distance of the template to the best run that ends there; with `anchored`, to all words so far.

    Columns of the distance matrix are held as bits of differences (Myers 1999).
    """
    size = len(template)
    every, last = (1 << size) - 1, 1 << (size - 1)
    at: dict[str, int] = {}
    for i, word in enumerate(template):
        at[word] = at.get(word, 0) | 1 << i
    plus, minus, distance = every, 0, size
    for word in words:
        same = at.get(word, 0)
        down = same | minus
        across = (((same & plus) + plus) ^ plus) | same
        more = (minus | ~(across | plus)) & every
        less = plus & across
        if more & last:
            distance += 1
        elif less & last:
            distance -= 1
        more = (more << 1 | anchored) & every
        less = less << 1 & every
        plus = (less | ~(down | more)) & every
        minus = more & down
        yield distance


def differing(template: list[str], words: list[str]) -> list[str]:
    """The template's words that are missing and the others that are there instead, by a cheapest alignment."""
    rows = [list(range(len(words) + 1))]
    for i, word in enumerate(template, 1):
        row = [i]
        for j, other in enumerate(words, 1):
            row.append(min(rows[-1][j - 1] + (word != other), rows[-1][j] + 1, row[-1] + 1))
        rows.append(row)
    i, j, out, gone, came = len(template), len(words), [], [], []
    while i or j:
        if i and j and rows[i][j] == rows[i - 1][j - 1] + (template[i - 1] != words[j - 1]):
            i, j = i - 1, j - 1
            if template[i] == words[j]:
                out, gone, came = gone + came + out, [], []
            else:
                gone, came = [f"-{template[i]}", *gone], [f"+{words[j]}", *came]
        elif i and rows[i][j] == rows[i - 1][j] + 1:
            i -= 1
            gone = [f"-{template[i]}", *gone]
        else:
            j -= 1
            came = [f"+{words[j]}", *came]
    return gone + came + out


def laid_on(template: list[str], words: list[str], most: int) -> list[tuple[int, int, int]]:
    """(first word, end, words that differ) of every match with at most `most` differences, the closest first; matches do not overlap."""
    ends = sorted((n, e) for e, n in enumerate(distances(template, words, False), 1) if n <= most)
    found: list[tuple[int, int, int]] = []
    for n, end in ends:
        if any(low < end <= high for low, high, _ in found):
            continue
        back = words[max(0, end - len(template) - n) : end][::-1]
        length = next(k for k, d in enumerate(distances(template[::-1], back, True), 1) if d == n)
        if not any(low < end and end - length < high for low, high, _ in found):
            found.append((end - length, end, n))
    return found


class _Scanner:
    def __init__(self, templates: dict[str, str]):
        self.words = {name: words for name in sorted(templates) if (words := words_of(templates[name]))}
        self.counts = {name: Counter(words) for name, words in self.words.items()}
        self.most = {name: int(DIFFERENT * len(words)) for name, words in self.words.items()}
        self.reach = max((len(words) + self.most[name] for name, words in self.words.items()), default=0)
        self.anchors = frozenset().union(*(anchors(words) for words in self.words.values()))
        self.alone = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.given = {}
        for name, words in self.words.items():
            # A raw dictionary needs eight bytes.
            raw = zstandard.ZstdCompressionDict(" ".join(words).encode().ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.given[name] = zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False, write_dict_id=False)

    def ranked(self, block: list[str]) -> list[tuple[str, float]]:
        """Templates whose words the block has enough of for a match, with the share of its bytes each saves, most first."""
        there = Counter(block)
        names = [
            name for name, counts in self.counts.items()
            if sum(min(n, there[w]) for w, n in counts.items()) >= len(self.words[name]) - self.most[name]
        ]
        if not names:
            return []
        raw = " ".join(block).encode("utf-8", "replace")
        size = len(self.alone.compress(raw))
        return sorted(((name, 1 - len(self.given[name].compress(raw)) / size) for name in names), key=lambda x: (-x[1], x[0]))

    def confirmed(self, words: list[str], first: int, end: int) -> list[tuple[int, int, int, int, float, str]]:
        """(first word, end, words that differ, rank, saved, template) of the matches in a place, in rank order by block."""
        found: list[tuple[int, int, int, int, float, str]] = []
        for start, stop in blocks(first, end, self.reach):
            block = words[start:stop]
            for rank, (name, saved) in enumerate(self.ranked(block), 1):
                for low, high, n in laid_on(self.words[name], block, self.most[name]):
                    found.append((low + start, high + start, n, rank, saved, name))
        # Blocks overlap: of a template's matches that share words the closest stays, of equal ones the first.
        best: list[tuple[int, int, int, int, float, str]] = []
        taken: dict[str, list[tuple[int, int]]] = {}
        for match in sorted(found, key=lambda x: (x[2], x[0], x[3])):
            spans = taken.setdefault(match[5], [])
            at = bisect.bisect(spans, match[:2])
            if (at == 0 or spans[at - 1][1] <= match[0]) and (at == len(spans) or spans[at][0] >= match[1]):
                spans.insert(at, match[:2])
                best.append(match)
        return sorted(best)

    def scan(self, text: str) -> Iterator[tuple[int, str, int, float, int, int, str]]:
        lowered = text.lower()
        if not any(anchor in lowered for anchor in self.anchors):
            return
        words, line_of = [], []
        for i, line in enumerate(text.split("\n")):
            own = words_of(line)
            words += own
            line_of += [i] * len(own)
        marked = [i for i, word in enumerate(words) if word in self.anchors]
        for first, end in places(marked, len(words), self.reach):
            found = self.confirmed(words, first, end)
            lows = [match[0] for match in found]
            for low, high, n, rank, saved, name in sorted(found, key=lambda x: (line_of[x[0]], x[5], x[0])):
                # Dropped if another template covers the same words and more, or the same with fewer differences, or ranks first.
                near = found[bisect.bisect_left(lows, high - self.reach) : bisect.bisect_right(lows, low)]
                if not any(
                    o != name and h >= high and (h - l - m, -m, -r, s, name) > (high - low - n, -n, -rank, saved, o) for l, h, m, r, s, o in near
                ):
                    differences = " ".join(differing(self.words[name], words[low:high])) if n else ""
                    yield line_of[low] + 1, name, rank, saved, len(self.words[name]), n, differences


def notices(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, line, license, rank, saved, n_words, n_different, differences) of every confirmed notice.

    `rank` is the template's among those its block was compressed with, by `saved`, the share of the block's bytes.
    """
    templates = TEMPLATES if templates is None else dict(templates)
    kinds = (pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.string())
    names = ["doc_id", "line", "license", "rank", "saved", "n_words", "n_different", "differences"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _Scanner(templates)

        def found(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows += [(doc, *match) for match in scanner.scan(text.as_py() or "")]
            return pa.record_batch([pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)], names) if rows else None

        yield from by_slices(found)(batches)

    named = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, line int, license string, rank int, saved double, n_words int, n_different int, differences string"
    return kept(named.mapInArrow(run, schema), "notices")
