"""License scans: passages of texts compared with license templates by Dice coefficient.

Texts are normalised (lower case, every run of other characters than letters and digits one space)
and cut at line ends. A passage is one or more whole lines in a row. Passage and template are
compared as multisets of word bigrams (a single word counts as one):

    dice = 2 * common / (bigrams of passage + bigrams of template)

A match needs ``dice >= threshold``. Then the passage has between t/(2-t) and (2-t)/t times the
template's bigrams, which rules out most templates and passages by size alone; and a passage holds
at least t * template / 2 bigrams of the template, so texts without them are dropped unread. Of a
template's overlapping matches in a text the best stays (ties: the shorter, then the earlier), and
of overlapping matches of several templates the best is marked (further tie: the first template).

Null and empty texts match nothing. Repeated rows and rows with a null id are scanned each; extra
columns are ignored. Very long texts and lines are compared whole.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from rillstone.llm.common import read

THRESHOLD = 0.8

# Public license notices and headers, by SPDX identifier.
TEMPLATES: list[tuple[str, str]] = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions: The above copyright notice and this permission notice shall be included in all
        copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY
        KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
        PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR
        ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
        OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
        software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
        CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
        permissions and limitations under the License.""",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version. This program is distributed in the hope that it will be useful, but
        WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR
        PURPOSE. See the GNU General Public License for more details.""",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    (
        "BSD",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. Redistributions in binary form must
        reproduce the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution.""",
    ),
    (
        "ISC",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    ),
    (
        "MPL-2.0",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
        was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    ),
]

WORD = re.compile(r"[^\W_]+")


def words_of(line: str) -> list[str]:
    return WORD.findall(line.lower())


def bigrams(words: list[str]) -> list[tuple[str, ...]]:
    return list(zip(words, words[1:], strict=False)) if len(words) > 1 else [tuple(words)] * len(words)


@dataclass
class Template:
    license: str
    number: int
    counts: Counter
    size: int
    low: int  #: least and most bigrams of a passage that can match
    high: int


class Scanner:
    def __init__(self, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD):
        self.threshold, self.templates = threshold, []
        self.of_bigram: dict[tuple, list[int]] = defaultdict(list)
        for number, (name, text) in enumerate(templates):
            grams = bigrams(words_of(text))
            low, high = threshold / (2 - threshold) * len(grams), (2 - threshold) / threshold * len(grams)
            self.templates.append(Template(name, number, Counter(grams), len(grams), int(np.ceil(low - 1e-9)), int(high + 1e-9)))
            for gram in set(grams):
                self.of_bigram[gram].append(number)
        self.vocabulary = {w for gram in self.of_bigram for w in gram}

    def scan(self, text: str | None) -> list[tuple[str, int, int, int, int, float, bool]]:
        """(license, template, first line, last line, common bigrams, dice, best) of the matches."""
        if not text:
            return []
        words: list[str] = []
        line_of: list[int] = []  # line number of each line with words
        starts: list[int] = []  # its first word
        for number, line in enumerate(text.split("\n")):
            found = words_of(line)
            if found:
                line_of.append(number)
                starts.append(len(words))
                words += found
        if not words:
            return []
        starts.append(len(words))
        known = self.vocabulary
        hits: dict[int, list[int]] = defaultdict(list)
        if known.isdisjoint(words):
            return []
        for k in range(len(words) - 1):
            if words[k] in known and words[k + 1] in known:
                for t in self.of_bigram.get((words[k], words[k + 1]), ()):
                    hits[t].append(k)
        for a, b in zip(starts, starts[1:], strict=False):
            if b == a + 1:  # a passage of one word
                for t in self.of_bigram.get((words[a],), ()):
                    hits[t].append(a)
        matches = []
        for t, places in hits.items():
            template = self.templates[t]
            if len(places) * 2 >= self.threshold * template.size:
                matches += self._passages(template, words, starts, line_of, places)
        taken, marked = [], []
        for m in sorted(matches, key=lambda m: (-m[5], m[3] - m[2], m[2], m[1])):
            best = all(m[3] < a or m[2] > b for a, b in taken)
            if best:
                taken.append((m[2], m[3]))
            marked.append((*m, best))
        return sorted(marked, key=lambda m: (m[2], m[3], m[1]))

    def _passages(self, template: Template, words: list[str], starts: list[int], line_of: list[int], places: list[int]) -> list[tuple]:
        begins = np.array(starts)
        at = np.array(places)
        found = []
        lines = len(starts) - 1
        # Only a passage whose first line holds a bigram of the template, or crosses into one, can gain by it.
        first_lines = np.unique(np.searchsorted(begins, at, "right") - 1)
        for i in first_lines.tolist():
            a = starts[i]
            for j in range(i, lines):
                b = starts[j + 1]
                size = b - a - 1 if b - a > 1 else 1
                if size > template.high:
                    break
                if size < template.low:
                    continue
                inside = int(np.searchsorted(at, b - 1 if b - a > 1 else b) - np.searchsorted(at, a))
                if inside * 2 < self.threshold * (size + template.size):
                    continue
                common = sum((Counter(bigrams(words[a:b])) & template.counts).values())
                dice = 2 * common / (size + template.size)
                if dice >= self.threshold:
                    found.append((-dice, j - i, i, j, common))
        best, taken = [], []
        for less, _, i, j, common in sorted(found):
            if all(j < x or i > y for x, y in taken):
                taken.append((i, j))
                best.append((template.license, template.number, line_of[i], line_of[j], common, -less))
        return best


def scan_licenses(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """A row per match: id, license, template (its number), first_line, last_line (from 0), common, dice, best."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, threshold)
        for batch in batches:
            rows, found = [], []
            for k, text in enumerate(batch.column(1)):
                own = scanner.scan(text.as_py())
                rows += [k] * len(own)
                found += own
            columns = list(zip(*found, strict=True)) if found else [[]] * 7
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int32())), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["id", "license", "template", "first_line", "last_line", "common", "dice", "best"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(docs[id_column].alias("id"), docs[text_column].cast("string").alias("text"))
    found = rows.mapInArrow(scan, f"id {kind}, license string, template int, first_line int, last_line int, common int, dice double, best boolean")
    return found.withColumnRenamed("id", id_column)


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of every document that matches a license template."""
    return scan_licenses(read(spark, sf_dir, "documents"))
