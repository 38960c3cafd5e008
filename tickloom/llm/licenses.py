"""License scans by patience alignment.

Words are lower-cased (A-Z) and stripped of marks at both ends. A template is looked for wherever a
window of ``STRETCH`` times its length holds enough of its words, which no passage that covers the
template can miss. Inside the window both word lists are aligned: words unique to both are anchors, the
longest increasing run of anchors stays, and the gaps between them are aligned in the same way; a gap
without anchors matches equal words at its two ends. Coverage is the share of the template's words that
are aligned; from ``COVERAGE`` on the passage is reported if the words that set the template apart (its name
and version) are aligned too. In templates of up to ``SHORT`` words those are all but the ``FRAME``, and words
may be replaced or missing but none inserted. Where passages of several templates overlap, the one with most
aligned words stays (then the one with most coverage, then the first name).

Defined cases: null and empty texts have no passage; each passage of a text is reported; repeated rows
are reported each; other columns are not used.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.text import as_strings, lowered_words

COVERAGE = 0.8
STRETCH = 1.5
SHORT = 20
#: Words of short templates that do not tell one license from another.
FRAME = frozenset("a an the this work is licensed released under license version".split())
#: Words of notices that do, beside version numbers.
TELLING = frozenset(["lesser", "affero"])
VERSION = re.compile(r"\d+(\.\d+)*")
MARKS = ".,;:!?()[]{}<>\"'*#/-"

_GPL_NOTICE = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
    "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
    "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
    "PURPOSE. See the GNU General Public License for more details.")

# Public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "MIT": "Released under the MIT License",
    "MIT-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."),
    "ISC-notice": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "BSD-notice": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "MPL-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0",
    "Apache-1.1": "Licensed under the Apache License, Version 1.1",
    "BSD": "Released under the BSD License",
    "ISC": "Released under the ISC License",
    "MPL-2.0": "Licensed under the Mozilla Public License, Version 2.0",
    "GPL-3.0-notice": _GPL_NOTICE,
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-2.0-notice": _GPL_NOTICE.replace("version 3", "version 2"),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "LGPL-3.0-notice": _GPL_NOTICE.replace("GNU General", "GNU Lesser General"),
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1",
    "LGPL-2.1-notice": (_GPL_NOTICE.replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1")
                        .replace("This program", "This library")),
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3",
    "AGPL-3.0-notice": _GPL_NOTICE.replace("GNU General", "GNU Affero General"),
}


def plain(words: list[str]) -> list[str]:
    return [w.strip(MARKS) or w for w in words]


def template_words(text: str) -> list[str]:
    return plain([w.decode() for w in text.encode().lower().split()])


def _longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of ``pairs`` (sorted by the first) whose second members increase."""
    tails: list[int] = []
    tops: list[int] = []
    back = [-1] * len(pairs)
    for at, (_, y) in enumerate(pairs):
        pile = bisect_left(tails, y)
        back[at] = tops[pile - 1] if pile else -1
        if pile == len(tails):
            tails.append(y)
            tops.append(at)
        else:
            tails[pile], tops[pile] = y, at
    out, at = [], tops[-1] if tops else -1
    while at >= 0:
        out.append(pairs[at])
        at = back[at]
    return out[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Aligned positions (in the text, in the template), both increasing."""
    aligned: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            aligned.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            aligned.append((b, d))
        if a == b or c == d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        place = {text[i]: i for i in range(a, b)}
        pairs = sorted((place[w], j) for j in range(c, d)
                       if here[w := template[j]] == 1 and there[w] == 1)
        anchors = _longest_increasing(pairs)
        aligned += anchors
        if anchors:
            edges = [(a - 1, c - 1), *anchors, (b, d)]
            gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
    return sorted(aligned)


def telling(template: list[str]) -> set[int]:
    """Positions of the words that set a template apart: without them a passage is not its license."""
    if len(template) <= SHORT:
        return {j for j, w in enumerate(template) if w not in FRAME}
    return {j for j, w in enumerate(template) if w in TELLING or VERSION.fullmatch(w)}


def unbroken(aligned: list[tuple[int, int]]) -> Iterator[list[tuple[int, int]]]:
    """The longest runs of ``aligned`` inside which the text has no more words than the template."""
    begin = 0
    for at in range(1, len(aligned) + 1):
        if at == len(aligned) or aligned[at][0] - aligned[at - 1][0] > aligned[at][1] - aligned[at - 1][1]:
            if begin < at:
                yield aligned[begin:at]
            begin = at


def passages(text: list[str], template: list[str], starts: np.ndarray, coverage: float = COVERAGE):
    """(first word, one past the last, coverage) of each passage; ``starts``: windows worth looking at.

    Those of a short template can overlap.
    """
    width = int(np.ceil(len(template) * STRETCH))
    short, needed = len(template) <= SHORT, telling(template)
    after = 0
    for start in starts.tolist():
        if start < after:
            continue
        aligned = align(text[start:start + width], template)
        for run in unbroken(aligned) if short else [aligned]:
            share = len(run) / len(template)
            if share >= coverage and needed <= {j for _, j in run}:
                past = start + run[-1][0] + 1
                after = after if short else past
                yield start + run[0][0], past, share


def best_of(found: list[tuple]) -> list[tuple]:
    """Of (document, name, first, past, coverage, words) those that no better one overlaps."""
    taken: dict[int, list[tuple]] = {}
    for row in sorted(found, key=lambda r: (r[0], -r[5], -r[4], r[1], r[2])):
        own = taken.setdefault(row[0], [])
        if all(row[3] <= other[2] or other[3] <= row[2] for other in own):
            own.append(row)
    return [row for own in taken.values() for row in sorted(own, key=lambda r: r[2])]


def _scan(templates: dict[str, str], coverage: float):
    wanted = {name: template_words(text) for name, text in templates.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, words, starts = lowered_words(as_strings(batch["text"]))
            stripped = plain(words.to_pylist())
            rows = []
            ends = np.repeat(starts[1:], np.diff(starts))
            for name, template in wanted.items():
                own = set(template)
                holds = np.fromiter((w in own for w in stripped), bool, len(stripped))
                if not holds.any():
                    continue
                hits = np.concatenate([[0], np.cumsum(holds[codes])])
                width, least = int(np.ceil(len(template) * STRETCH)), int(np.ceil(coverage * len(template)))
                last = np.minimum(np.arange(len(codes)) + width, ends)
                rich = np.flatnonzero((hits[last] - hits[:-1] >= least) & holds[codes])
                doc_of = np.searchsorted(starts, rich, side="right") - 1
                for doc in np.unique(doc_of):
                    begin, end = int(starts[doc]), int(starts[doc + 1])
                    text = [stripped[c] for c in codes[begin:end]]
                    for first, past, share in passages(text, template, rich[doc_of == doc] - begin, coverage):
                        rows.append((int(doc), name, first, past, share, round(share * len(template))))
            rows = best_of(rows)
            doc, name, first, past, share, _ = zip(*rows) if rows else ([],) * 6
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(doc, pa.int64())), pa.array(name, pa.string()),
                 pa.array(first, pa.int64()), pa.array(past, pa.int64()), pa.array(share, pa.float64())],
                names=["doc_id", "license", "start_word", "end_word", "coverage"])
    return run


def scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """One row per passage: doc_id, license, start_word, end_word, coverage. Nothing is shuffled."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _scan(templates, coverage),
        f"doc_id {kind}, license string, start_word long, end_word long, coverage double")
