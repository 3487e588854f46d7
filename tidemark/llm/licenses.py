"""License scans: stretches of a text against licence templates by Dice's coefficient over word bigrams.

Passages are the lines, the paragraphs (between empty lines) and the whole of a text; windows are all runs of its words,
wherever they begin or end. In normal form every one of them is a range of the text's words. Sizes bound the
coefficient: with threshold t a template of b bigrams can't match a range of a bigrams unless
b * t / (2 - t) <= a <= b * (2 - t) / t, and a range scores higher without bigrams at its ends that the template lacks. So
the best windows begin and end with bigrams of the template, and a text with too few of them in any admissible size
is left after one pass over its words.
"""

from __future__ import annotations

import functools
import heapq
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from importlib import resources
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

THRESHOLD = 0.8
#: ASCII letters in small, digits and line feeds stay; all other bytes, those of other letters too, become spaces.
_PLAIN = bytes(c if chr(c) in "abcdefghijklmnopqrstuvwxyz0123456789\n" else 32 for c in bytes(range(256)).lower())

# The templates of the query's SQL. The short forms of Apache-2.0, CC-BY-NC-4.0, GPL-3.0 and MIT are the wordings
# of the test tables, the others their publishers'.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License.",
    "MIT notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."
    ),
}


_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. "
)
_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)


def _gnu(kind: str, version: str) -> str:
    what = "library" if kind == "Lesser " and version.startswith("2") else "program"
    return (
        f"This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General "
        f"Public License as published by the Free Software Foundation, either version {version} of the License, or (at your "
        "option) any later version."
    )


#: Those of the SQL, further notices and the full texts of short licences.
NOTICES = TEMPLATES | {
    "AGPL-3.0 notice": _gnu("Affero ", "3"),
    "BSD-2-Clause": _CONDITIONS + _DISCLAIMER,
    "BSD-3-Clause": (
        _CONDITIONS + "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission. " + _DISCLAIMER
    ),
    "CC-BY-NC-4.0 notice": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."
    ),
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "has waived all copyright and related or neighboring rights to this work",
    "GPL-2.0 notice": _gnu("", "2"),
    "ISC text": (
        TEMPLATES["ISC"] + ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS '
        "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
        "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
        "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "LGPL-2.1 notice": _gnu("Lesser ", "2.1"),
    "LGPL-3.0 notice": _gnu("Lesser ", "3"),
    "MIT text": (
        TEMPLATES["MIT notice"] + ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means."
    ),
}


@functools.cache
def published() -> dict[str, str]:
    """The templates of a scan: ``NOTICES`` and the full texts in the folder ``texts``, read on the driver."""
    files = sorted((resources.files("tidemark.llm") / "texts").iterdir(), key=lambda f: f.name)
    return NOTICES | {f.name.removesuffix(".txt") + " text": f.read_text("utf-8") for f in files if f.name.endswith(".txt")}


def template_bigrams(templates: dict[str, str] = TEMPLATES) -> dict[str, list[str]]:
    """The bigrams of each template, by the same normal form and numbering as those of passages."""
    out = {}
    for name, text in templates.items():
        words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
        pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
        out[name] = [f"{p} {pairs[:i].count(p)}" for i, p in enumerate(pairs)]
    return out


def size_bounds(n: int, threshold: float) -> tuple[int, int]:
    """Least and largest number of bigrams of a passage that n bigrams can match."""
    return ceil(n * threshold / (2 - threshold) - 1e-9), floor(n * (2 - threshold) / threshold + 1e-9)


def anchors(templates: dict[str, str], threshold: float) -> list[str]:
    """Words of which a passage has one at least if it reaches the threshold with some template.

    Such a passage holds n * t / (2 - t) of a template's n bigrams or more. So if the words chosen occur in
    more bigrams than may be missing, one of them is in the passage. The longest words come first.
    """
    chosen: set[str] = set()
    for text in templates.values():
        words = text.encode().translate(_PLAIN).decode().split()
        pairs = list(zip(words, words[1:]))
        may_miss = len(pairs) - size_bounds(len(pairs), threshold)[0]
        holders = defaultdict(set)
        for i, pair in enumerate(pairs):
            for word in pair:
                holders[word].add(i)
        covered = set().union(*[holders[w] for w in chosen if w in holders])
        for word in sorted(holders, key=lambda w: (-len(w), w)):
            if len(covered) > may_miss:
                break
            chosen.add(word)
            covered |= holders[word]
    return sorted(chosen)


class Scanner:
    """Finds templates in one text at a time."""

    def __init__(self, templates: dict[str, str], threshold: float):
        self.threshold = threshold
        self.anchors = {w.encode() for w in anchors(templates, threshold)}
        words = {name: text.encode().translate(_PLAIN).split() for name, text in templates.items()}
        #: how often each template holds each bigram
        self.pairs = {name: Counter(zip(w, w[1:])) for name, w in words.items() if len(w) > 1}
        self.holders: dict[tuple[bytes, bytes], list[str]] = defaultdict(list)
        for name, pairs in self.pairs.items():
            for pair in pairs:
                self.holders[pair].append(name)
        self.size = {name: sum(pairs.values()) for name, pairs in self.pairs.items()}
        self.bounds = {name: size_bounds(n, threshold) for name, n in self.size.items()}
        #: templates by those that occur in their wording
        self.within: dict[str, set[str]] = defaultdict(set)
        for longer, n in self.size.items():
            for name, places in self._places(words[longer]).items():
                if self.size[name] < n and self._windows(name, places):
                    self.within[name].add(longer)

    def _places(self, words: list[bytes]) -> dict[str, list[tuple[int, tuple[bytes, bytes]]]]:
        """For each template its bigrams in the text, with their positions."""
        found, holders = defaultdict(list), self.holders
        for at, pair in enumerate(zip(words, words[1:])):
            if pair in holders:
                for name in holders[pair]:
                    found[name].append((at, pair))
        return found

    def _windows(self, name: str, places: list[tuple[int, tuple[bytes, bytes]]]) -> list[tuple[float, int, int]]:
        """(score, begin, end) of the best windows in words, highest first, that share no word."""
        least, most = max(1, self.bounds[name][0]), self.bounds[name][1]
        pairs, size = self.pairs[name], self.size[name]
        if len(places) < least:
            return []
        at = np.array([i for i, _ in places])
        starts = np.flatnonzero(at[least - 1 :] - at[: len(at) - least + 1] < most).tolist()
        if not starts:
            return []
        # a place counts from starts behind the last one of its bigram that the template has no more of
        spent, seen = np.full(len(at), -1), defaultdict(list)
        for k, (_, pair) in enumerate(places):
            if len(seen[pair]) >= pairs[pair]:
                spent[k] = seen[pair][-pairs[pair]]
            seen[pair].append(k)

        def best_from(first: int, limit: int) -> tuple[float, int, int, int] | None:
            stop = np.searchsorted(at, min(at[first] + most, limit - 1))
            sizes = at[first:stop] - at[first] + 1
            if not len(sizes):
                return None
            scores = 2 * np.cumsum(spent[first:stop] < first) / (sizes + size)
            k = int(scores.argmax())
            best, begin = float(scores[k]), int(at[first])
            return (-best, begin, begin + int(sizes[k]) + 1, first) if best >= self.threshold else None

        # at first what a start could reach at most, with an end of 0; counted when it is the highest
        common = np.minimum(size, np.searchsorted(at, at[starts] + most) - starts)
        open_ = list(zip((-2 * common / (common + size)).tolist(), at[starts].tolist(), [0] * len(starts), starts))
        heapq.heapify(open_)
        taken, out = bytearray(int(at[-1]) + 2), []
        while open_:
            score, begin, end, first = heapq.heappop(open_)
            other = taken.find(1, begin, end or len(taken))
            if end and other < 0:
                taken[begin:end] = b"\1" * (end - begin)
                out.append((-score, begin, end))
            elif other != begin and (best := best_from(first, other if other > 0 else len(taken))):
                heapq.heappush(open_, best)
        return out

    def hits(self, text: bytes) -> list[tuple[str, float, bool, bytes]]:
        """(template, score, whether it counts, words) of passages and windows that reach the threshold.

        A window counts unless a passage that shares words with it is a hit of the same template, whose place
        it only tells more exactly, or it is the part of a longer template's window that has its wording. Where the
        longer one is of a size that could be the shorter one's text, the higher score decides.
        """
        plain = text.translate(_PLAIN)
        words = plain.split()
        if self.anchors.isdisjoint(words):
            return []
        places = self._places(words)
        windows = {name: found for name, p in places.items() if (found := self._windows(name, p))}
        if not windows:
            return []
        ranges, out = self._passages(text, len(words)), []
        for name, found in windows.items():
            at, taken = [i for i, _ in places[name]], bytearray(len(words))
            for begin, end in ranges:
                inside = places[name][bisect_left(at, begin) : bisect_left(at, end - 1)]
                common = sum((Counter(p for _, p in inside) & self.pairs[name]).values())
                score = 2 * common / (end - begin - 1 + self.size[name])
                if score >= self.threshold:
                    taken[begin:end] = b"\1" * (end - begin)
                    out.append((name, score, True, b" ".join(words[begin:end])))
            most = self.bounds[name][1]
            longer = [(s, self.size[x] > most, b, e) for x in self.within[name] for s, b, e in windows.get(x, [])]
            for score, begin, end in found:
                if not any((much or s >= score) and b <= begin and end <= e for s, much, b, e in longer):
                    out.append((name, score, taken.find(1, begin, end) < 0, b" ".join(words[begin:end])))
        return out

    def _passages(self, text: bytes, n: int) -> list[tuple[int, int]]:
        """The lines, paragraphs and the whole text as ranges of its words, of admissible sizes."""
        least = max(1, min(a for a, _ in self.bounds.values()))
        most = max(b for _, b in self.bounds.values())
        out = {(0, n)}
        for parts in (text.split(b"\n"), re.split(rb"\n[ \t\r]*\n", text)):
            begin = 0
            for part in parts:
                end = begin + len(part.translate(_PLAIN).split())
                out.add((begin, end))
                begin = end
        return sorted((b, e) for b, e in out if least <= e - b - 1 <= most)


def passages(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, template, score, counts, plain of the passages and windows that reach the threshold with a template."""
    scanner = Scanner(templates or published(), threshold)
    id_ = docs.select("doc_id").schema.fields[0]
    added = T.StructType.fromDDL("template string, score double, counts boolean, plain string")
    schema = T.StructType([id_, *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, rows, found = batch.column("text").cast(pa.large_binary()), [], []
            for i, text in enumerate(texts):
                hits = scanner.hits(text.as_py()) if text.is_valid else []
                rows += [i] * len(hits)
                found += hits
            names, scores, counts, plain = zip(*found) if found else ([], [], [], [])
            columns = [
                batch.column("doc_id").take(pa.array(rows, pa.int64())),
                pa.array(names, pa.string()),
                pa.array(scores, pa.float64()),
                pa.array(counts, pa.bool_()),
                pa.array([p.decode() for p in plain], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document id: doc_id, license, score, n_hits.

    ``license`` is the template with the highest score in the document, ties to the first by name, null if
    neither a passage nor a window reaches the threshold; ``n_hits`` counts pairs of passage and template that do, and
    windows at places where no passage does. Those of a document that are alike in normal form count once. Null, empty
    and very short texts have none. Rows that repeat an id are counted together, those without an id as one.
    """
    hits = passages(docs, templates, threshold)
    hits = hits.groupBy("doc_id", "template", "plain").agg(F.max("score").alias("score"), F.max("counts").alias("counts"))
    best = hits.groupBy(F.col("doc_id").alias("_id")).agg(
        F.count_if("counts").alias("n_hits"),
        F.max("score").alias("score"),
        F.min_by("template", F.struct(-F.col("score"), F.col("template"))).alias("license"),
    )
    ids = docs.select("doc_id").distinct()
    joined = ids.join(best, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    return joined.select("doc_id", "license", "score", F.coalesce("n_hits", F.lit(0)).cast("long").alias("n_hits"))
