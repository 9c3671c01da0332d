"""License scans by patience alignment.

A stretch of a document is aligned with a license template: words that occur once in both are anchors if
their order agrees (the longest increasing subsequence of their places), and the gaps between anchors are
aligned in the same way. Coverage is the share of the template's words that the alignment matches.

A stretch that reaches ``coverage`` lacks less than ``1 - coverage`` of the template's places, so of slightly
more places than that, at least one is matched. The rarest such places in the document say where to look.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import release_memory

COVERAGE = 0.8
WORD = re.compile(r"\w+")

# Notices and grants as their publishers word them.
TEMPLATES = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        'law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES '
        "OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."
    ),
    "Apache": (
        'Licensed under the Apache License (the "License"); you may not use this file except in compliance with the License. Unless '
        'required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission."
    ),
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "MIT-notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software."
    ),
    "All-rights-reserved": "All rights reserved.",
}

# Families by version: a notice, a name without the sentence around it, the grant of a source file, an SPDX tag.
_CC = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives", "BY-NC": "Attribution-NonCommercial",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
for _kind, _long in _CC.items():
    for _v in ("2.0", "2.5", "3.0", "4.0"):
        TEMPLATES.setdefault(f"CC-{_kind}-{_v}-notice", f"Licensed under CC {_kind} {_v}.")
        TEMPLATES[f"CC-{_kind}-{_v}-name"] = f"Creative Commons {_long} {_v}"
_GNU = {"GPL": ("General", "1.0 2.0 3.0"), "LGPL": ("Lesser General", "2.1 3.0"), "AGPL": ("Affero General", "3.0")}
for _short, (_long, _versions) in _GNU.items():
    for _v in _versions.split():
        _said = _v.removesuffix(".0")
        TEMPLATES.setdefault(f"{_short}-{_v}-notice", f"This work is licensed under the GNU {_long} Public License, version {_said}.")
        TEMPLATES[f"{_short}-{_v}-name"] = f"GNU {_long} Public License version {_said}"
        TEMPLATES.setdefault(f"{_short}-{_v}-or-later", TEMPLATES["GPL-3.0-or-later"].replace("GNU General", f"GNU {_long}").replace("version 3", f"version {_said}"))
# A grant whose version, or also whose family, is not said or not known.
for _short, (_long, _) in _GNU.items():
    TEMPLATES[f"{_short}-or-later"] = TEMPLATES["GPL-3.0-or-later"].replace("GNU General", f"GNU {_long}").replace("version 3", "version")
TEMPLATES["GNU-or-later"] = TEMPLATES["GPL-or-later"].replace("GNU General", "GNU")
TEMPLATES |= {
    "Apache-1.1-notice": "Licensed under the Apache License, Version 1.1.",
    "BSD-2-Clause-notice": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause-notice": "Released under the BSD 3-Clause License.",
    "ISC-notice": "Released under the ISC License.",
    "Zlib-notice": "Released under the zlib License.",
    "Unlicense-notice": "Released under the Unlicense.",
    "BSL-1.0-notice": "Distributed under the Boost Software License, Version 1.0.",
    "EPL-1.0-notice": "Licensed under the Eclipse Public License, version 1.0.",
    "EPL-2.0-notice": "Licensed under the Eclipse Public License, version 2.0.",
    "CC0-1.0-notice": "Licensed under CC0 1.0.",
    "CC0-1.0-name": "Creative Commons Zero 1.0",
    "MPL-1.1-notice": "Licensed under the Mozilla Public License, version 1.1.",
    "MPL-2.0-notice": "Licensed under the Mozilla Public License, version 2.0.",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}
_SPDX = (
    "0BSD AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 CC-BY-3.0 CC-BY-4.0 "
    "CC-BY-SA-3.0 CC-BY-SA-4.0 CC-BY-NC-4.0 CC-BY-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-NC-ND-4.0 CC0-1.0 EPL-1.0 EPL-2.0 GPL-2.0 GPL-2.0-only "
    "GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later MIT "
    "MIT-0 MPL-1.1 MPL-2.0 Unlicense WTFPL Zlib"
)
TEMPLATES |= {f"SPDX-{_id}": f"SPDX-License-Identifier: {_id}" for _id in _SPDX.split()}
# Whole texts, as published; without the line of the copyright holder where there is one.
TEMPLATES |= {f"{_file.stem}-text": _file.read_text() for _file in sorted((Path(__file__).parent / "licenses").glob("*.txt"))}

# What names a license: the phrases that occur in a template, by how its name begins, must be matched.
PHRASES = {
    "GPL": ["GNU General Public License"], "LGPL": ["GNU Lesser General Public License"], "LGPL-2.0": ["GNU Library General Public License"],
    "AGPL": ["GNU Affero General Public License"], "GFDL": ["GNU Free Documentation License"], "Apache": ["Apache License"],
    "MPL": ["Mozilla Public License"], "BSL": ["Boost Software License"], "Artistic": ["Artistic License"], "GNU": ["GNU"],
}
VERSIONED = re.compile(r"[A-Za-z]+-([0-9]+(?:\.[0-9]+)?)")
#: Words that any notice may hold; of notices, names and tags all others must be matched.
ANY_NOTICE = frozenset("a are available distributed is its license licensed of released terms the this under v version work".split())
NOTICE = re.compile(r"-notice$|-name$|^SPDX-|^All-rights-reserved$")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def naming_phrases(name: str, words: list[str]) -> list[list[range]]:
    """What must be matched, word beside word, for a stretch to be called ``name``: for each phrase the places where
    the template has it, one of which will do."""
    if NOTICE.search(name):
        named = [i for i, w in enumerate(words) if w not in ANY_NOTICE]
        runs = np.split(named, np.flatnonzero(np.diff(named) > 1) + 1)
        return [[range(int(r[0]), int(r[-1]) + 1)] for r in runs if len(r)]
    family = max((k for k in PHRASES if name.startswith(k)), key=len, default="")
    phrases = [words_of(p) for p in PHRASES.get(family, [])]
    version = VERSIONED.match(name)
    if version and family:
        number = words_of(version[1].removesuffix(".0"))
        phrases += [[v, *n] for v in ("version", "v") for n in (words_of(version[1]), number)]
    out = []
    for phrase in phrases:
        size = len(phrase)
        places = [range(i, i + size) for i in range(len(words) - size + 1) if words[i:i + size] == phrase]
        # Of the ways to write a version the first that the template has.
        if places and not (phrase[0] in ("version", "v") and any(words[p[0][0]] in ("version", "v") for p in out)):
            out.append(places)
    return out


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched places of ``a`` and ``b``, ascending in both."""
    out: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        # Equal words at the borders of a gap belong to its neighbours.
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        anchors = _anchors(a, b, a0, a1, b0, b1)
        if not anchors:
            continue
        out += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        gaps += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:]) if i + 1 < k and j + 1 < m]
    return sorted(out)


def _anchors(a: list[str], b: list[str], a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """Words unique on both sides, in the longest order that both share."""
    own, other = _once(a, a0, a1), _once(b, b0, b1)
    shared = sorted((i, other[w]) for w, i in own.items() if w in other)
    tops: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for at, (_, j) in enumerate(shared):
        k = bisect_left(tops, j)
        tops[k:k + 1], ends[k:k + 1] = [j], [at]
        back.append(ends[k - 1] if k else -1)
    out = []
    at = ends[-1] if ends else -1
    while at >= 0:
        out.append(shared[at])
        at = back[at]
    return out[::-1]


def _once(words: list[str], start: int, stop: int) -> dict[str, int]:
    places: dict[str, int] = {}
    for i in range(start, stop):
        places[words[i]] = -1 if words[i] in places else i
    return {w: i for w, i in places.items() if i >= 0}


class Scanner:
    """Looks for every template in documents."""

    def __init__(self, templates: dict[str, str], coverage: float = COVERAGE):
        self.templates = {name: words_of(text) for name, text in templates.items() if words_of(text)}
        self.coverage = coverage
        self.named = {name: naming_phrases(name, words) for name, words in self.templates.items()}
        self.bags = {name: Counter(words) for name, words in self.templates.items()}
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for bag in self.bags.values() for w in bag}))}
        self.weights = np.zeros((len(self.vocabulary), len(self.templates)), dtype=np.int32)
        for t, bag in enumerate(self.bags.values()):
            for w, n in bag.items():
                self.weights[self.vocabulary[w], t] = n
        self.needed = np.array([self._needed(len(words)) for words in self.templates.values()])

    def _needed(self, size: int) -> int:
        return int(-(-(size * self.coverage - 1e-9) // 1))

    def scan(self, text: str) -> list[dict]:
        """Disjoint stretches, in order. Of overlapping ones that with most words matched beyond those it lacks."""
        words = words_of(text)
        places: dict[str, list[int]] = defaultdict(list)
        for i in [i for i, w in enumerate(words) if w in self.vocabulary]:
            places[words[i]].append(i)
        if not places:
            return []
        held = self.weights[[self.vocabulary[w] for w in places]].sum(axis=0)
        names = list(self.templates)
        found = [x for t in np.flatnonzero(held >= self.needed) for x in self._stretches(names[t], words, places)]
        found.sort(key=lambda x: (-x["score"], -x["coverage"], x["start"], x["license"]))
        starts: list[int] = []
        kept: list[dict] = []
        for x in found:
            at = bisect_left(starts, x["start"])
            if (at and kept[at - 1]["stop"] > x["start"]) or (at < len(kept) and kept[at]["start"] < x["stop"]):
                continue
            starts.insert(at, x["start"])
            kept.insert(at, x)
        return [{k: v for k, v in x.items() if k != "score"} for x in kept]

    def _stretches(self, name: str, words: list[str], places: dict[str, list[int]]) -> Iterator[dict]:
        template, bag, named = self.templates[name], self.bags[name], self.named[name]
        size = len(template)
        needed = self._needed(size)
        missing_at_most = size - needed
        order = sorted(range(size), key=lambda i: (len(places.get(template[i], ())), i))
        probes = sorted((at, i) for i in order[: missing_at_most + 1] for at in places.get(template[i], ()))
        slack = max(4, size // 2)
        # Probes whose windows lie in one stretch with too few of the template's words fall together.
        hopeful: dict[int, bool] = {}
        tried: set[tuple[int, int]] = set()
        end = 0
        for at, i in probes:
            if at < end:
                continue
            group = (at - i) // slack
            if group not in hopeful:
                wide = Counter(words[max(0, (group - 1) * slack):max(0, (group + 2) * slack + size)])
                hopeful[group] = sum(min(n, wide[w]) for w, n in bag.items()) >= needed
            if not hopeful[group]:
                continue
            start, stop = max(end, at - i - slack), min(len(words), at - i + size + slack)
            if (start, stop) in tried:
                continue
            tried.add((start, stop))
            pairs = align(words[start:stop], template)
            if len(pairs) >= needed and _said(named, pairs):
                first, end = start + pairs[0][0], start + pairs[-1][0] + 1
                yield {"license": name, "coverage": len(pairs) / size, "start": first, "stop": end, "score": 2 * len(pairs) - size}


def _said(named: list[list[range]], pairs: list[tuple[int, int]]) -> bool:
    at = {j: i for i, j in pairs}
    return all(any(all(at.get(j) == at.get(p[0], -1 - len(p)) + k for k, j in enumerate(p)) for p in places) for places in named)


FOUND = pa.list_(pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()), ("stop", pa.int64())]))


def _found(text: Column, templates: dict[str, str], coverage: float) -> Column:
    @F.arrow_udf("array<struct<license: string, coverage: double, start: bigint, stop: bigint>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner(templates, coverage)
        for texts in batches:
            yield pa.array([scanner.scan(t.as_py() or "") for t in texts], type=FOUND)
        release_memory()

    return run(text)


def scan(
    df: DataFrame, text: str = "text", id_col: str = "doc_id", templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE
) -> DataFrame:
    """One row per stretch that covers ``coverage`` of a template: id, ``license``, ``coverage``,
    ``start_word`` and ``stop_word`` (behind the last), counted in runs of letters and digits.

    Stretches do not overlap: where several templates cover words of a document, the one with most words matched
    beyond those it lacks is reported. What names a license, its family and version, must be matched at any length, so
    that another version or variant is not taken for it; a grant without them comes out as that of its family, or as
    ``GNU-or-later``. Documents without a license, null or empty
    texts and templates without words give no row. Ids come out as they are.
    """
    rows = df.select(F.col(f"`{id_col}`").alias("_id"), _found(F.col(f"`{text}`").cast("string"), dict(templates), coverage).alias("_f"))
    return rows.select("_id", F.explode("_f").alias("_f")).select(
        F.col("_id").alias(id_col), "_f.license", "_f.coverage", F.col("_f.start").alias("start_word"), F.col("_f.stop").alias("stop_word")
    )
