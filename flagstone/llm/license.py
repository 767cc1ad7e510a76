"""Licence scan: Dice coefficient over word bigrams against licence templates.

Texts and templates are normalised to lower-case words without punctuation and
copyright lines. With a bigrams in a passage and t in a template, Dice =
2 * shared / (a + t); it can reach the threshold d only if
t * d / (2 - d) <= a <= t * (2 - d) / d.

With ``inside`` (as op8_license_scan has it) every run of consecutive words is
a passage, whatever lines, paragraphs or prose it lies in. The run with the
highest Dice of all runs and templates is taken, and the words before it and
after it are searched in the same way, so a word belongs to one licence at
most. A best run begins and ends with a bigram of its template, and the lower
bound must be met by shared bigrams: only such starts are tried, with every end
within the upper bound. A run for a notice (a template of up to 150 words) must
name the licence as the template does and agree with it in version and variant
words; longer texts are told apart by the highest Dice alone.

Without it the passages are every line, every paragraph between blank lines and
the whole text.

Defined cases: null, empty and word-less texts match nothing; a passage of one
word is compared by that word; of equal scores the template first by name wins
(with ``inside`` the longer template, then the one first by name), of equal
passages the first (then the shortest); repeated rows get repeated results; a
null id stays; extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import Counter
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import steps
from .license_texts import FULL_TEXTS

# Short notices and texts of common licences, by SPDX identifier.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License, Version 2.0.",
        "This work is licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS "
        "AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR "
        "CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT "
        "NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
        "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
        "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC0-1.0": ["Released under CC0 1.0 Universal, dedicated to the public domain."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This "
        "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have "
        "received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
    ],
    "LGPL-3.0": ["This work is licensed under the GNU Lesser General Public License, version 3."],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY "
        "OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR "
        "THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
}

_ISC = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
    "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
    "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_PERMIT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"


def _more_templates():
    """(licence, template) of further notices; the forms of a family differ in name and version only."""
    begins = ("Licensed under", "Released under", "This work is licensed under")
    notice = TEMPLATES["GPL-3.0"][2]
    general, library = "GNU General Public License", notice.replace("This program", "This library").replace("this program", "this library")
    for spdx, name, version in (
        ("GPL-2.0", general, "2"),
        ("GPL-3.0", general, "3"),
        ("AGPL-3.0", "GNU Affero General Public License", "3"),
        ("LGPL-2.0", "GNU Library General Public License", "2"),
        ("LGPL-2.1", "GNU Lesser General Public License", "2.1"),
        ("LGPL-3.0", "GNU Lesser General Public License", "3"),
    ):
        for begin in begins:
            yield spdx, f"{begin} the {name}, version {version}."
            yield spdx, f"{begin} the {name} v{version if '.' in version else version + '.0'}."
        for text in (notice, library):
            yield spdx, text.replace(general, name).replace("version 3", f"version {version}")
    for version, end in (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic")):
        for code, name in (
            ("BY", "Attribution"),
            ("BY-SA", "Attribution-ShareAlike"),
            ("BY-NC", "Attribution-NonCommercial"),
            ("BY-ND", "Attribution-NoDerivatives" if version == "4.0" else "Attribution-NoDerivs"),
            ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives" if version == "4.0" else "Attribution-NonCommercial-NoDerivs"),
        ):
            for begin in begins:
                yield f"CC-{code}-{version}", f"{begin} CC {code} {version}."
                yield f"CC-{code}-{version}", f"{begin} a Creative Commons {name} {version} {end} License."
    for spdx, name in (
        ("Apache-2.0", "Apache License 2.0"),
        ("BSD-2-Clause", "BSD 2-Clause License"),
        ("BSD-3-Clause", "BSD 3-Clause License"),
        ("ISC", "ISC License"),
        ("MIT", "MIT License"),
        ("MPL-1.1", "Mozilla Public License, version 1.1"),
        ("MPL-2.0", "Mozilla Public License, version 2.0"),
    ):
        for begin in begins:
            yield spdx, f"{begin} the {name}."
    bsd = TEMPLATES["BSD-3-Clause"][2]
    yield "BSD-2-Clause", bsd[: bsd.index("3. Neither")] + bsd[bsd.index("THIS SOFTWARE IS") :]
    yield "ISC", f"{_PERMIT}, provided that the above copyright notice and this permission notice appear in all copies. {_ISC}"
    yield "0BSD", f"{_PERMIT}. {_ISC}"
    yield "Unlicense", "This is released into the public domain under the Unlicense."
    mit = TEMPLATES["MIT"][2]
    yield "Unlicense", (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software "
        "dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the "
        "public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of "
        "relinquishment in perpetuity of all present and future rights to this software under copyright law. "
        + mit[mit.index("THE SOFTWARE IS") :].replace("AUTHORS OR COPYRIGHT HOLDERS", "AUTHORS")
    )


for _name, _text in _more_templates():
    if _text not in TEMPLATES.setdefault(_name, []):
        TEMPLATES[_name].append(_text)

NOTICE_WORDS = 150
NAMES = set("apache bsd gnu isc mit mozilla mpl unlicense".split())
VARIANTS = {"nc": "nc", "noncommercial": "nc", "commercial": "nc", "sa": "sa", "sharealike": "sa", "alike": "sa", "nd": "nd", "noderivatives": "nd", "noderivs": "nd", "derivatives": "nd", "derivs": "nd"}
LEADS = {"version", "v", "license", "licence", "attribution", "by", "cc", "cc0", "bsd", "mpl", "gpl", "lgpl", "agpl", *VARIANTS}
_V = re.compile(r"v(\d+)$")

_WORD = re.compile(r"[^\W_]+")
_COPYRIGHT = re.compile(r"^\s*(?:copyright\b|\(c\)\s|©).*$", re.I | re.M)


def normalise(text: str) -> list[str]:
    return _WORD.findall(_COPYRIGHT.sub(" ", text).lower())


def placed_words(text: str) -> tuple[list[str], list[int]]:
    """Normalised words, and for each line the number of words before it."""
    words: list[str] = []
    before = []
    for line in _COPYRIGHT.sub(lambda m: "\n" * m[0].count("\n"), text).lower().split("\n"):
        before.append(len(words))
        words += _WORD.findall(line)
    return words, before


def marks(words: list[str]) -> tuple[set[str], set[str]]:
    """Licence names, and words that tell versions and variants apart."""
    names, kinds = NAMES.intersection(words), set()
    for i, w in enumerate(words):
        if w in VARIANTS:
            kinds.add(VARIANTS[w])
        elif w == "gnu" and i + 1 < len(words):
            kinds.add("gnu " + words[i + 1])
        first = _V.match(w)
        if first or (w.isdigit() and i and words[i - 1] in LEADS):
            run = [first[1] if first else w]
            for x in words[i + 1 :]:
                if not x.isdigit():
                    break
                run.append(x)
            kinds.add(".".join(run).removesuffix(".0"))
    return names, kinds


def bigrams(words: list[str]) -> list[tuple[str, ...]]:
    return list(zip(words, words[1:], strict=False)) if len(words) > 1 else [tuple(words)] if words else []


def dice(a: list[tuple[str, ...]], b: list[tuple[str, ...]]) -> float:
    """Dice coefficient of two bigram multisets."""
    return 2 * sum((Counter(a) & Counter(b)).values()) / (len(a) + len(b)) if a and b else 0.0


class Templates:
    """Templates by number with their bigram counts, size bounds and an index of bigrams."""

    def __init__(self, templates: dict[str, list[str]], threshold: float):
        self.threshold = threshold
        self.names = [name for name in sorted(templates) for _ in templates[name]]
        grams = [bigrams(normalise(t)) for name in sorted(templates) for t in templates[name]]
        self.counts = [Counter(g) for g in grams]
        self.sizes = [len(g) for g in grams]
        low, high = threshold / (2 - threshold), (2 - threshold) / threshold
        self.bounds = [(n * low, n * high) for n in self.sizes]
        self.least = min((lo for lo, _ in self.bounds), default=0)
        self.most = max((hi for _, hi in self.bounds), default=0)
        self.with_gram: dict[tuple[str, ...], list[int]] = {}
        for t, c in enumerate(self.counts):
            for g in c:
                self.with_gram.setdefault(g, []).append(t)
        placed = [normalise(t) for name in sorted(templates) for t in templates[name]]
        self.marks = [marks(w) if len(w) <= NOTICE_WORDS else None for w in placed]
        self.pairs, self.singles = (any(len(g) == n for g in self.with_gram) for n in (2, 1))

    def best(self, text: str) -> tuple[str, float] | None:
        """Best template of a passage at or above the threshold."""
        grams = bigrams(normalise(text))
        size = len(grams)
        if not size or not self.least <= size <= self.most:
            return None
        known = Counter(g for g in grams if g in self.with_gram)
        fits = {t for g in known for t in self.with_gram[g] if self.bounds[t][0] <= size <= self.bounds[t][1]}
        found = None
        for t in sorted(fits):
            shared = sum(min(n, self.counts[t][g]) for g, n in known.items())
            score = 2 * shared / (size + self.sizes[t])
            if score >= self.threshold and (found is None or score > found[1]):
                found = (self.names[t], score)
        return found


    def agrees(self, t: int, words: list[str]) -> bool:
        """Whether a run for a notice has its name, version and variant."""
        if self.marks[t] is None:
            return True
        names, kinds = marks(words)
        return self.marks[t][0] <= names and self.marks[t][1] == kinds

    def runs(self, words: list[str]) -> list[tuple[int, int, int, float]]:
        """(template, first word, end, Dice) of the best runs of words that do not overlap."""
        grams = list(zip(words, words[1:], strict=False)) if self.pairs else []
        found: dict[int, dict[tuple[str, ...], list[int]]] = {}
        places: dict[tuple[str, ...], list[int]] = {}
        for i, g in enumerate(grams):
            if g in self.with_gram:
                places.setdefault(g, []).append(i)
        for i, w in enumerate(words) if self.singles else ():
            if (w,) in self.with_gram:
                places.setdefault((w,), []).append(i)
        shared: dict[int, int] = {}
        for g, at in places.items():
            for t in self.with_gram[g]:
                shared[t] = shared.get(t, 0) + min(len(at), self.counts[t][g])
        for t, n in shared.items():
            if n >= self.bounds[t][0] - 1e-9:
                found[t] = {g: places[g] for g in self.counts[t] if g in places}
        hits = {t: _Hits(by_gram, self.counts[t], self.sizes[t], self.bounds[t], self.threshold) for t, by_gram in found.items()}
        width = {t: 1 if len(next(iter(by_gram))) == 1 else 2 for t, by_gram in found.items()}

        def entry(t, k, limit, skip=0):
            best = hits[t].best_end(k, limit, skip)
            at = hits[t].at
            return best and (-best[0], -self.sizes[t], self.names[t], int(at[k]), int(at[best[1]]) + width[t], t, k, limit, skip)

        heap = [e for t in hits for k in hits[t].starts() if (e := entry(t, int(k), len(words) - width[t]))]
        heapify(heap)
        taken: list[tuple[int, int]] = []
        out = []
        while heap:
            score, _, _, start, end, t, k, limit, skip = heappop(heap)
            i = bisect_left(taken, (start + 1,))
            if i and taken[i - 1][1] > start:
                continue
            if i < len(taken) and taken[i][0] < end:  # words were taken since: the best end before them
                if e := entry(t, k, taken[i][0] - width[t]):
                    heappush(heap, e)
                continue
            if not self.agrees(t, words[start:end]):
                if e := entry(t, k, limit, skip + 1):
                    heappush(heap, e)
                continue
            insort(taken, (start, end))
            out.append((t, start, end, -score))
        return out


class _Hits:
    """Places of a template's bigrams in a text, in order."""

    def __init__(self, by_gram: dict[tuple[str, ...], list[int]], counts: Counter, size: int, bounds: tuple[float, float], threshold: float):
        at = np.concatenate([np.array(p) for p in by_gram.values()])
        gram = np.repeat(np.arange(len(by_gram)), [len(p) for p in by_gram.values()])
        nth = np.concatenate([np.arange(len(p)) for p in by_gram.values()])
        cap = np.array([counts[g] for g in by_gram])
        order = np.argsort(at, kind="stable")
        self.at, self.gram, self.nth, self.cap = at[order], gram[order], nth[order], cap
        self.size, self.low, self.high, self.threshold = size, bounds[0], bounds[1] + 1e-9, threshold

    def starts(self) -> np.ndarray:
        """Places with enough of the bigrams in reach."""
        reach = np.searchsorted(self.at, self.at + self.high, side="right")
        return np.flatnonzero(reach - np.arange(len(self.at)) >= self.low - 1e-9)

    def best_end(self, k: int, limit: int, skip: int = 0) -> tuple[float, int] | None:
        """(Dice, last place) of the best run but ``skip`` from place ``k`` whose last place lies up to ``limit``."""
        stop = min(self.at[k] + self.high - 1, limit)
        end = int(np.searchsorted(self.at, stop, side="right"))
        if end - k < self.low - 1e-9:
            return None
        gram, nth = self.gram[k:end], self.nth[k:end]
        first = np.full(len(self.cap), -1)
        first[gram[::-1]] = nth[::-1]
        shared = np.cumsum(nth - first[gram] < self.cap[gram])
        score = 2 * shared / (self.at[k:end] - self.at[k] + 1 + self.size)
        if skip >= len(score):
            return None
        j = int(np.argsort(-score, kind="stable")[skip] if skip else np.argmax(score))
        return (float(score[j]), k + j) if score[j] >= self.threshold else None


def passages(text: str):
    """(first line, passage): lines, then paragraphs of several lines, then the whole text."""
    lines = text.split("\n")
    yield from enumerate(lines)
    start, paragraphs = 0, 0
    for i, line in enumerate([*lines, ""]):
        if line.strip():
            continue
        if i - start > 1:
            yield start, "\n".join(lines[start:i])
            paragraphs += 1
        start = i + 1
    if len(lines) > 1 and "" in (x.strip() for x in lines):
        yield 0, text


def found_in(text: str, index: Templates, inside: bool):
    """(licence, Dice, line) of the passages that reach the threshold."""
    if not inside:
        for at, passage in passages(text):
            if hit := index.best(passage):
                yield *hit, at
        return
    words, before = placed_words(text)
    for t, start, _, score in sorted(index.runs(words), key=lambda r: r[1]):
        yield index.names[t], score, bisect_left(before, start + 1) - 1


def all_templates() -> dict[str, list[str]]:
    """Notices and full texts."""
    return {n: [*TEMPLATES.get(n, []), *([FULL_TEXTS[n]] if n in FULL_TEXTS else [])] for n in {*TEMPLATES, *FULL_TEXTS}}


def _scan(templates: dict[str, list[str]] | None, threshold: float, inside: bool):
    def run(batches):
        index = Templates(all_templates() if templates is None else templates, threshold)
        for whole in batches:
            for batch in steps([whole], "text"):
                names, lines, scores = [], [], []
                for text in batch.column("text").to_pylist():
                    best: dict[str, tuple[float, int]] = {}
                    for name, score, at in found_in(text or "", index, inside):
                        if score > best.get(name, (0.0, 0))[0]:
                            best[name] = (score, at)
                    order = sorted(best, key=lambda n: (-best[n][0], n))
                    names.append(order)
                    lines.append([best[n][1] for n in order])
                    scores.append([best[n][0] for n in order])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array(names, pa.list_(pa.string())),
                        pa.array(lines, pa.list_(pa.int32())),
                        pa.array(scores, pa.list_(pa.float64())),
                    ],
                    ["doc_id", "licenses", "lines", "scores"],
                )

    return run


def license_scan(
    docs: DataFrame,
    templates: dict[str, list[str]] | None = None,
    threshold: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
    inside: bool = False,
) -> DataFrame:
    """(doc_id, licenses, lines, scores) for every row: licences found, best first, the
    line where the best passage of each begins (from 0) and its Dice coefficient.
    ``inside`` takes every run of words as a passage, not only lines, paragraphs and texts."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, licenses array<string>, lines array<int>, scores array<double>"
    return source.mapInArrow(_scan(templates, threshold, inside), schema)
