"""License statements by conditional compression, confirmed by their wording.

Sentences and lines that hold a cue word of licences make a candidate block, with at most one
other sentence or ``2 * _MARGIN`` characters between them and ``_MARGIN`` characters around. A block is read in windows of words that overlap by
twice the longest template; a statement belongs to the window it starts in before the overlap.
The window is compressed alone and with each template as raw dictionary of Zstandard, with
equal parameters; templates are ranked by how many bytes they save, less the letters of
their words that the window lacks. Compression only ranks: every template with enough words
in the window is tried. In that order a template is confirmed when an exact alignment of words finds
at least ``min_similarity`` of its words in the block, in order and not claimed by a better one, and
no word with a digit or of capitals only, which tell versions and variants apart, is
missing. What is missing and what is extra in the aligned stretch is returned with the finding.

Texts are read whole, blocks may be of any length, no row leaves its task.

Defined cases: null and empty texts have no findings; repeated rows are scanned each; null
ids are passed on; no templates or no rows give no rows. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from halfhourly.llm.common import arrow_texts, decoded, texts_of

MIN_SIMILARITY, LEVEL = 0.8, 9
#: Characters around a cue sentence that belong to its block, as wrapped texts have lines without a cue.
_MARGIN = 500
#: Words of a window before its overlap, and the size that the parameters of compression are for.
_STEP, _WINDOW_BYTES = 512, 8192

_MIT_REST = (
    "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
    "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
    "Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
    "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION "
    "OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE.")
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,")
_BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution.")
_BSD_THREE = _BSD_TWO + (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.")
_BSD_REST = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
    "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
    "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
    "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY "
    "OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_APACHE_HEADER = (
    "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
    "with the License. You may obtain a copy of the License at {}://www.apache.org/licenses/LICENSE-2.0 Unless required "
    "by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
    "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
    "language governing permissions and limitations under the License.")
_GNU_HEADER = (
    "This {} is free software{} you can redistribute it and/or modify it under the terms of the GNU {} as published by "
    "the Free Software Foundation{} either version {} of the License, or (at your option) any later version.")
_MPL_HEADER = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at {}://mozilla.org/MPL/2.0/.")
_SPDX = ("MIT Apache-2.0 BSD-2-Clause BSD-3-Clause ISC Zlib BSL-1.0 0BSD Unlicense MPL-2.0 EPL-1.0 EPL-2.0 CC0-1.0 "
         "CC-BY-3.0 CC-BY-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC-BY-NC-4.0 CC-BY-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-NC-ND-4.0 "
         "GPL-2.0 GPL-2.0+ GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0+ GPL-3.0-only GPL-3.0-or-later LGPL-2.1 "
         "LGPL-2.1+ LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0+ LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0 "
         "AGPL-3.0-only AGPL-3.0-or-later").split()
_SPDX_PAIRS = ("MIT OR Apache-2.0", "Apache-2.0 OR MIT", "Apache-2.0 WITH LLVM-exception",
               "GPL-2.0 WITH Linux-syscall-note")
_CC_KINDS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
             "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
             "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}


def _more_templates() -> Iterator[tuple[str, str]]:
    """Full short texts, file headers, titles of the long texts, Creative Commons and SPDX forms."""
    yield "MIT-full", f"{_MIT_GRANT} {_MIT_REST}"
    yield "BSD-2-Clause-conditions", _BSD_TWO
    yield "BSD-3-Clause-conditions", _BSD_THREE
    yield "BSD-2-Clause-full", _BSD_TWO + _BSD_REST
    yield "BSD-3-Clause-full", _BSD_THREE + _BSD_REST
    yield "ISC-full", (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE "
        "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE "
        "USE OR PERFORMANCE OF THIS SOFTWARE.")
    yield "ISC-text", (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.")
    yield "Unlicense-text", (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
        "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
        "purpose, commercial or non-commercial, and by any means.")
    for scheme, mark in (("http", ""), ("https", "-https")):
        yield f"Apache-2.0-header{mark}", _APACHE_HEADER.format(scheme)
        yield f"MPL-2.0-header{mark}", _MPL_HEADER.format(scheme)
    gnu = {"GPL": "General Public License", "LGPL": "Lesser General Public License", "AGPL": "Affero General Public License"}
    for kind, version, what, mark in (("GPL", "2", "program", ";"), ("GPL", "3", "program", ":"), ("LGPL", "2.1", "library", ";"),
                                      ("LGPL", "3", "program", ":"), ("AGPL", "3", "program", ":")):
        name = f"{kind}-{version}" if "." in version else f"{kind}-{version}.0"
        yield f"{name}-header", _GNU_HEADER.format(what, mark, gnu[kind], mark.replace(":", ","), version)
    yield "GPL-2.0-only-header", (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License version 2 as published by the Free Software Foundation.")
    yield "LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."
    yield "AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."
    for name, title in (
            ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
            ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
            ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
            ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
            ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
            ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
            ("MPL-2.0", "Mozilla Public License Version 2.0"),
            ("EPL-2.0", "Eclipse Public License - v 2.0"), ("EPL-1.0", "Eclipse Public License - v 1.0")):
        yield f"{name}-title", title
    yield "EPL-2.0-header", (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at https://www.eclipse.org/legal/epl-2.0/")
    yield "EPL-1.0-header", (
        "All rights reserved. This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License v1.0 which accompanies this distribution, and is available at "
        "http://www.eclipse.org/legal/epl-v10.html")
    for short, long in _CC_KINDS.items():
        for version, form in (("3.0", "Unported"), ("4.0", "International")):
            if (short, version) not in {(k, "4.0") for k in ("BY", "BY-SA", "BY-NC", "BY-ND")}:
                yield f"CC-{short}-{version}", f"Licensed under CC {short} {version}."
            yield (f"CC-{short}-{version}-text",
                   f"This work is licensed under a Creative Commons {long} {version} {form} License.")
    for name in (*_SPDX, *_SPDX_PAIRS):
        yield f"SPDX:{name}", f"SPDX-License-Identifier: {name}"


#: Usual wordings of well-known licences.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("MIT-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files, to deal in the Software without restriction, including without "
                 "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
                 "copies of the Software."),
    ("Apache-2.0-text", "You may not use this file except in compliance with the License. You may obtain a copy of the "
                        "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-text", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                 "provided that the following conditions are met."),
    *_more_templates(),
)

_CUE = re.compile(r"licen[sc]|copyright|permission|permitted|warrant|redistribut|creative commons|public domain|spdx"
                  r"|cc0|cc by|rights reserved|documentation files|sublicense|software|©", re.IGNORECASE)
_GAP = re.compile(r"(?<=[.!?])\s+|\n+")
_WORD = re.compile(r"\S+")
_EDGES = ".,;:!?()[]\"'“”‘’"


class Finding(NamedTuple):
    start: int
    end: int
    license: str
    alone_bytes: int
    with_bytes: int
    similarity: float
    missing: str
    extra: str


def blocks(text: str) -> list[tuple[int, int]]:
    """Stretches around cue sentences, as the module says."""
    if not _CUE.search(text):
        return []
    out: list[list[int]] = []
    start, others = 0, 2
    for end, after in [*((m.start(), m.end()) for m in _GAP.finditer(text)), (len(text), len(text))]:
        if end > start:
            if _CUE.search(text, start, end):
                if out and (others <= 1 or start - out[-1][1] <= 2 * _MARGIN):
                    out[-1][1] = end
                else:
                    out.append([start, end])
                others = 0
            else:
                others += 1
        start = after
    return [(_word_edge(text, a, -1), _word_edge(text, b, 1)) for a, b in out]


def _word_edge(text: str, at: int, way: int) -> int:
    """The farthest edge of a whole word within ``_MARGIN`` characters before or after ``at``."""
    far = min(max(at + way * _MARGIN, 0), len(text))
    while 0 < far < len(text) and far != at and not text[far if way > 0 else far - 1].isspace():
        far -= way
    return far


def _bare(word: str) -> str:
    return word.strip(_EDGES)


def _tells(word: str) -> bool:
    return any(c.isdigit() for c in word) or (len(word) > 1 and word == word.upper() and word.lower() != word)


def _places(words: list[str]) -> dict[str, int]:
    found: dict[str, int] = {}
    for k, w in enumerate(words):
        found[w] = found.get(w, 0) | 1 << k
    return found


class _Template(NamedTuple):
    name: str
    words: list[str]
    lowered: list[str]
    counts: Counter
    tells: Counter
    need: float
    packer: zstandard.ZstdCompressor
    places: dict[str, int]

    def in_order(self, words: list[str]) -> int:
        """How many of the template's words stand in these in its order, at most: their longest common subsequence.

        The places of a word in the template are bits of a number; a step over a word is an addition.
        """
        every = (1 << len(self.lowered)) - 1
        row = every
        for w in words:
            if at := self.places.get(w):
                kept = row & at
                row = (row + kept | row - kept) & every
        return len(self.lowered) - row.bit_count()


class Scanner:
    """The templates with their compressors."""

    def __init__(self, templates: tuple[tuple[str, str], ...], min_similarity: float = MIN_SIMILARITY):
        equal = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=_WINDOW_BYTES, write_content_size=False)
        self.alone = zstandard.ZstdCompressor(compression_params=equal)
        self.templates: list[_Template] = []
        for name, text in templates:
            known = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words = [_bare(w) for w in text.split()]
            lowered = [w.lower() for w in words]
            self.templates.append(_Template(name, words, lowered, Counter(lowered),
                                            Counter(w.lower() for w in words if _tells(w)), min_similarity * len(words),
                                            zstandard.ZstdCompressor(compression_params=equal, dict_data=known),
                                            _places(lowered)))
        self.overlap = 2 * max((len(t.words) for t in self.templates), default=0)

    def find(self, text: str) -> list[Finding]:
        return [f for a, b in blocks(text) for f in self._of_block(text, a, b)]

    def _of_block(self, text: str, start: int, end: int) -> list[Finding]:
        spots = [(m.start(), m.end()) for m in _WORD.finditer(text, start, end)]
        words = [_bare(text[a:b]) for a, b in spots]
        lowered: list[str | None] = [w.lower() for w in words]
        out: list[Finding] = []
        for first in range(0, max(len(words) - self.overlap, 1), _STEP):
            stop = first + _STEP + self.overlap
            limit = first + _STEP if stop < len(words) else len(words)
            stop = min(stop, len(words))
            ranked = self._ranked(text[spots[first][0]:spots[stop - 1][1]], lowered[first:stop]) if stop else []
            for size, packed, template in ranked:
                for a, b, similarity, missing, extra in list(self._aligned(words, lowered, template, first, limit, stop)):
                    out.append(Finding(spots[a][0], spots[b][1], template.name, size, packed, similarity,
                                       " ".join(missing), " ".join(extra)))
                    lowered[a:b + 1] = [None] * (b + 1 - a)
        return sorted(out)

    def _ranked(self, stretch: str, lowered: list[str | None]) -> list[tuple[int, int, _Template]]:
        """The templates with enough words in a window, best first, with the sizes alone and with them."""
        held, found = Counter(lowered), []
        for k, t in enumerate(self.templates):
            if any(held[w] < n for w, n in t.tells.items()):  # none of these may be missing
                continue
            lacking = [(w, n - held[w]) for w, n in t.counts.items() if held[w] < n]
            if len(t.words) - sum(n for _, n in lacking) >= t.need:
                found.append((k, sum(n * len(w) for w, n in lacking)))
        if not found:
            return []
        data = stretch.encode("utf-8", "surrogatepass")
        size = len(self.alone.compress(data))
        packed = {k: len(self.templates[k].packer.compress(data)) for k, _ in found}
        return [(size, packed[k], self.templates[k]) for k, lost in sorted(found, key=lambda f: (packed[f[0]] + f[1], f[0]))]

    def _aligned(self, words: list[str], lowered: list[str | None], template: _Template,
                 begin: int, limit: int, stop: int) -> Iterator[tuple]:
        """The places of a template that start before ``limit``, from left to right: first and last
        word, share of its words found, differences. Claimed words are None."""
        _, wanted, target, counts, _, need, *_ = template
        width = 2 * len(target)

        def wall_after(i: int) -> int:
            wall = i
            while wall < min(i + width, stop) and lowered[wall] is not None:
                wall += 1
            return wall

        def match(i: int) -> list:
            found = SequenceMatcher(None, lowered[i:wall_after(i)], target, autojunk=False).get_matching_blocks()
            return [(i + m.a, m.b, m.size) for m in found if m.size]

        hits = [i for i in range(begin, stop) if lowered[i] in counts]
        near: Counter = Counter()
        common, end, upto, futile = 0, -1, 0, -1.0
        for i in hits:
            if i >= limit:
                break
            while upto < len(hits) and hits[upto] < i + width:
                near[lowered[hits[upto]]] += 1
                common += near[lowered[hits[upto]]] <= counts[lowered[hits[upto]]]
                upto += 1
            enough = common >= need
            common -= near[lowered[i]] <= counts[lowered[i]]
            near[lowered[i]] -= 1
            if i <= end or i < futile or not enough:  # too few words of the template are near
                continue
            wall = wall_after(i)
            ordered = template.in_order(lowered[i:wall])
            if ordered < need:  # or too few in its order; a step to the right adds one at most
                futile = min(i + need - ordered, wall)
                continue
            found = match(i)
            same = sum(size for *_, size in found)
            if same < need:
                continue
            if found[0][0] > i:  # from its own start, as the stretch from i may end too early
                if found[0][0] >= limit:
                    continue
                again = match(found[0][0])
                if (same_again := sum(size for *_, size in again)) >= same:
                    found, same = again, same_again
            held = {b + x for _, b, size in found for x in range(size)}
            missing = [w for k, w in enumerate(wanted) if k not in held]
            if any(_tells(w) for w in missing):
                continue
            first, end = found[0][0], found[-1][0] + found[-1][2] - 1
            used = {a + x for a, _, size in found for x in range(size)}
            yield first, end, same / len(target), missing, [words[j] for j in range(first, end + 1) if j not in used]


def found_licenses(docs: DataFrame, keep: list[str], text_col: str = "text",
                   templates: tuple[tuple[str, str], ...] = TEMPLATES,
                   min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """One row per finding: the ``keep`` columns, its span, the licence, the sizes, the share of its
    wording found, and the words missing and extra."""
    read, n = arrow_texts(docs, text_col, keep), len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, min_similarity)
        for batch in batches:
            rows, found = [], []
            for i, text in enumerate(texts_of(batch, n)):
                for f in scanner.find(decoded(text)):
                    rows.append(i)
                    found.append(f)
            kept = [c.take(pa.array(rows, pa.int64())) for c in batch.columns[:n]]
            made = [pa.array([f[c] for f in found], kind) for c, kind in enumerate(_KINDS)]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=[*batch.schema.names[:n], *Finding._fields])

    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in read.schema.fields[:n]]
    schema = ", ".join([*kinds, "`start` bigint, `end` bigint, license string, alone_bytes bigint, with_bytes bigint, "
                                "similarity double, missing string, extra string"])
    made = read.mapInArrow(run, schema)
    return made.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *[F.col(f"`{c}`") for c in Finding._fields])


_KINDS = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.string(), pa.string())
