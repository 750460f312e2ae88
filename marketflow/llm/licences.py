"""Licence notices by conditional compression.

A block of text that repeats a licence compresses much better with that licence as a dictionary. A block is
the part of a text around words that licences use, as far as a template can reach in both directions, also
over lines and paragraphs; blocks that overlap are one. The places of a block that hold the wording of a
template are compressed alone and with the template as a raw zstandard dictionary, and are ranked by the bytes
that it saves; of places that overlap the one that saves most counts, all others are reported. Wording means: the
words of the template must be there, in order, but for a few. Words that tell licences apart (names, versions,
NC, SA and ND, Lesser, Affero, clauses) must agree exactly: none may be missing, added, or follow directly.

The templates are short licences in full and, of the long ones, the notices that their publishers ask for and
SPDX tags; the full text of a long licence is not among them. The opening that the BSD licences share is
reported as ``BSD`` where the clauses do not follow.

Defined cases: a null or empty text has no blocks; the line of a notice is that of its first word; equal savings are ranked by the fewer wording
differences, then by name; rows that repeat are scanned each; an empty table gives an empty result; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketflow.llm.batches import bound, slices

# Wordings of licence notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
     "with the License. You may obtain a copy of the License at"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
     "files, to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
     "as published by the Free Software Foundation, either version 3 of the License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met"),
]
_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
    "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
    "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
    "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
_BSD_THIRD = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission."
)
_BSD_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
    "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
TEMPLATES += [
    ("MIT", f"{_GRANT}, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies "
     f"or substantial portions of the Software. {_AS_IS}"),
    ("MIT-0", f"{_GRANT}. {_AS_IS}"),
    ("BSD-2-Clause", f"{_BSD} {_BSD_AS_IS}"),
    ("BSD-3-Clause", f"{_BSD} {_BSD_THIRD} {_BSD_AS_IS}"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
     "the above copyright notice and this permission notice appear in all copies."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE "
     "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE"),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
     "redistribute it freely, subject to the following restrictions"),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
     "sell, or distribute this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
     "this file, You can obtain one at"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use this file except "
     "in compliance with the License."),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"),
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1."),
    ("Apache-1.1", "Apache Software License, Version 1.1"),
    ("CC0-1.0", "This work is licensed under a Creative Commons Zero 1.0 Universal License."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
]
for _name, _title, _versions in (
    ("GPL", "GNU General Public License", ("2.0", "3.0")), ("LGPL", "GNU Lesser General Public License", ("2.1", "3.0")),
    ("LGPL", "GNU Library General Public License", ("2.0",)), ("AGPL", "GNU Affero General Public License", ("3.0",)),
):
    for _version in _versions:
        _short = _version.removesuffix(".0")
        for _what in ("program", "library", "software"):
            _gives = f"This {_what} is free software: you can redistribute it and/or modify it under the terms of the {_title}"
            TEMPLATES += [
                (f"{_name}-{_version}", f"{_gives} as published by the Free Software Foundation, either version {_short} of the License"),
                (f"{_name}-{_version}", f"{_gives} version {_short} as published by the Free Software Foundation"),
            ]
        TEMPLATES += [
            (f"{_name}-{_version}", f"This work is licensed under the {_title}, version {_short}."),
            (f"{_name}-{_version}", f"Licensed under the {_title}, version {_short}."),
            (f"{_name}-{_version}", f"Released under the {_title} v{_short}"),
        ]
_CC = {"NC": "NonCommercial", "SA": "ShareAlike", "ND": "NoDerivatives"}
for _parts in ((), ("NC",), ("SA",), ("ND",), ("NC", "SA"), ("NC", "ND")):
    for _version, _scope in (("4.0", "International"), ("3.0", "Unported")):
        _code, _title = "-".join(["BY", *_parts]), "-".join(["Attribution", *(_CC[p] for p in _parts)])
        TEMPLATES += [
            (f"CC-{_code}-{_version}", f"This work is licensed under a Creative Commons {_title} {_version} {_scope} License."),
            (f"CC-{_code}-{_version}", f"Creative Commons {_title} {_version} {_scope} License"),
            (f"CC-{_code}-{_version}", f"Licensed under CC {_code} {_version}."),
        ]
TEMPLATES += [(name, f"SPDX-License-Identifier: {name}") for name in sorted({name for name, _ in TEMPLATES} - {"BSD"})]
TEMPLATES = list(dict.fromkeys(TEMPLATES))
_HINT = re.compile(r"licen[sc]|permission is|permission to use|redistribut|copyright|warrant|spdx|unencumbered", re.IGNORECASE)
_WORD = re.compile(r"[^\W_]+(?:\.[^\W_]+)*")
# Words of one meaning that are written together or apart.
_JOINED = [
    (re.compile(pattern, re.IGNORECASE), word)
    for pattern, word in (
        (r"\bnon[\s\-]+commercial\b", "noncommercial"), (r"\bshare[\s\-]+alike\b", "sharealike"),
        (r"\bno[\s\-]*deriv(?:ative)?s?(?:[\s\-]+works)?\b", "noderivatives"),
    )
]
_NAMED_VERSION = re.compile(r"([a-z]{2,})v?(\d+(?:\.\d+)*)|v(\d+(?:\.\d+)*)")
# Words that tell licences apart wherever they stand in a notice, and those that do so also right after it.
_CHANGES = frozenset("noncommercial sharealike noderivatives nc sa nd lesser library affero clear patent advertising endorse promote".split())
_NAMES = frozenset(
    "apache mit bsd isc gnu gpl lgpl agpl mozilla mpl eclipse epl boost bsl zlib unlicense unencumbered cc cc0 creative commons attribution "
    "zero neither clause documentation substantial".split()
)
# A number after one of these is a version.
_BEFORE_VERSION = _CHANGES | _NAMES | frozenset("version versions v by license licence licenses identifier spdx".split())
# Share of a template's words that must be there.
WORDING = 0.85
# Share that a template must save of the bytes that it, or the block if that is smaller, takes alone.
SAVING = 0.35
LEVEL = 19
# Reaches of a template that one part of a long block spans.
PART = 8


def _words(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """Words as they are compared, and where they stand."""
    joined = sorted((m.start(), m.end(), word) for pattern, word in _JOINED for m in pattern.finditer(text))
    found, spans = [], []
    after = 0
    for start, end, word in [*joined, (len(text), len(text), "")]:
        for m in _WORD.finditer(text, after, start):
            lower = m[0].lower()
            named = _NAMED_VERSION.fullmatch(lower)
            if lower == "cc0" or not named or named[1] and named[1] not in _NAMES:
                parts = [lower]
            else:
                parts = [named[1], named[2]] if named[1] else ["v", named[3]]
            found += [re.sub(r"(?:\.0)+$", "", p) if p[0].isdigit() else p for p in parts]
            spans += [m.span()] * len(parts)
        if word:
            found.append(word)
            spans.append((start, end))
        after = end
    return found, spans


def _telling(words: list[str]) -> np.ndarray:
    """Which words tell licences apart: 1 inside a notice, 2 also right after it."""
    out = np.zeros(len(words), np.int64)
    for k, word in enumerate(words):
        if word in _CHANGES:
            out[k] = 2
        elif word in _NAMES:
            out[k] = 1
        elif word[0].isdigit() and len(word) < 4 and (k and words[k - 1] in _BEFORE_VERSION or words[k + 1 : k + 2] == ["clause"]):
            out[k] = 2
    return out


_ONE, _MISSING, _NEVER = 1 << 40, 1 << 20, 1 << 50


def _places(wanted: list[str], telling: np.ndarray, found: list[str], told: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Where ``wanted`` stands in ``found``, best first and apart: (first word, word after the last, missing, extra words).

    Every place has the fewest differences; costs are packed as total, missing words and distance of the start.
    """
    n = len(found)
    codes = {w: k for k, w in enumerate(dict.fromkeys(wanted))}
    here = np.array([codes.get(w, -1) for w in found], np.int64)
    passed = np.r_[0, np.cumsum(np.where(told > 0, _NEVER, _ONE))]
    cost = np.arange(n, -1, -1, dtype=np.int64)
    for word, tells in zip(wanted, telling.tolist(), strict=True):
        above = cost
        cost = above + (_NEVER if tells else _ONE + _MISSING)
        same = here == codes[word]
        cost[1:] = np.where(same, np.minimum(cost[1:], above[:-1]), cost[1:])
        cost = np.minimum.accumulate(cost - passed) + passed
    total, missing = cost // _ONE, cost // _MISSING % (_ONE // _MISSING)
    allowed = (1 - WORDING) * len(wanted)
    good = np.flatnonzero((total < _NEVER // _ONE) & (missing <= allowed) & (total - missing <= allowed))
    out: list[tuple[int, int, int, int]] = []
    for end in sorted(good.tolist(), key=lambda j: (total[j], j)):
        start = n - int(cost[end] % _MISSING)
        if all(end <= a or start >= b for a, b, _, _ in out) and not (end < n and told[end] == 2):
            out.append((start, end, int(missing[end]), int(total[end] - missing[end])))
    return out


class Scanner:
    """Compressors of all templates."""

    def __init__(self, templates: list[tuple[str, str]]):
        self.templates = []
        for name, text in templates:
            wanted, _ = _words(text)
            self.templates.append((name, text, wanted, Counter(wanted), _telling(wanted)))
        settings = {"level": LEVEL, "write_content_size": False, "write_checksum": False}
        self.alone = zstandard.ZstdCompressor(**settings)
        self.given = [
            zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT), **settings)
            for _, text in templates
        ]
        self.frame = len(self.alone.compress(b""))
        self.sizes = [len(self.alone.compress(text.encode())) - self.frame for _, text in templates]
        # Words that a place of a template can span.
        self.reach = int((2 - WORDING) * max(len(t[2]) for t in self.templates)) + 1

    def saving(self, block: str, k: int) -> tuple[int, float]:
        """Bytes that template ``k`` saves, and their share of what the smaller of block and template takes alone."""
        raw = block.encode(errors="surrogatepass")
        alone = max(1, len(self.alone.compress(raw)) - self.frame)
        saved = alone - (len(self.given[k].compress(raw)) - self.frame)
        return saved, saved / min(alone, self.sizes[k])

    def wordings(self, found: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
        """Templates that a block's words hold: template, first word, word after the last, missing and extra words."""
        told, there = _telling(found), set(found)
        for k, (_, _, wanted, counts, telling) in enumerate(self.templates):
            missing = sum(c for w, c in counts.items() if w not in there)
            if missing > (1 - WORDING) * len(wanted) or any(t and w not in there for w, t in zip(wanted, telling.tolist(), strict=True)):
                continue
            for place in _places(wanted, telling, found, told):
                yield k, *place

    def matches(self, text: str, spans: list[tuple[int, int]], found: list[str]) -> list[tuple[int, int, str, float, int, int]]:
        """Licences of a block's words, given with their places in ``text``: first and last character, name, saving, missing, extra."""
        ranked = []
        for k, first, end, missing, extra in self.wordings(found):
            start, stop = spans[first][0], spans[end - 1][1]
            saved, share = self.saving(text[start:stop], k)
            if share >= SAVING:
                ranked.append((-saved, missing + extra, self.templates[k][0], start, stop, share, missing, extra))
        kept: list[tuple[int, int, str, float, int, int]] = []
        for _, _, name, start, stop, share, missing, extra in sorted(ranked):
            if all(stop <= a or start >= b for a, b, *_ in kept):
                kept.append((start, stop, name, share, missing, extra))
        return kept

    def blocks(self, spans: list[tuple[int, int]], hints: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
        """Candidate blocks as ranges of words. Long ones are dealt into parts that share the reach of a template."""
        ends = [b for _, b in spans]
        windows: list[list[int]] = []
        for a, b in hints:
            first, last = bisect_right(ends, a), bisect_right(ends, b - 1)
            start, stop = max(0, first - self.reach), min(len(spans), last + 1 + self.reach)
            if windows and start <= windows[-1][1]:
                windows[-1][1] = stop
            else:
                windows.append([start, stop])
        for start, stop in windows:
            while stop - start > PART * self.reach:
                yield start, start + PART * self.reach
                start += (PART - 1) * self.reach
            yield start, stop

    def scan(self, text: str | None) -> tuple[int, list[tuple]]:
        """Number of candidate blocks, and (line, licence, saving, missing, extra) of the confirmed ones, one per line and licence."""
        hints = [m.span() for m in _HINT.finditer(text)] if text else []
        if not hints:
            return 0, []
        found, spans = _words(text)
        count, hits = 0, []
        for first, end in self.blocks(spans, hints):
            count += 1
            hits += self.matches(text, spans[first:end], found[first:end])
        best: dict[tuple[int, str], tuple] = {}
        placed: list[tuple[int, int]] = []
        # Parts of a long block may both hold the edge of a notice; the longer reading counts.
        for start, stop, name, *rest in sorted(set(hits), key=lambda h: (h[0] - h[1], h)):
            if any(start < b and stop > a for a, b in placed):
                continue
            placed.append((start, stop))
            line = text.count("\n", 0, start)
            if (line, name) not in best or rest[0] > best[line, name][2]:
                best[line, name] = (line, name, *rest)
        return count, sorted(best.values())


_HITS = "array<struct<line:long,licence:string,saving:double,missing:long,extra:long>>"


def scan(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_blocks (candidates) and ``hits`` of every row."""
    bound(docs.sparkSession)
    plain = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    names = ["line", "licence", "saving", "missing", "extra"]
    kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
    hit = pa.list_(pa.struct(list(zip(names, kinds, strict=True))))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for part in parts:
            ids, texts = part.columns[0], part.columns[1].to_pylist()
            for a, b in slices([len(t or "") for t in texts]):
                found = [scanner.scan(t) for t in texts[a:b]]
                hits = [[dict(zip(names, h, strict=True)) for h in hs] for _, hs in found]
                columns = [ids.slice(a, b - a), pa.array([n for n, _ in found], pa.int64()), pa.array(hits, hit)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_blocks", "hits"])

    return plain.mapInArrow(run, f"doc_id long, n_blocks long, hits {_HITS}")
