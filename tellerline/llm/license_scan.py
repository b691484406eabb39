"""License scans by conditional compression.

A text is read as its words, in overlapping blocks. A block in which most words of some template occur, in whatever
order, is a candidate: it is compressed alone and with each such template as a raw zstandard dictionary. The templates
are ranked by the size reduction and held against
the block word by word, in that order: the words that would have to be left out, added or
changed are listed, and a passage is confirmed only if they are few, none of them is
a word that tells licenses apart, and the template saves bytes of the passage itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

#: The customary wordings by which a text names its license, and the paragraphs of short licenses.
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "either version 3 of the License, or (at your option) any later version.",
    ),
    "gpl-2.0": ("This work is licensed under the GNU General Public License, version 2.",),
    "lgpl-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "lgpl-2.1": ("This work is licensed under the GNU Lesser General Public License, version 2.1.",),
    "agpl-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.",),
    "mpl-2.0": (
        "This work is licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "cc-by-nc-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "cc-by-sa-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
        "this software without specific prior written permission.",
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
        "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        "the above copyright notice and this permission notice appear in all copies.",
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.',
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
    ),
    "unlicense": ("This is free and unencumbered software released into the public domain.",),
}
#: Identifiers that stand behind the customary tag, on lines that must be exact.
SPDX_TAG = "SPDX-License-Identifier:"
SPDX = (
    "Apache-2.0 MIT GPL-3.0-only GPL-3.0-or-later GPL-2.0-only GPL-2.0-or-later LGPL-3.0-only LGPL-3.0-or-later LGPL-2.1-only LGPL-2.1-or-later "
    "AGPL-3.0-only AGPL-3.0-or-later MPL-2.0 BSD-2-Clause BSD-3-Clause ISC Zlib Unlicense BSL-1.0 CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 EPL-2.0"
).split()
#: Words that tell one license from another; numbers always do.
TELLING = frozenset(
    "apache mit gnu gpl lesser affero general public bsd mozilla cc by sa nc nd zero no not non attribution sharealike noncommercial noderivatives noderivs".split()
)
#: Comment marks that are words; at line starts they are none of the text's.
MARKS = frozenset(("rem", "dnl"))
WORD = re.compile(r"[0-9]+(?:\.[0-9]+)*|[^\W\d_]+")
WORD_MARK = re.compile(r"(?im)^[^\S\n]*(?:rem|dnl)\b")
#: The share of a template's words that may differ.
SLACK = 0.2
#: Words of a block; blocks overlap by the longest passage.
BLOCK_WORDS = 400
#: The same search for matches with a dictionary and without one, or sizes could not be compared.
COMPRESSION = zstandard.ZstdCompressionParameters(
    window_log=18, chain_log=16, hash_log=16, search_log=4, min_match=4, target_length=64, strategy=zstandard.STRATEGY_LAZY2, write_dict_id=0
)

FOUND = "doc_id long, license string, template int, start long, end long, saved int, differences array<string>"


@dataclass(frozen=True)
class Template:
    license: str
    number: int
    words: list[str]
    compressor: zstandard.ZstdCompressor
    exact: bool = False

    @property
    def slack(self) -> int:
        return 0 if self.exact else int(SLACK * len(self.words))

    def could_be_in(self, known: set[str]) -> bool:
        """Whether enough of its words occur at all."""
        return sum(w in known for w in self.words) >= len(self.words) - self.slack


def compressor(words: list[str]) -> zstandard.ZstdCompressor:
    """With words as raw dictionary."""
    raw = zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    raw.precompute_compress(compression_params=COMPRESSION)
    return zstandard.ZstdCompressor(dict_data=raw, compression_params=COMPRESSION)


@dataclass(frozen=True)
class Licenses:
    templates: list[Template]
    plain: zstandard.ZstdCompressor

    @property
    def reach(self) -> int:
        return max(len(t.words) + t.slack for t in self.templates)


def licenses() -> Licenses:
    found = [(name, k, WORD.findall(text.lower()), False) for name, texts in TEMPLATES.items() for k, text in enumerate(texts)]
    found += [(name.lower(), -1, WORD.findall(f"{SPDX_TAG} {name}".lower()), True) for name in SPDX]
    known = [Template(name, k, words, compressor(words), exact) for name, k, words, exact in found]
    return Licenses(known, zstandard.ZstdCompressor(compression_params=COMPRESSION))


def differences(template: list[str], words: list[str]) -> tuple[list[str], int, int]:
    """Wording differences (``-`` left out, ``+`` added) and the span of words with the fewest, none of them telling if that can be."""
    blocks = [b for b in SequenceMatcher(None, template, words, autojunk=False).get_matching_blocks() if b.size]
    best: tuple[tuple, list[str], int, int] | None = None
    for i, first in enumerate(blocks):
        out, a, b = [f"-{w}" for w in template[: first.a]], first.a, first.b
        for j, block in enumerate(blocks[i:], i):
            out += [f"-{w}" for w in template[a : block.a]] + [f"+{w}" for w in words[b : block.b]]
            a, b = block.a + block.size, block.b + block.size
            whole = [*out, *(f"-{w}" for w in template[a:])]
            rank = (any(map(is_telling, whole)), len(whole), i, -j)
            if best is None or rank < best[0]:
                best = rank, whole, first.b, b
    return best[1:] if best else ([f"-{w}" for w in template], 0, 0)


def is_telling(difference: str) -> bool:
    return difference[1:] in TELLING or difference[1].isdigit()


def confirmed(template: Template, found: list[str]) -> bool:
    return len(found) <= template.slack and not any(map(is_telling, found))


def passages(template: Template, words: list[str]) -> Iterator[tuple[int, int, list[str]]]:
    """(first word, end, differences) of the passages that are the template but for few words.

    Such a passage has ``n - k`` words of the template in at most ``k + 1`` runs, so every run
    of at least ``(n - k) / (k + 1)`` words is tried, the longest first.
    """
    n, k = len(template.words), template.slack
    own, known = set(template.words), set(words)
    if sum(w in known for w in template.words) < n - k:
        return
    # Words that the template does not have, and words already tried, equal none of its words.
    rest: list[str | None] = [w if w in own else None for w in words]
    matcher = SequenceMatcher(None, autojunk=False)
    matcher.set_seq1(template.words)
    while True:
        matcher.set_seq2(rest.copy())  # it keeps what it found for an object it knows
        run = matcher.find_longest_match()
        if run.size * (k + 1) < n - k:
            return
        low, high = max(0, run.b - run.a - k), run.b + n - run.a + k
        found, first, last = differences(template.words, words[low:high])
        tried = (run.b, run.b + run.size)
        if last and confirmed(template, found):
            yield low + first, low + last, found
            tried = (min(tried[0], low + first), max(tried[1], low + last))
        rest[tried[0] : tried[1]] = [None] * (tried[1] - tried[0])


def is_mark(text: str, start: int, end: int) -> bool:
    """Whether a word that may be a comment mark is one: first in its line, and no part of a name."""
    if end < len(text) and (text[end].isalnum() or text[end] == "_"):
        return False
    while start and text[start - 1].isspace() and text[start - 1] != "\n":
        start -= 1
    return start == 0 or text[start - 1] == "\n"


def blocks(text: str, size: int, overlap: int) -> Iterator[tuple[int, list[int], list[str]]]:
    """(number of the first word, starts, words) of blocks of ``size`` words in lower case, each but the first beginning ``overlap`` words back."""
    first, starts, words = 0, [], []
    for m in WORD.finditer(text):
        word = m.group().lower()
        if word in MARKS and is_mark(text, m.start(), m.end()):
            continue
        starts.append(m.start())
        words.append(word)
        if len(words) == size:
            yield first, starts, words
            first, starts, words = first + size - overlap, starts[size - overlap :], words[size - overlap :]
    if len(words) > (overlap if first else 0):
        yield first, starts, words


def ranked(words: list[str], known: Licenses) -> list[Template]:
    """The templates that a block could hold, those that save most of it first."""
    there = set(words)
    likely = [k for k, t in enumerate(known.templates) if t.could_be_in(there)]
    if not likely:
        return []
    raw = " ".join(words).encode()
    alone = len(known.plain.compress(raw))
    gains = [(len(known.templates[k].compressor.compress(raw)) - alone, k) for k in likely]
    return [known.templates[k] for _, k in sorted(gains)]


def scan_text(text: str, known: Licenses) -> list[tuple]:
    """(license, template, start, end, saved, differences) of each license's passages, of overlapping ones that with the most words."""
    size = max(BLOCK_WORDS, 2 * known.reach)
    hits: dict[tuple[str, int, int, int], tuple] = {}
    for base, starts, words in blocks(text, size, known.reach):
        for template in ranked(words, known):
            for first, last, found in passages(template, words):
                start, end = starts[first], starts[last - 1] + len(WORD.match(text, starts[last - 1]).group())
                if template.exact and re.match(r"[-.+\w]*[\w+]", text[end:]):  # a longer identifier
                    continue
                raw = " ".join(words[first:last]).encode()
                saved = len(known.plain.compress(raw)) - len(template.compressor.compress(raw))
                if saved <= 0:
                    continue
                covers = len(template.words) - sum(d[0] == "-" for d in found)
                hits[template.license, template.number, base + first, base + last] = (covers, start, end, saved, found)
    out: list[tuple] = []
    taken: dict[str, list[tuple[int, int]]] = {}
    for (name, number, first, last), (_, start, end, saved, found) in sorted(hits.items(), key=lambda x: (-x[1][0], len(x[1][4]), x[0])):
        spans = taken.setdefault(name, [])
        if all(last <= a or b <= first for a, b in spans):
            spans.append((first, last))
            out.append((name, number, start, end, saved, found))
    return sorted(out, key=lambda x: x[2:4])


def scanned(docs: DataFrame) -> DataFrame:
    """One row per passage that names a license: ``doc_id, license, template, start, end, saved, differences``.

    ``start`` and ``end`` are characters of the text from the first to the last matching
    word, ``saved`` the bytes that the template saves of the passage's words, ``differences`` the wording that departs
    from it; ``template`` is -1 for an identifier behind its tag. A passage may run over lines, behind comment marks. Null and empty texts have none; equal
    rows are each reported; an empty table gives no rows; other columns are not read. A text is read whole, however long, in blocks of words: memory
    beyond the text itself does not grow with it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = licenses()
        for batch in batches:
            rows = [(row, *hit) for row, text in enumerate(batch["text"]) if text.is_valid for hit in scan_text(text.as_py(), known)]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            ids = batch["doc_id"].take(pa.array(columns[0], pa.int64()))
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.string()))
            rest = [pa.array(c, t) for c, t in zip(columns[1:], kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([ids, *rest], ["doc_id", "license", "template", "start", "end", "saved", "differences"])

    return docs.select("doc_id", "text").mapInArrow(run, FOUND)
