"""Licence notices by conditional compression, confirmed word by word.

Cue words (licence, copyright, permission, warranty, ...) show where to look: the words around a cue, on each side as many as
the longest notice may have, are a region; regions that meet are one. Line ends, list marks and punctuation do not limit it. The words
of each region, in lower case, are compressed with those of each template as a raw zstandard dictionary; the share of the bytes
that the template saves ranks the templates, of equal ones the longest first. Ranking only orders: no template is left out. In
that order a template wins wherever its wording is in the region: template and words are aligned, and the missing and the added
words are counted. Short notices must be complete; a text of ``LONG`` words or more may miss one word in ten and have one in ten
added between its words, but never a word that tells licences apart. Such a text shares a run of a few words with its template,
so the places of these runs are aligned, each in a window of the length of the template. Templates whose wording lies inside a
winner's, at the same place, are not named besides it.

Compression ranks; the wording decides. Sentences and lines that hold a cue and at most ``GAP`` others between two of them, with
the one after the last, form a block. A block that no confirmed notice touches is reported as ``unknown`` when it holds a word
for licence or an SPDX tag, and not at all otherwise.

A map over whole texts: nothing is shuffled. Null text counts as empty. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import Match, SequenceMatcher
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .blocks import add_columns

GAP = 2
LONG = 20
LEVEL = 3
CUES = (
    "licen", "copyright", "rights reserved", "spdx", "permission", "hereby granted", "warrant", "merchantab", "redistribut",
    "public domain", "creative commons", "cc by", "cc-by", "cc0", "liabilit", "without restriction", "above notice", "gnu ",
)
#: The words of a cue may stand on two lines.
CUE = re.compile("|".join(re.escape(c).replace("\\ ", r"\s+") for c in CUES))
NAMED = re.compile(r"licen[cs]|spdx", re.I)
UNIT = re.compile(r"[^\n.!?]+(?:[.!?](?![\s]|$)[^\n.!?]*)*[.!?]*|[.!?]+")
WORD = re.compile(r"\w+(?:[.+-]\w+)*")

#: Public licence texts and notices. id, wording, words that tell it from its relatives.
TEMPLATES = [
    ("MIT", "Released under the MIT License", "mit"),
    ("MIT", "Licensed under the MIT License", "mit"),
    ("MIT", "SPDX-License-Identifier: MIT", "mit"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.", "sublicense sell"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", "fee"),
    ("ISC", "SPDX-License-Identifier: ISC", "isc"),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.", "redistributions binary"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.", "neither endorse promote"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0", "apache 2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0", "apache-2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http www.apache.org licenses LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.", "apache 2.0"),
    ("GPL-2.0", "licensed under the GNU General Public License, version 2", "general version 2"),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "general 2 later"),
    ("GPL-3.0", "licensed under the GNU General Public License, version 3", "general version 3"),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "general 3 later"),
    ("LGPL-3.0", "licensed under the GNU Lesser General Public License, version 3", "lesser version 3"),
    ("AGPL-3.0", "licensed under the GNU Affero General Public License, version 3", "affero version 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla 2.0"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0", "by 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0", "by-sa 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0", "by-nc 4.0"),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0", "by-nd 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", "attribution 4.0"),
    ("CC0-1.0", "CC0 1.0 Universal Public Domain Dedication", "cc0 1.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain.", "unencumbered"),
    ("All-rights-reserved", "All rights reserved", "reserved"),
]


@dataclass(frozen=True)
class Template:
    name: str
    words: tuple[str, ...]
    telling: frozenset[str]
    coder: zstandard.ZstdCompressor
    #: Places of its runs of words that are so long that any accepted text has one.
    runs: dict[tuple[str, ...], list[int]]


def words_of(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


@lru_cache(maxsize=1)
def templates() -> list[Template]:
    out = []
    for name, wording, telling in TEMPLATES:
        raw = zstandard.ZstdCompressionDict(" ".join(words_of(wording)).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        coder = zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False)
        words = tuple(words_of(wording))
        # At least n - spare words match, in pieces that missing or added words part.
        spare = len(words) // 10
        size = -(-(len(words) - spare) // (2 * spare + 1))
        runs: dict[tuple[str, ...], list[int]] = {}
        for i in range(len(words) - size + 1):
            runs.setdefault(words[i : i + size], []).append(i)
        out.append(Template(name, words, frozenset(telling.split()), coder, runs))
    return out


@lru_cache(maxsize=1)
def _plain() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)


def lowered(text: str) -> str:
    """Lower case at the same positions: a letter whose lower case is longer stays."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def cues_of(text: str) -> list[int]:
    """Where the cues of a text begin."""
    low = lowered(text)
    flat = " ".join(low.split()) + " "
    return [m.start() for m in CUE.finditer(low)] if any(cue in flat for cue in CUES) else []


def blocks(text: str, cues: list[int]) -> Iterator[tuple[int, int]]:
    """Start and end of each run of sentences and lines with cues."""
    start, end, gap, i = None, 0, 0, 0
    for unit in UNIT.finditer(text):
        a, b = unit.span()
        seen, i = i, bisect_left(cues, b)
        if i > seen:
            start = a if start is None else start
            end, gap = b, 0
        elif start is not None:
            gap += 1
            if gap == 1:
                end = b
            if gap > GAP:
                yield start, end
                start = None
    if start is not None:
        yield start, end


def regions(starts: list[int], cues: list[int], reach: int) -> Iterator[tuple[int, int]]:
    """First word and last word + 1 of each region around the cues."""
    first, last = None, 0
    for cue in cues:
        at = max(bisect_right(starts, cue) - 1, 0)
        if first is not None and at - reach > last:
            yield first, last
            first = None
        first = max(at - reach, 0) if first is None else first
        last = min(at + reach + 1, len(starts))
    if first is not None:
        yield first, last


def ranking(words: list[str]) -> list[tuple[float, Template]]:
    """All templates by the share of the bytes of these words that they save, best first."""
    data = " ".join(words).encode()
    size = len(_plain().compress(data))
    saved = [((size - len(t.coder.compress(data))) / size, -len(t.words), i, t) for i, t in enumerate(templates())]
    return [(share, t) for share, _, _, t in sorted(saved, key=lambda x: (-x[0], x[1], x[2]))]


def fitting(template: Template, parts: list[Match]) -> tuple[int, int, int, int] | None:
    """(first word, last word + 1, missing, added) of the most complete run of matching pieces that is close enough to the template.

    The outer pieces may be words of the surroundings.
    """
    n, spare = len(template.words), len(template.words) // 10
    total = list(accumulate((m.size for m in parts), initial=0))
    runs = []
    for p, head in enumerate(parts):
        for q in range(p, len(parts)):
            same, last = total[q + 1] - total[p], parts[q].a + parts[q].size
            missing, added = n - same, last - head.a - same
            if missing <= spare and added <= spare:
                runs.append((missing, added, p, q))
    for missing, added, p, q in sorted(runs):
        if template.telling <= {w for m in parts[p : q + 1] for w in template.words[m.b : m.b + m.size]}:
            return parts[p].a, parts[q].a + parts[q].size, missing, added
    return None


def wording(template: Template, words: list[str]) -> list[tuple[int, int, int, int]]:
    """(first word, last word + 1, missing, added) of the template's places among the words; none where it differs too much."""
    n = len(template.words)
    if not template.telling <= set(words):
        return []
    if n < LONG:
        # A short notice stands in one piece, and may stand there more than once.
        head = template.words[0]
        return [(i, i + n, 0, 0) for i, w in enumerate(words) if w == head and tuple(words[i : i + n]) == template.words]
    spare = n // 10
    runs = template.runs
    size = len(next(iter(runs)))
    matcher = SequenceMatcher(autojunk=False)
    matcher.set_seq2(template.words)
    out: list[tuple[int, int, int, int]] = []
    tried: set[int] = set()
    done = 0
    for i in range(len(words) - size + 1):
        for j in runs.get(tuple(words[i : i + size]), ()):
            # Of a place that holds this run; a place begins and ends in its window.
            if i < done or i - j in tried:
                continue
            tried.add(i - j)
            begin = max(i - j - spare, done)
            matcher.set_seq1(words[begin : i - j + n + spare])
            parts = [m for m in matcher.get_matching_blocks() if m.size]
            hit = fitting(template, parts)
            if hit:
                done = begin + hit[1]
                out.append((begin + hit[0], done, *hit[2:]))
    return out


def scan(text: str) -> list[tuple[str, int, int, float, int, int]]:
    """(licence, start, end, share saved, missing, added) of every confirmed notice, in order of start."""
    cues = cues_of(text)
    if not cues:
        return []
    out = []
    places = [m.span() for m in WORD.finditer(text)]
    reach = max(len(t.words) + len(t.words) // 10 for t in templates())
    for a, b in regions([x for x, _ in places], cues, reach):
        words = [text[x:y].lower() for x, y in places[a:b]]
        won: list[tuple[int, int]] = []
        for share, template in ranking(words):
            for hit in wording(template, words):
                if not any(x < hit[1] and hit[0] < y for x, y in won):
                    won.append(hit[:2])
                    out.append((template.name, places[a + hit[0]][0], places[a + hit[1] - 1][1], share, hit[2], hit[3]))
    named = [x[1:3] for x in out]
    for a, b in blocks(text, cues):
        if NAMED.search(text, a, b) and not any(x < b and a < y for x, y in named):
            out.append(("unknown", a, b, 0.0, 0, 0))
    return sorted(out, key=lambda x: (x[1], x[2], x[0]))


def find(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """All columns of ``docs``; the number of notices, the licences named, and the notices as licence:start:end:missing:added."""

    def run(texts: list[str]):
        found = [scan(t) for t in texts]
        return [
            pa.array([len(f) for f in found], pa.int64()),
            pa.array([",".join(sorted({x[0] for x in f})) for f in found], pa.string()),
            pa.array([",".join(f"{x[0]}:{x[1]}:{x[2]}:{x[4]}:{x[5]}" for x in f) for f in found], pa.string()),
        ]

    return add_columns(docs, text, "n_notices bigint, licences string, notices string", run)
