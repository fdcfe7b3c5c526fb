"""License scans by conditional compression.

A candidate block starts with the sentence in which a license word stands, at most twelve words before it, and
is as long as the longest template with some room. It is compressed with zstandard alone, and again with each template as raw
dictionary; the templates are ranked by how much smaller that makes the block. Winners are confirmed by
aligning the template's words with the block's: the differing words are listed, and only few are allowed,
none of them a number or a word that names another variant of the license (Affero, Lesser, ShareAlike). Of the
wordings of a license the longest that fits counts; the wording of another license that begins with the confirmed
one and goes on (a third clause) takes its place. Lines with an identifier have wordings of their own. Every license word of a whole text starts a block, unless it stands in a license that
has just been confirmed.

Defined results: null and empty texts have no blocks; repeated rows are judged one by one; ties of equal
reduction go by name; other columns are not read. One pass over the texts, nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from ebbtide.llm.words import pieces

# The customary wordings of license statements.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
        "by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "LGPL-2.1": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
        "by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published "
        "by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
        "file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-ND-4.0": ("Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "CC0-1.0": ("This work is dedicated to the public domain under CC0 1.0.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}

# Identifiers as they stand in source files; the older ones may name later versions too.
_VERSIONED = ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0")
SPDX = {name: (name, *([f"{name}-only", f"{name}-or-later"] if name in _VERSIONED else [])) for name in TEMPLATES}
# Words that tell one license from another, alone or as part of a word.
DECISIVE = frozenset("affero lesser library noderivatives noderivs sharealike noncommercial nc nd sa".split())

_TRIGGER = re.compile(r"(?i:licen[sc]ed?\b|\bpermission is\b|\bredistribut|\bpublic domain\b|\bfree software\b)")
_SENTENCE_END = re.compile(r"[.!?:;]\s+|\n")
_WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")
LEAD = 12  # words before a license word that a block can start with
ROOM = 1.25
LEAST_REDUCTION = 0.15
WRONG_PERCENT = 10  # differing words in a hundred
CACHE = 20_000


def words_of(text: str) -> list[tuple[str, int, int]]:
    return [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text)]


def decides(word: str) -> bool:
    """Whether a difference in this word makes another license: numbers, and words that name a variant."""
    return any(c.isdigit() for c in word) or not DECISIVE.isdisjoint(re.split(r"[.\-]", word))


@dataclass
class Found:
    license: str
    reduction: float
    end: int  # of the wording, in the block
    missing: list[str]
    added: list[str]


def wording_differences(template: list[str], block: list[str]) -> tuple[int, list[str], list[str], int]:
    """Least differences of the template from a stretch of the block: (count, missing, added, words of the block used up).

    Words before and after the stretch are free. Differences are a missing word, an added one, or both.
    """
    n, m = len(template), len(block)
    cost = [[0] * (m + 1)]
    for i in range(1, n + 1):
        row, above, word = [i] + [0] * m, cost[-1], template[i - 1]
        for j in range(1, m + 1):
            row[j] = min(above[j - 1] + (0 if word == block[j - 1] else 1), above[j] + 1, row[j - 1] + 1)
        cost.append(row)
    j = min(range(m + 1), key=lambda x: (cost[n][x], x))
    total, used, i, missing, added = cost[n][j], j, n, [], []
    while i:
        if j and cost[i][j] == cost[i - 1][j - 1] + (template[i - 1] != block[j - 1]):
            if template[i - 1] != block[j - 1]:
                missing.append(template[i - 1])
                added.append(block[j - 1])
            i, j = i - 1, j - 1
        elif cost[i][j] == cost[i - 1][j] + 1:
            missing.append(template[i - 1])
            i -= 1
        else:
            added.append(block[j - 1])
            j -= 1
    return total, missing[::-1], added[::-1], used


class Scanner:
    def __init__(self, templates: dict[str, tuple[str, ...]] = TEMPLATES, level: int = 3):
        self.plain = zstandard.ZstdCompressor(level=level, write_content_size=False, write_checksum=False)
        self.templates = []
        for name, wordings in sorted(templates.items()):
            for wording in [*wordings, *[f"SPDX-License-Identifier: {i}" for i in SPDX.get(name, ())]]:
                content = zstandard.ZstdCompressionDict(wording.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                packer = zstandard.ZstdCompressor(level=level, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False)
                self.templates.append((name, packer, [w for w, _, _ in words_of(wording)]))
        self.longest = int(max(len(w) for _, _, w in self.templates) * ROOM) + LEAD
        self.known: dict[tuple[str, int], Found | None] = {}

    def rank(self, block: str, lead: int = 0) -> list[tuple[float, str, list[str]]]:
        """(reduction, license, words of the wording), best first. Each wording is given a stretch of its own length after the lead."""
        spots, out = words_of(block), []
        packed: dict[int, tuple[bytes, int]] = {}
        for name, packer, words in self.templates:
            upto = min(len(spots), int(len(words) * ROOM) + 2 + lead)
            if upto not in packed:
                raw = block[: spots[upto - 1][2] if upto else 0].encode()
                packed[upto] = raw, len(self.plain.compress(raw))
            raw, alone = packed[upto]
            out.append((1 - len(packer.compress(raw)) / alone, name, words))
        return sorted(out, key=lambda x: (-x[0], x[1], -len(x[2])))

    def confirm(self, block: str, lead: int = 0) -> Found | None:
        """The best-ranked license whose wording the block really has; of its wordings, and of those that go on where one of it ends, the longest that fits."""
        if (block, lead) in self.known:
            return self.known[block, lead]
        spots, found, base = words_of(block), None, []
        for reduction, name, words in self.rank(block, lead):
            if reduction < LEAST_REDUCTION:
                break
            if found and name != found.license and words[: len(base)] != base:
                continue
            have = [w for w, _, _ in spots[: int(len(words) * ROOM) + 4 + lead]]
            wrong, missing, added, used = wording_differences(words, have)
            if 100 * wrong <= WRONG_PERCENT * len(words) and not any(decides(w) for w in [*missing, *added]):
                if not found or spots[used - 1][2] > found.end:
                    base = words
                    found = Found(name, found.reduction if found else reduction, spots[used - 1][2], missing, added)
        if len(self.known) >= CACHE:
            self.known.clear()
        self.known[block, lead] = found
        return found

    def scan(self, text: str) -> tuple[int, list[Found]]:
        """Number of candidate blocks and the confirmed licenses of a whole text."""
        n, out, at = 0, [], 0
        while (hit := _TRIGGER.search(text, at)) is not None:
            back = max(at, hit.start() - 20 * LEAD)
            ends = [m.end() for m in _SENTENCE_END.finditer(text, back, hit.start())]
            before = [m.start() for m in _WORD.finditer(text, ends[-1] if ends else back, hit.start())][-LEAD:]
            begin = before[0] if before else hit.start()
            lead = 0 if ends and len(before) < LEAD else len(before)  # a block that starts with its sentence has none
            end = begin
            for k, spot in enumerate(_WORD.finditer(text, begin)):
                end = spot.end()
                if k + 1 >= self.longest:
                    break
            block = text[begin:end]
            n += 1
            found = self.confirm(block, lead)
            if found:
                out.append(found)
            at = max(hit.end(), begin + found.end) if found else hit.end()
        return n, out


REPORT = "doc_id long, n_blocks long, n_licenses long, licenses string, best_reduction double, differences string"


def report(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES) -> DataFrame:
    """Per document: candidate blocks, confirmed licenses (names, sorted), best reduction, and wording differences."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates)
        for batch in pieces(batches):
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                n, found = scanner.scan(text) if text else (0, [])
                names = sorted({f.license for f in found})
                changes = sorted({f"{f.license}: -{' '.join(f.missing)} +{' '.join(f.added)}" for f in found if f.missing or f.added})
                rows.append((doc, n, len(found), ",".join(names), max((round(f.reduction, 4) for f in found), default=None), "; ".join(changes)))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "n_blocks", "n_licenses", "licenses", "best_reduction", "differences"])

    return docs.select("doc_id", "text").mapInArrow(job, REPORT)
