"""License scans by conditional compression.

Candidates are windows of words around each wording that speaks of licensing, one for each class of template
lengths. A window is compressed by itself and once more with each template as the compressor's raw
dictionary. The bytes a template saves, as a share of what it saves on its own wording, rank the templates; only
those with ``LEAST_SAVED`` or more go on.

Winners are confirmed by their wording: the words that differ, inside the part the template covers, must be
few, and none of them may be one that decides which license it is or whether there is one: numbers of versions, names
of licences and of their kinds, and negations, those just before the notice included. No difference at all means
the exact wording. A text's lines and their lengths don't matter, and one place can hold several notices.
Blocks of lines without a confirmed notice tell the nearest template with its differences.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import Remembered

_GNU = (
    "This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public License "
    "as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
    "in the documentation and/or other materials provided with the distribution."
)
# Wording that licences ask for in notices, by SPDX identifier.
TEMPLATES = {
    "AGPL-3.0 header": _GNU.format(what="program", kind="Affero General", version="3"),
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "BSD-2-Clause": _BSD,
    "BSD-3-Clause": _BSD
    + " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-4.0 short": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-4.0 long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-SA-3.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-SA-4.0 long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-2.0 header": _GNU.format(what="program", kind="General", version="2"),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": _GNU.format(what="program", kind="General", version="3"),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "LGPL-2.1 header": _GNU.format(what="library", kind="Lesser General", version="2.1"),
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0 header": _GNU.format(what="library", kind="Lesser General", version="3"),
    "MIT": "Released under the MIT License.",
    "MIT text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Zlib": (
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
        "subject to the following restrictions: The origin of this software must not be misrepresented; you must not claim that you wrote the original software."
    ),
}
# Identifiers that source files give in a tag.
TAGS = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0",
    "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later",
    "MIT", "MPL-2.0", "Unlicense", "Zlib",
)
TEMPLATES |= {f"{t} tag": f"SPDX-License-Identifier: {t}" for t in TAGS}
# Words that tell one license from another, whatever else a notice says.
NAMES = frozenset(
    "affero apache attribution boost bsd by cc cc0 commercial commons creative domain eclipse general gnu isc lesser library mit mozilla mpl nc nd noderivatives "
    "noncommercial public sa sharealike unencumbered unported".split()
)
# Words that turn a notice round.
NEGATIONS = frozenset("aren cannot except excluding isn neither never no nor not unlike wasn weren without".split())
#: A negation so many words before a notice, in its sentence, speaks of it.
BEFORE = 6
# Lower-case wording that makes a line a candidate.
SIGNS = ("license", "licence", "licensing", "copyright", "spdx-", "permission is hereby", "permission is granted", "permission to use", "redistribution", "creative commons", "public domain", "free software")

#: Lines longer than this are cut at a sentence's or word's end; blocks grow to at most BLOCK_CHARS.
LINE_CHARS, BLOCK_CHARS = 1_000, 8_000
#: Lines without a sign that may stand between two that have one, in one block.
GAP = 2
LEVEL = 19
#: Share of a template's words that may be missing or changed, and of words added between.
TOLERANCE = 0.15
#: Share of the bytes a template saves on its own wording that it must save on a window.
LEAST_SAVED = 0.4
#: Bytes in which a task remembers what templates save on windows, and the longest window it remembers.
REMEMBERED, LONGEST = 32 << 20, 4_000
_WORD = re.compile(r"[^\W_]+(?:[.\-/][^\W_]+)*")
#: Between two words, the end of a sentence or of a paragraph.
_STOP = re.compile(r"[.!?;:]|\n\s*\n")
#: Signs in words joined by spaces, and in lower-cased text, over line ends and punctuation.
_SIGN = re.compile("|".join(map(re.escape, SIGNS)))
_SIGN_IN_TEXT = re.compile("|".join(r"[\W_]+".join(map(re.escape, s.split())) for s in SIGNS))


@dataclass(frozen=True)
class Finding:
    template: str
    saved: float
    confirmed: bool
    missing: tuple[str, ...]
    added: tuple[str, ...]

    @property
    def exact(self) -> bool:
        return self.confirmed and not self.missing and not self.added


def words(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def decides(word: str) -> bool:
    """Does it matter which license this is, or whether there is one, if this word is other?"""
    return any(c.isdigit() for c in word) or word in NEGATIONS or any(part in NAMES for part in word.split("-"))


def _lines(text: str) -> Iterator[tuple[int, int]]:
    """Ranges of the lines; a very long one in parts that end where a sentence or at least a word does."""
    at = 0
    for line in text.splitlines(keepends=True):
        end = at + len(line)
        while end - at > LINE_CHARS:
            cut = max(text.rfind(". ", at, at + LINE_CHARS), text.rfind(".\t", at, at + LINE_CHARS)) + 1
            cut = cut if cut > at else text.rfind(" ", at + 1, at + LINE_CHARS) + 1
            cut = cut if cut > at else at + LINE_CHARS
            yield at, cut
            at = cut
        yield at, end
        at = end


def blocks(text: str) -> list[tuple[int, int]]:
    """Ranges of the candidate blocks: lines with a sign, joined over short gaps."""
    low = text.lower()
    if not any(s in low for s in SIGNS):
        return []
    found, gap = [], 0
    for a, b in _lines(text):
        line = text[a:b].lower()
        if any(s in line for s in SIGNS):
            if found and gap <= GAP and b - found[-1][0] <= BLOCK_CHARS:
                found[-1] = (found[-1][0], b)
            else:
                found.append((a, b))
            gap = 0
        else:
            gap += 1
    return found


class Scanner:
    """Templates as dictionaries, in classes of like length."""

    def __init__(self, templates: dict[str, str]):
        self.words = {k: words(t) for k, t in templates.items()}
        self.plain = self._compressor(None)
        self.by_template, self.most = {}, {}
        for k, own in self.words.items():
            data = " ".join(own).encode()
            self.by_template[k] = self._compressor(zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
            self.most[k] = max(1, len(self.plain.compress(data)) - len(self.by_template[k].compress(data)))
        # Words on each side of a sign, to the templates of up to that length.
        self.classes: dict[int, list[str]] = {}
        for k, own in self.words.items():
            self.classes.setdefault(int((1 + TOLERANCE) * 2 ** max(3, (len(own) - 1).bit_length())) + 1, []).append(k)
        self.known = Remembered(REMEMBERED, LONGEST)

    @staticmethod
    def _compressor(content) -> zstandard.ZstdCompressor:
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=content, write_content_size=False, write_dict_id=False)

    def ranked(self, own: list[str], templates: list[str] | None = None) -> list[tuple[str, float]]:
        """Templates with the bytes each saves on the words, as a share of what it saves on its own, largest first."""
        data = " ".join(own).encode()
        alone = len(self.plain.compress(data))
        shares = {k: (alone - len(self.by_template[k].compress(data))) / self.most[k] for k in templates or self.words}
        return sorted(shares.items(), key=lambda x: (-x[1], x[0]))

    def winners(self, reach: int, window: list[str]) -> list[tuple[str, float]]:
        """The templates of a class that save enough on the window, in rank order."""
        key = f"{reach} {' '.join(window)}"
        found = self.known.get(key) or self.known.recall(key)
        if found is None:
            found = [(k, share) for k, share in self.ranked(window, self.classes[reach]) if share >= LEAST_SAVED]
            self.known.keep(key, found)
        return found

    def aligned(self, template: str, own: list[str]) -> tuple[bool, tuple[str, ...], tuple[str, ...], int, int]:
        """(near enough, template words not found, words between found ones that it lacks, first and last + 1 of the words covered)."""
        wanted = self.words[template]
        matches = [m for m in SequenceMatcher(None, wanted, own, autojunk=False).get_matching_blocks() if m.size]
        if not matches:
            return False, tuple(wanted), (), 0, 0
        limit, best = TOLERANCE * len(wanted), None
        for x in range(len(matches)):  # words far from the rest that match by chance are left out
            found = 0
            for y in range(x, len(matches)):
                found += matches[y].size
                missing, added = len(wanted) - found, matches[y].b + matches[y].size - matches[x].b - found
                cost = (missing > limit or added > limit, missing + added, missing, x, y)
                best = cost if best is None else min(best, cost)
        far, _, _, x, y = best
        first, last = matches[x], matches[y]
        missing, added, i, j = [], [], 0, first.b
        for m in matches[x : y + 1]:
            missing += wanted[i : m.a]
            added += own[j : m.b]
            i, j = m.a + m.size, m.b + m.size
        return not far, tuple(missing + wanted[i:]), tuple(added), first.b, last.b + last.size

    def compare(self, template: str, own: list[str]) -> tuple[bool, tuple[str, ...], tuple[str, ...]]:
        return self.aligned(template, own)[:3]

    def notices(self, own: list[str], stops: frozenset[int] = frozenset()) -> list[tuple[int, int, Finding]]:
        """Every confirmed notice among the words, with its first and last + 1 word, but those inside a longer one.

        ``stops`` are places of words that begin a sentence.
        """
        starts, at = [], 0
        for w in own:
            starts.append(at)
            at += len(w) + 1
        signs = sorted({bisect_right(starts, m.start()) - 1 for m in _SIGN.finditer(" ".join(own))})
        met, ends = [], dict.fromkeys(self.words, 0)
        for reach in self.classes:
            for p in signs:
                window = own[max(0, p - reach) : p + reach + 1]
                for template, share in self.winners(reach, window):
                    end, size = ends[template], len(self.words[template])
                    if p < end:
                        continue
                    low = max(end, p - reach)
                    near, missing, added, x, y = self.aligned(template, own[low : p + reach + 1])
                    if near and missing:  # the window may end within the notice
                        wide = max(end, low + x - size)
                        again = self.aligned(template, own[wide : low + y + size])
                        if again[0] and len(again[1]) + len(again[2]) < len(missing) + len(added):
                            low, (_, missing, added, x, y) = wide, again
                    if near and self.decided(own, low + x, missing, added, stops):
                        met.append((low + x, low + y, template, share, missing, added))
                        ends[template] = low + y
        kept = []
        for x, y, template, share, missing, added in sorted(met, key=lambda n: (n[0] - n[1], len(n[4]) + len(n[5]), -n[3])):
            if not any(a <= x and y <= b for a, b, _ in kept):
                kept.append((x, y, Finding(template, share, True, missing, added)))
        return sorted(kept, key=lambda n: n[:2])

    @staticmethod
    def decided(own: list[str], first: int, missing: tuple[str, ...], added: tuple[str, ...], stops: frozenset[int]) -> bool:
        """Is no word that decides missing or added, and none before the notice turns it round?"""
        if any(map(decides, (*missing, *added))):
            return False
        for k in range(first, max(0, first - BEFORE), -1):
            if k in stops:
                break
            if own[k - 1] in NEGATIONS:
                return False
        return True

    def __call__(self, block: str) -> Finding | None:
        """The confirmed notice with fewest differing words, else the template that ranks first, else None."""
        own = words(block)
        if not own:
            return None
        # The longest of equally good wordings: a notice's short form also stands in the long one.
        order = lambda f: (not f.confirmed, len(f.missing) + len(f.added), -len(self.words[f.template]), -f.saved)
        found = [f for _, _, f in self.notices(own)]
        return min(found or [Finding(k, share, False, *self.compare(k, own)[1:]) for k, share in self.ranked(own) if share >= LEAST_SAVED], key=order, default=None)

    def document(self, text: str) -> tuple[int, list[tuple[int, int, Finding]]]:
        """Number of blocks, and findings by place: confirmed notices, and the nearest template of each block that meets none."""
        if not _SIGN_IN_TEXT.search(text.lower()):
            return 0, []
        places = list(_WORD.finditer(text))
        stops = frozenset(k for k, (m, n) in enumerate(zip(places, places[1:], strict=False), 1) if _STOP.search(text, m.end(), n.start()))
        met = [(places[x].start(), places[y - 1].end(), f) for x, y, f in self.notices([m[0].lower() for m in places], stops)]
        spans = blocks(text)
        other = [(a, b, f) for a, b in spans if not any(x < b and a < y for x, y, _ in met) and (f := self(text[a:b]))]
        return len(spans), sorted(met + other, key=lambda n: n[:2])


SCHEMA = (
    "doc_id long, n_blocks int, license string, n_confirmed int, "
    "findings array<struct<start: int, end: int, template: string, saved: double, confirmed: boolean, exact: boolean, differences: string>>"
)


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """A row for each document with what its blocks say.

    Null and empty texts have no block. ``license`` is the template of the best confirmed notice, the
    first one of equals, or null. Differences are JSON: the template's words that are missing and words
    that stand between its words. Repeated rows are scanned each; a null id is handed through; other
    columns are ignored; an empty table gives no rows.

    Returns doc_id, n_blocks, license, n_confirmed, findings (start, end, template, saved, confirmed,
    exact, differences of each confirmed notice, and of each block without one on which some template saves enough).
    """
    known = dict(TEMPLATES if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(known)
        kinds = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("template", pa.string()), ("saved", pa.float64()), ("confirmed", pa.bool_()), ("exact", pa.bool_()), ("differences", pa.string())])
        for batch in batches:
            counts, licenses, confirmed, findings = [], [], [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                n_blocks, met = scanner.document(text)
                good = [f for _, _, f in met if f.confirmed]
                best = min(good, key=lambda f: len(f.missing) + len(f.added), default=None)
                counts.append(n_blocks)
                licenses.append(best.template if best else None)
                confirmed.append(len(good))
                findings.append([
                    {"start": a, "end": b, "template": f.template, "saved": f.saved, "confirmed": f.confirmed, "exact": f.exact, "differences": json.dumps({"missing": f.missing, "added": f.added}, ensure_ascii=False)}
                    for a, b, f in met
                ])
            columns = [batch.column("doc_id"), pa.array(counts, pa.int32()), pa.array(licenses, pa.string()), pa.array(confirmed, pa.int32()), pa.array(findings, pa.list_(kinds))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_blocks", "license", "n_confirmed", "findings"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
