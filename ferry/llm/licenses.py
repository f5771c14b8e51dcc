"""License scans by patience alignment.

A text's words are aligned with a license template: words that are unique in
both are anchors, their longest increasing subsequence is kept, and the gaps
between anchors are aligned in the same way (where a gap has no unique word,
its equal head and tail are matched). Coverage is the share of the template's
words that the alignment matches.

A template may stand anywhere in a long text, more than once, so alignments
are made on windows: words next to each other in a template are looked up in
the whole text, and wherever enough of a template's pairs stand in a stretch
of about its length, each start that one of them gives is tried, first with a
window of the template's length and then with wider ones. A hit needs
MIN_COVERAGE of the template, and hits do not overlap; of those that match the
same stretch the one with most matched words wins, less what words put in between
count. Templates of fewer than SHORT words may lack one word, and every hit
needs its license's telling words (name, version, variant; TELLING and
WHOLE_TELLING; a longer notice without any is open, OPEN). Licenses that match
a stretch equally well, and a notice that leaves it open, are named together:
BSD-2-Clause|BSD-3-Clause.

Defined cases: null or empty texts have no hits and are not listed. A license
that stands twice has two hits, also where the copies follow each other. Repeated rows are scanned alike. Doc ids may
be null. Extra columns are not read; an empty table has no hits. There is no
shuffle; the templates (notices, and the whole texts of ``license_texts``, 20,000
words) are read on the driver and travel with the tasks. The whole text of
AGPL-3.0 is not among them: it is found by its title and notice.
"""

from __future__ import annotations

import functools
import itertools
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, replace
from pathlib import Path
from zlib import crc32

from pyspark.sql import DataFrame, SparkSession

from ferry.llm.common import map_rows, table

MIN_COVERAGE = 0.75
# Share of a template's word pairs that a stretch must hold to be aligned. A
# changed word breaks two pairs, so a covered template has at least about half.
MIN_PAIRS = 0.4
# What a word put between matched ones takes from a run of them.
LOOSE = 0.25

# Templates of fewer words than this may lack one of them.
SHORT = 10
# Templates of at least so many words are whole texts. Of those of at least
# LONG, one in SAMPLE of the word pairs that stand once is looked up.
WHOLE = 90
LONG, SAMPLE = 1_000, 8

# Notices and permission texts of common public licenses. A name
# with | is what the notice leaves open.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in'
        " compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,"
        ' software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR'
        " CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing"
        " permissions and limitations under the License.",
    ),
    "MIT": (
        "Released under the MIT License.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and'
        ' associated documentation files (the "Software"), to deal in the Software without restriction,'
        " including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,"
        " and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,"
        " subject to the following conditions: The above copyright notice and this permission notice shall be"
        " included in all copies or substantial portions of the Software.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation, either version 3 of the License,"
        " or (at your option) any later version.",
    ),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.",),
    # the opening that both have; their whole texts tell them apart
    "BSD-2-Clause|BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met:",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the"
        " MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
}

# Notices that differ from those above by a name, a version or a variant.
NEIGHBOURS = {
    "Apache-1.1": ("Licensed under the Apache License, Version 1.1.",),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation; either version 2 of the License,"
        " or (at your option) any later version.",
    ),
    "LGPL-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU"
        " Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License,"
        " or (at your option) any later version.",
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " Lesser General Public License as published by the Free Software Foundation, either version 3 of the License,"
        " or (at your option) any later version.",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " Affero General Public License as published by the Free Software Foundation, either version 3 of the License,"
        " or (at your option) any later version.",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    ),
    "CC-BY-NC-4.0": ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",),
    "CC-BY-SA-4.0": ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",),
    "CC-BY-ND-4.0": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "CC-BY-NC-SA-4.0": (
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-ND-4.0": (
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
    ),
}

_GNU, _CC = r"\b(lesser|library general|affero)\b", r"\b(nc|nd|sa|non-?commercial|no-?deriv\w*|share-?alike|share|non)\b"
# What the matched stretch of a notice (its bare words, one space between) must
# hold, and what it must not: name, version and variant.
TELLING = {
    "Apache-2.0": (r"\bapache license (version |v )?v?2\.0|licenses/license-2\.0\b", ""),
    "Apache-1.1": (r"\bapache (software )?license (version |v )?v?1\.1", ""),
    "MIT": (r"\bmit license|\bfree of charge\b|\bpublish distribute sublicense\b", r"\bmit license v?\d"),
    "GPL-2.0": (r"\bv?2(\.0)?\b(?!\.)", _GNU),
    "GPL-3.0": (r"\bv?3(\.0)?\b(?!\.)", _GNU),
    "LGPL-2.1": (r"\blesser\b.*\bv?2\.1\b", r"\baffero\b"),
    "LGPL-3.0": (r"\blesser\b.*\bv?3(\.0)?\b(?!\.)", r"\baffero\b"),
    "AGPL-3.0": (r"\baffero\b.*\bv?3(\.0)?\b(?!\.)", r"\blesser\b"),
    "CC-BY-4.0": (r"\bcc by 4\.0\b|\battribution\b.*\b4\.0\b", _CC),
    "CC-BY-NC-4.0": (r"\bcc by-nc 4\.0\b|\battribution-noncommercial 4\.0\b", ""),
    "CC-BY-SA-4.0": (r"\bcc by-sa 4\.0\b|\battribution-sharealike 4\.0\b", ""),
    "CC-BY-ND-4.0": (r"\bcc by-nd 4\.0\b|\battribution-noderivatives 4\.0\b", ""),
    "CC-BY-NC-SA-4.0": (r"\bcc by-nc-sa 4\.0\b|\battribution-noncommercial-sharealike 4\.0\b", ""),
    "CC-BY-NC-ND-4.0": (r"\bcc by-nc-nd 4\.0\b|\battribution-noncommercial-noderivatives 4\.0\b", ""),
    "MPL-2.0": (r"\bmozilla public license (version |v )?v?2\.0|mozilla.org/mpl/2\.0", ""),
}
# A longer notice of these whose telling word is gone, with none of these in its
# place, is taken for each of the licenses it then matches alike.
_CC_OPEN = r"\battribution|\b(?!4\.0\b)\d\.\d\b"
OPEN = dict.fromkeys(("GPL-2.0", "GPL-3.0"), r"\bversion v?\d|\blicense v?\d") | {
    f"CC-BY{x}-4.0": _CC_OPEN for x in ("", "-NC", "-SA", "-ND", "-NC-SA", "-NC-ND")
}
# As TELLING, for whole texts: clauses that the neighbouring licenses have or lack.
WHOLE_TELLING = {
    "GPL-3.0": ("", r"\bremote network interaction\b"),
    "BSD-2-Clause": ("", r"\bendorse or promote\b"),
    "BSD-3-Clause": (r"\bendorse or promote\b", r"\badvertising materials\b"),
    "BSD-4-Clause": (r"\badvertising materials\b", ""),
    "MIT": (r"\bthis permission notice\b", ""),
    "MIT-0": ("", r"\bthis permission notice\b"),
    "ISC": (r"\bthis permission notice\b", ""),
    "0BSD": ("", r"\bthis permission notice\b"),
}


def all_templates() -> dict[str, tuple[str, ...]]:
    """TEMPLATES, after them the NEIGHBOURS, then the whole texts of ``license_texts``."""
    out = dict(TEMPLATES)
    for name, some in NEIGHBOURS.items():
        out[name] = out.get(name, ()) + some
    for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        out[path.stem] = (*out.get(path.stem, ()), path.read_text(encoding="utf-8"))
    return out


_EDGE = re.compile(r"^\W+|\W+$")


@functools.lru_cache(maxsize=400_000)
def _bare(word: str) -> str:
    return _EDGE.sub("", word.lower())


def words(text: str | None) -> list[str]:
    """Lower-case words without marks at their ends; words of marks only go."""
    return [b for b in map(_bare, (text or "").split()) if b]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched places (i in a, j in b), rising in both, by patience alignment."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        # equal heads and tails need no anchor
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        anchors = _increasing(_unique(a, b, a0, a1, b0, b1))
        if anchors:
            ends = [*anchors, (a1, b1)]
            x, y = a0, b0
            for i, j in ends:
                todo.append((x, i, y, j))
                x, y = i + 1, j + 1
            out += anchors
    return sorted(out)


def _unique(a, b, a0, a1, b0, b1) -> list[tuple[int, int]]:
    """Places of words that stand once in both ranges, by their place in a."""
    in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
    at = {w: j for j, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
    return [(i, at[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in at]


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs that rises in the second place too (patience sorting)."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        p = bisect_left(tops, j)
        back.append(piles[p - 1] if p else -1)
        if p == len(tops):
            tops.append(j)
            piles.append(k)
        else:
            tops[p], piles[p] = j, k
    out, k = [], piles[-1] if piles else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


@dataclass(frozen=True)
class Hit:
    license: str
    template: int
    start: int  # first and last matched word of the text
    end: int
    matched: int
    coverage: float

    @property
    def score(self) -> float:
        return self.matched - LOOSE * max(0, self.end - self.start + 1 - self.matched / self.coverage)


class Scanner:
    """Templates and the index of their word pairs."""

    def __init__(self, templates: dict[str, tuple[str, ...]], min_coverage: float, min_pairs: float) -> None:
        self.min_coverage, self.min_pairs = min_coverage, min_pairs
        self.templates = [(name, k, words(t)) for name, some in templates.items() for k, t in enumerate(some)]
        self.templates = [t for t in self.templates if t[2]]
        self.pairs: dict[tuple[str, str], list[int]] = {}
        # places of each pair in its template, and the template's words by count
        self.places: list[dict[tuple[str, str], list[int]]] = []
        for _, _, w in self.templates:
            at: dict[tuple[str, str], list[int]] = {}
            for j, pair in enumerate(self._pairs(w)):
                at.setdefault(pair, []).append(j)
            if len(w) >= LONG:
                at = {p: x for p, x in at.items() if len(x) == 1 and crc32(" ".join(p).encode()) % SAMPLE == 0}
            self.places.append(at)
        for n, at in enumerate(self.places):
            for pair in at:
                self.pairs.setdefault(pair, []).append(n)
        self.firsts = {p[0] for p in self.pairs}
        self.telling = []
        for name, _, w in self.templates:
            some = (WHOLE_TELLING if len(w) >= WHOLE else TELLING).get(name, ("", ""))
            self.telling.append(tuple(re.compile(x) if x else None for x in some))
        self.enough = [max(min_coverage * len(w), len(w) - 1 if len(w) < SHORT else 0) for _, _, w in self.templates]
        self.bags = [Counter(w) for _, _, w in self.templates]

    @staticmethod
    def _pairs(w: list[str]) -> list[tuple[str, str]]:
        return list(itertools.pairwise(w)) if len(w) > 1 else [(w[0], "")]

    def scan(self, text: str | None) -> list[Hit]:
        w = words(text)
        at: dict[int, list[tuple[int, tuple[str, str]]]] = {}
        for i in (i for i, x in enumerate(w) if x in self.firsts):
            for pair in ((w[i], w[i + 1] if i + 1 < len(w) else None), (w[i], "")):
                for n in self.pairs.get(pair, ()):
                    at.setdefault(n, []).append((i, pair))
        found: list[Hit] = []
        for n, seen in at.items():
            found += self._hits(n, w, seen)
        # of hits that share words, the one with most matched words stays, less
        # what the words put between them count
        found.sort(key=lambda h: (-h.score, -h.coverage, h.end - h.start, h.start, h.license, h.template))
        kept: list[Hit] = []
        starts: list[int] = []
        for h in found:
            at_start = bisect_left(starts, h.start)
            before, after = kept[max(0, at_start - 1) : at_start], kept[at_start : at_start + 1]
            if all(k.end < h.start for k in before) and all(h.end < k.start for k in after):
                kept.insert(at_start, h)
                starts.insert(at_start, h.start)
            else:
                # the same stretch matched as well by another license is a tie
                for x in range(max(0, at_start - 1), min(len(kept), at_start + 1)):
                    k = kept[x]
                    if (k.start, k.end, k.matched, k.coverage) == (h.start, h.end, h.matched, h.coverage):
                        both = {*k.license.split("|"), *h.license.split("|")}
                        kept[x] = replace(k, license="|".join(sorted(both)))
        return kept

    def _hits(self, n: int, w: list[str], seen: list[tuple[int, tuple[str, str]]]) -> list[Hit]:
        """A hit for each likely start that covers the template; they may overlap."""
        size, places = len(self.templates[n][2]), self.places[n]
        need = max(1, int(self.min_pairs * len(places)))
        hits, tried, counts, hi, done = [], set(), Counter(), 0, -1
        step = size // 64 if size >= LONG else 1
        for i, pair in seen:
            while hi < len(seen) and seen[hi][0] <= i + size + size // 2:
                counts[seen[hi][1]] += 1
                hi += 1
            if len(counts) >= need and i > done:
                # pairs of one copy mostly give the same start
                for start in (i - j for j in places[pair] if j <= size // 2):
                    if start // step in tried:
                        continue
                    tried.add(start // step)
                    hit = self._place(n, w, start)
                    hits += [hit] if hit else []
                    if hit and size >= LONG and hit.end - hit.start < size + size // 4:
                        done = hit.end
            counts[pair] -= 1
            if not counts[pair]:
                del counts[pair]
        return hits

    def _place(self, n: int, w: list[str], start: int) -> Hit | None:
        """The template aligned with the text from about ``start`` on. Windows of
        its own length come first: a second copy close by would leave it few
        unique words."""
        name, k, template = self.templates[n]
        size = len(template)
        enough = self.enough[n]
        left, right = max(0, start - size // 2), start + 2 * size
        if (self.bags[n] & Counter(w[left:right])).total() < enough:
            return None
        best: list[tuple[int, int]] = []
        for before, after in ((0, 0), (size // 4, size // 4), (size // 2, size)):
            first = max(0, start - before)
            pairs = [(i, first + j) for i, j in align(template, w[first : max(0, start + size + after)])]
            dense = _dense(pairs)
            pairs = dense if len(dense) >= enough else pairs
            if len(pairs) > len(best):
                best = pairs
            if len(best) == size or (before and len(best) >= enough):
                break
        if len(best) < enough:
            return None
        stretch, (must, must_not) = " ".join(w[best[0][1] : best[-1][1] + 1]), self.telling[n]
        if must_not and must_not.search(stretch):
            return None
        if must and not must.search(stretch):
            on = " ".join(w[best[0][1] : best[-1][1] + 3])  # a version may end the notice
            if size < SHORT or name not in OPEN or re.search(OPEN[name], on):
                return None
        return Hit(name, k, best[0][1], best[-1][1], len(best), len(best) / size)


def _dense(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The run of matched places that is best when words put in between count LOOSE."""
    best, total, lo, run = 0.0, 0.0, 0, (0, 0)
    for k, (i, j) in enumerate(pairs):
        if k:
            total -= LOOSE * max(0, (j - pairs[k - 1][1]) - (i - pairs[k - 1][0]))
        if total < 0:
            total, lo = 0.0, k
        total += 1
        if total > best:
            best, run = total, (lo, k + 1)
    return pairs[slice(*run)]


@functools.lru_cache(maxsize=4)
def _scanner(templates: tuple, min_coverage: float, min_pairs: float) -> Scanner:
    return Scanner(dict(templates), min_coverage, min_pairs)


def license_hits(
    docs: DataFrame,
    templates: dict[str, tuple[str, ...]] | None = None,
    min_coverage: float = MIN_COVERAGE,
    min_pairs: float = MIN_PAIRS,
) -> DataFrame:
    """A row for each hit: doc_id, license, template, start_word, end_word,
    n_matched, coverage, whole_text (whether it covers the text's words)."""
    chosen = tuple((templates or all_templates()).items())
    schema = (
        "doc_id long, license string, template int, start_word long, end_word long, n_matched long,"
        " coverage double, whole_text boolean"
    )

    def make():
        scan = _scanner(chosen, min_coverage, min_pairs).scan

        def work(rows: dict) -> dict | None:
            out: dict[str, list] = {c.split()[0]: [] for c in schema.split(", ")}
            for doc, text in zip(rows["doc_id"], rows["text"], strict=True):
                hits = scan(text)
                last = len(words(text)) - 1 if hits else 0
                for h in hits:
                    whole = h.start == 0 and h.end == last
                    values = (doc, h.license, h.template, h.start, h.end, h.matched, h.coverage, whole)
                    for c, v in zip(out, values, strict=True):
                        out[c].append(v)
            return out if out["doc_id"] else None

        return work

    return map_rows(docs.select("doc_id", "text"), make, schema)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_hits(table(spark, sf_dir, "documents"))
