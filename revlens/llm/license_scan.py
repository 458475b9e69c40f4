"""License scans: patience alignment of texts with license templates.

Where a text may hold a template, the words around that place are aligned
with the template's: words that occur once on either side are anchors, the
longest increasing subsequence of anchors is kept, and the gaps between
them are aligned in the same way; a gap without anchors is matched at its
ends, and small ones by a longest common subsequence.  Coverage is the
share of the template's words that the alignment matches.

A place is a candidate if it holds one of the template's probe words: with
m words and coverage c, at most floor((1 - c) m) words may be missing, so
one of any floor((1 - c) m) + 1 word occurrences must be there.  A text
without any probe word, or with too few of the template's words at all,
cannot reach the coverage and is skipped without loss.  Of places that
overlap, the one with more matched words (then with the higher coverage)
stays, so near templates do not both claim a notice and a whole text is not
taken for the notice inside it.

Coverage alone does not tell variants apart.  In a notice the words that
name the license and its version number must be matched, and none that
makes another variant (Lesser, NC, SA, ND, ...) may be inserted; whole texts
that contain one another differ by the words of ``CLAUSES``.  Whole texts
are those in ``licenses/``; AGPL, EPL and the Creative Commons licenses
other than CC-BY-SA-4.0 and CC0 are known by their notices only.

Defined results: a null or empty text holds nothing; a text may hold a
license several times, each place is a row; repeated documents repeat their rows; an empty
table gives no rows; texts are scanned whole; extra columns are ignored.
"""

from __future__ import annotations

import pkgutil
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from .common import ship

# Whole license texts, read from the package (also inside the archive that executors get).
WHOLE = ["0BSD", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "CC-BY-SA-4.0", "CC0-1.0", "GFDL-1.2", "GFDL-1.3",
         "GPL-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MIT", "MIT-0", "MPL-1.1", "MPL-2.0",
         "NCSA", "OFL-1.1", "Unlicense"]


def _templates() -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}

    def add(name: str, *texts: str) -> None:
        out.setdefault(name, []).extend(texts)

    add("Apache-2.0", "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0")
    for name, said in (("MIT", "MIT"), ("ISC", "ISC"), ("BSD-2-Clause", "BSD 2-Clause"), ("BSD-3-Clause", "BSD 3-Clause")):
        add(name, f"Released under the {said} License.", f"Licensed under the {said} License.")
    for name, kind, version in (("GPL-1.0", "", "1"), ("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.0", "Library ", "2"),
                                ("LGPL-2.1", "Lesser ", "2.1"), ("LGPL-3.0", "Lesser ", "3"), ("AGPL-3.0", "Affero ", "3")):
        add(name, f"Licensed under the GNU {kind}General Public License, version {version}.",
            f"This work is licensed under the GNU {kind}General Public License, version {version}.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            f"{kind}General Public License as published by the Free Software Foundation, either version {version} of the License")
    for version in ("1.1", "2.0"):
        add(f"MPL-{version}", f"Licensed under the Mozilla Public License, Version {version}.")
    add("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at")
    for version in ("1.0", "2.0"):
        add(f"EPL-{version}", f"Licensed under the Eclipse Public License, Version {version}.",
            "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
            f"v. {version} which is available at")
    add("CC0-1.0", "Licensed under CC0 1.0 Universal.",
        "This work is licensed under the Creative Commons CC0 1.0 Universal Public Domain Dedication")
    for version, port in (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic"), ("1.0", "Generic")):
        for parts in ("", "-NC", "-SA", "-ND", "-NC-SA", "-NC-ND"):
            long = (parts.replace("-NC", "-NonCommercial").replace("-SA", "-ShareAlike")
                    .replace("-ND", "-NoDerivatives" if version == "4.0" else "-NoDerivs"))
            add(f"CC-BY{parts}-{version}", f"Licensed under CC BY{parts} {version}.",
                f"This work is licensed under a Creative Commons Attribution{long} {version} {port} License")
    for name in WHOLE:
        add(name, (pkgutil.get_data(__package__, f"licenses/{name}.txt") or b"").decode())
    return out


TEMPLATES = _templates()

# Words of a notice that name the license: matched, or it is another license.
NAMED = frozenset("apache mit isc bsd mozilla eclipse gnu cc cc0 by creative commons attribution "
                  "library lesser affero nc sa nd noncommercial sharealike noderivatives noderivs".split())
# Words that make another variant where they stand in a notice without being its own (some by the word after).
OTHER = frozenset("lesser affero nc sa nd noncommercial commercial sharealike alike noderivatives noderivs derivatives derivs".split())
OTHER_PAIRS = frozenset([("library", "general"), ("free", "documentation")])
# Of whole texts that contain one another: clauses of which a word must be matched, words that may not be inserted.
CLAUSES = {"BSD-2-Clause": ([], "endorse promote advertising acknowledgement"), "BSD-3-Clause": (["endorse promote"], "advertising acknowledgement"),
           "BSD-4-Clause": (["endorse promote", "advertising acknowledgement"], ""), "0BSD": ([], "appear"), "ISC": (["provided that appear"], ""),
           "MIT-0": ([], "substantial portions"), "MIT": (["substantial portions"], "endorse promote"), "NCSA": (["endorse promote"], "")}
NOTICE = 80  # templates of fewer words are notices
VERSION = re.compile(r"v?(\d+(?:\.\d+)*)(?!\w)")

WORD = re.compile(r"\w+")
SMALL = 48  # gaps of at most so many words on either side get the quadratic alignment


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence of ``pairs`` (sorted by the first) with increasing second, by patience sorting."""
    tops: list[int] = []
    piles: list[int] = []  # index of each pile's top pair
    back = [-1] * len(pairs)
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(tops, b)
        back[i] = piles[k - 1] if k else -1
        if k == len(tops):
            tops.append(b)
            piles.append(i)
        else:
            tops[k], piles[k] = b, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def _common(a: list[str], b: list[str], a0: int, b0: int) -> list[tuple[int, int]]:
    """Longest common subsequence of two small lists."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((a0 + i, b0 + j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matched positions (in a, in b), increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once_a, once_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at_b = {w: j for j, w in enumerate(b[b0:b1], b0) if once_b[w] == 1}
        anchors = increasing([(i, at_b[w]) for i, w in enumerate(a[a0:a1], a0) if once_a[w] == 1 and w in at_b])
        if not anchors:
            if a1 - a0 <= SMALL and b1 - b0 <= SMALL:
                out += _common(a[a0:a1], b[b0:b1], a0, b0)
            continue
        out += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:], strict=False) if r - p > 1 and s - q > 1]
    return sorted(out)


def version(low: str, at: int) -> str | None:
    """The version number that begins at ``at`` (2 and 2.0 are the same), None within one or elsewhere."""
    m = VERSION.match(low, at)
    if not m or at > 1 and low[at - 1] == "." and low[at - 2].isdigit():
        return None
    return re.sub(r"(\.0+)+$", "", m[1])


class Template:
    def __init__(self, name: str, text: str, coverage: float):
        low = text.lower()
        self.name, self.words = name, words(text)
        self.many, m = Counter(self.words), len(self.words)
        self.least = max(1, int(-(-(coverage * m - 1e-9) // 1)))  # matched words that make the coverage
        self.notice = m < NOTICE
        self.must, self.versions, self.clauses, self.barred = set(), {}, [], frozenset()
        if self.notice:
            self.must = {i for i, w in enumerate(self.words) if w in NAMED}
            heads = [(i, v) for i, w in enumerate(WORD.finditer(low)) if (v := version(low, w.start()))]
            self.versions = dict(heads[:1])
        elif name in CLAUSES:
            self.clauses = [{i for i, w in enumerate(self.words) if w in c.split()} for c in CLAUSES[name][0]]
            self.barred = frozenset(CLAUSES[name][1].split())
        self.told = {self.words[i] for i in self.must}
        self.probe: set[str] = set()
        held = 0
        for w in sorted(self.many, key=lambda w: (-len(w), w)):  # occurrences of the probe words exceed what may be missing
            self.probe.add(w)
            held += self.many[w]
            if held > m - self.least:
                break

    def bound(self, many: Counter) -> int:
        """Most words that a text of these words can match."""
        return sum(min(n, many[w]) for w, n in self.many.items() if w in many)

    def fits(self, pairs: list[tuple[int, int]], a: int, ws: list[str], starts: list[int], low: str) -> bool:
        """Whether the coverage is reached and the words that tell variants apart are the template's own."""
        if len(pairs) < self.least:
            return False
        to = dict(pairs)
        if any(i not in to for i in self.must) or any(c.isdisjoint(to) for c in self.clauses) or any(i not in to or version(low, starts[a + to[i]]) != v for i, v in self.versions.items()):
            return False
        own = {a + j for j in to.values()}
        return not any(ws[j] in (OTHER if self.notice else self.barred) or self.notice and (ws[j], ws[j + 1]) in OTHER_PAIRS
                       for j in range(a + pairs[0][1], a + pairs[-1][1]) if j not in own)


class Scanner:
    def __init__(self, templates: dict[str, list[str]], coverage: float):
        self.coverage = coverage
        self.templates = [Template(name, t, coverage) for name, texts in templates.items() for t in texts]

    def scan(self, text: str) -> list[tuple[str, int, int, float]]:
        """(license, first word, end word, coverage) of every place found."""
        low = text.lower()
        ws = WORD.findall(low)
        many = Counter(ws)
        chosen = [t for t in self.templates if t.told <= many.keys() and not t.probe.isdisjoint(many)
                  and t.least <= len(ws) and t.bound(many) >= t.least]
        if not chosen:
            return []
        starts = [m.start() for m in WORD.finditer(low)]
        wanted = set().union(*(t.probe for t in chosen))
        at: dict[str, list[int]] = {}
        for i, w in enumerate(ws):
            if w in wanted:
                at.setdefault(w, []).append(i)
        out: dict[tuple[str, int, int], tuple[float, int]] = {}
        for t in chosen:
            m, done, skip = len(t.words), -1, -1
            for p in sorted(i for w in t.probe for i in at.get(w, ())):
                if p < done:
                    continue
                a = max(done, p - m, 0)
                if p < skip:
                    continue
                if (room := t.bound(Counter(ws[a:p + m]))) < t.least:
                    skip = p + t.least - room  # each step brings one new word at most
                    continue
                tries = [(a, p + m)]
                if t.notice:  # where several notices stand together: also from each place that its first word has
                    tries += [(s, s + m + m // 5 + 1) for s in range(p, a - 1, -1) if ws[s] == t.words[0]]
                for a, b in tries:
                    pairs = align(t.words, ws[a:b])
                    if t.fits(pairs, a, ws, starts, low):
                        start, end = a + pairs[0][1], a + pairs[-1][1] + 1
                        out[t.name, start, end] = max(out.get((t.name, start, end), (0.0, 0)), (len(pairs) / m, len(pairs)))
                        done = end
                        break
        kept: list[tuple[str, int, int, float]] = []
        for (name, s, e), (c, _) in sorted(out.items(), key=lambda x: (-x[1][1], -x[1][0], x[0])):
            k = bisect_left(kept, s, key=lambda x: x[1])
            if not (k and kept[k - 1][2] > s or k < len(kept) and kept[k][1] < e):
                kept.insert(k, (name, s, e, c))
        return kept


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, coverage: float = 0.85) -> DataFrame:
    """One row for each license found: doc_id, license, start_word, end_word, coverage.  One pass, no shuffle."""
    ship(docs.sparkSession)
    chosen = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(chosen, coverage)
        for batch in batches:
            rows = [(d, *hit) for d, t in zip(batch["doc_id"], batch["text"], strict=True) if t for hit in scanner.scan(t)]
            out = pd.DataFrame(rows, columns=["doc_id", "license", "start_word", "end_word", "coverage"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return (docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
            .mapInPandas(run, "doc_id long, license string, start_word long, end_word long, coverage double"))
