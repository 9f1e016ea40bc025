"""License scans by a generalised suffix automaton of license words (operator 12).

The words of all templates (notices, conditions, and short phrases) build one suffix automaton. A text's words stream
through it and give the matching statistics: for every word the longest run ending there that stands in some template.
A phrase ends at a word if the automaton's state, or one it is linked to, holds it. Runs that can't grow to the right and are long
enough are matches; each knows where in which templates it stands. Matches of a template that follow one another in both
the text and the template, with few words between, are chained; the chains that cover most words give the covered spans.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, slices, text_buffers

#: Words of UTF-8 bytes in lower case: ASCII letters, digits, and everything that is not ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

#: Phrases that name a license wherever their words stand, and its label.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Public license notices and conditions, (label, words). Their wording is that of the licenses.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. The Software is provided as is, without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
    ("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software"),
    ("boost", "Distributed under the Boost Software License, Version 1.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
)
#: A match has LEAST_MATCH words; a chain bridges at most GAP words in the text and in the template; a template is found where a chain covers COVERED of its words.
LEAST_MATCH, GAP, COVERED = 4, 12, 0.75


def words_of(text: str | bytes) -> list[bytes]:
    return WORD.findall((text.encode() if isinstance(text, str) else text).lower())


@dataclass
class Automaton:
    """Suffix automaton of several word sequences."""

    ids: dict[bytes, int] = field(default_factory=dict)
    sizes: list[int] = field(default_factory=list)  # words of each template
    length: list[int] = field(default_factory=lambda: [0])
    link: list[int] = field(default_factory=lambda: [-1])
    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    ends: list[list[tuple[int, int]]] = field(default_factory=lambda: [[]])  # (template, words up to the end) of a state's runs

    def _state(self, length: int, link: int, step: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.step.append(step)
        self.ends.append([])
        return len(self.length) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """A state for the runs of q that are one word longer than p's; those of p's links too go there."""
        half = self._state(self.length[p] + 1, self.link[q], dict(self.step[q]))
        self.link[q] = half
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = half
            p = self.link[p]
        return half

    def _extend(self, last: int, w: int) -> int:
        q = self.step[last].get(w)
        if q is not None:  # another template holds this run
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and w not in self.step[p]:
            self.step[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def add(self, words: list[bytes]) -> None:
        at, t = 0, len(self.sizes)
        self.sizes.append(len(words))
        for n, word in enumerate(words, 1):
            at = self._extend(at, self.ids.setdefault(word, len(self.ids)))
            self.ends[at].append((t, n))

    def close(self) -> Automaton:
        """Hands every state's places down its links: a run's places are those of all longer runs that end in it."""
        for v in sorted(range(1, len(self.length)), key=lambda v: -self.length[v]):
            if self.link[v] > 0:
                self.ends[self.link[v]] += self.ends[v]
        return self


class LicenseScanner:
    def __init__(self, templates: tuple[tuple[str, str], ...], phrases: Mapping[str, str], least: int, gap: int, covered: float):
        self.labels = [label for label, _ in templates]
        self.least, self.gap, self.covered = least, gap, covered
        self.n_templates = len(templates)
        self.automaton = Automaton()
        for _, text in templates:
            self.automaton.add(words_of(text))
        for phrase in phrases:
            self.automaton.add(words_of(phrase))
        self.labels += list(phrases.values())
        self.automaton.close()
        # (less its words, phrase) of the phrases that end where a state is reached; those of its links are shorter
        a = self.automaton
        self.phrase_ends: list[tuple[tuple[int, int], ...]] = [()] * len(a.length)
        for t, phrase in enumerate(phrases, self.n_templates):
            v = 0
            for w in words_of(phrase):
                v = a.step[v][a.ids[w]]
            self.phrase_ends[v] += ((-a.sizes[t], t),) if a.sizes[t] else ()
        for v in sorted(range(1, len(a.length)), key=a.length.__getitem__):
            self.phrase_ends[v] += self.phrase_ends[a.link[v]]

    def statistics(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(word, state, length of the longest run ending there), only words where that is not 0."""
        a, get = self.automaton, self.automaton.ids.get
        step, link, length = a.step, a.link, a.length
        v = n = 0
        for i, w in enumerate(map(get, words)):
            if w is None:
                v = n = 0
                continue
            while v and w not in step[v]:
                v = link[v]
                n = length[v]
            to = step[v].get(w)
            if to is None:
                v = n = 0
                continue
            v, n = to, n + 1
            yield i, v, n

    def scan(self, raw: bytes) -> tuple[int, list[tuple[int, int]], list[tuple[int, int, int, float]]]:
        """(words, phrase places as (start, phrase), spans as (start, stop, template, covered))."""
        words = words_of(raw)
        places: list[tuple[int, int]] = []
        chains: dict[int, list[tuple[int, int, int, int, int, int]]] = {}
        before = (-2, 0, 0)
        for now in self.statistics(words):
            i, v, n = now
            for size, t in self.phrase_ends[v]:
                if -size <= n:
                    places.append((i + 1 + size, t))
            if before[2] >= self.least and not (i == before[0] + 1 and n == before[2] + 1):
                self.chain(chains, *before)
            before = now
        if before[2] >= self.least:
            self.chain(chains, *before)
        return len(words), sorted(places), self.spans(chains)

    def chain(self, chains: dict, i: int, v: int, n: int) -> None:
        """Puts a match behind the chain of its template that then covers most. Nodes: (text start, text stop, template stop, covered, node before, first text word)."""
        for t, end in self.automaton.ends[v]:
            if t >= self.n_templates:
                continue
            nodes = chains.setdefault(t, [])
            start, stop, first = i + 1 - n, i + 1, end - n
            best = (n, -1, start)
            for k in range(len(nodes) - 1, -1, -1):
                _, p_stop, p_end, p_covered, _, p_first = nodes[k]
                if p_stop + self.gap < start:
                    break  # nodes stand in the order of their text stops
                over = max(0, p_stop - start, p_end - first)
                if p_stop < stop and p_end < end and over < n and first - p_end <= self.gap and p_covered + n - over > best[0]:
                    best = (p_covered + n - over, k, p_first)
            nodes.append((start, stop, end, *best))

    def spans(self, chains: dict) -> list[tuple[int, int, int, float]]:
        """For every template its chains that cover enough, best first, none overlapping a better one of it."""
        out = []
        for t, nodes in chains.items():
            good = sorted(((-covered, first, stop) for _, stop, _, covered, _, first in nodes if covered >= self.covered * self.automaton.sizes[t]))
            taken: list[tuple[int, int]] = []
            for covered, first, stop in good:
                k = bisect_left(taken, (first, stop))
                if (k == 0 or taken[k - 1][1] <= first) and (k == len(taken) or taken[k][0] >= stop):
                    taken.insert(k, (first, stop))
                    out.append((first, stop, t, -covered / self.automaton.sizes[t]))
        return sorted(out)


SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("label", pa.string()), ("covered", pa.float64())])
SCANNED = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(SPAN))])


def scanned_rows(scanner_args: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = LicenseScanner(*scanner_args)
        for batch in batches:
            raw, offsets = text_buffers(batch.column("text"))
            ids = batch.column("id").to_pylist()
            for lo, hi in slices(offsets, 1 << 20):
                rows = []
                for i in range(lo, hi):
                    n, places, spans = scanner.scan(raw[offsets[i] : offsets[i + 1]].tobytes())
                    base = {scanner.labels[t] for _, t in places}
                    labels = base | {scanner.labels[t] for _, _, t, _ in spans}
                    missed = 1.0
                    for label in labels:
                        missed = min(missed, (0.5 if label in base else 1.0) * (1 - max((min(c, 1.0) for _, _, t, c in spans if scanner.labels[t] == label), default=0.0)))
                    rows.append((ids[i], n, len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted(base)), ",".join(sorted(labels)), 1 - missed,
                                 [{"start": a, "stop": b, "label": scanner.labels[t], "covered": c} for a, b, t, c in spans]))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), SCANNED, strict=True)], schema=SCANNED)

    return run


def scan_licenses(docs: DataFrame, text: str = "text", id_col: str = "doc_id", templates: tuple[tuple[str, str], ...] = TEMPLATES, phrases: Mapping[str, str] = PHRASES, least: int = LEAST_MATCH, gap: int = GAP, covered: float = COVERED) -> DataFrame:
    """Licenses that every whole text names or quotes.

    Returns per row: the id, n_words, n_base (places of the phrases), first_word and last_word (their smallest and largest
    start, words from 0; null without one), base_labels, labels (those of covered templates too; distinct, sorted,
    comma-joined), score (of the surest label: half for a phrase, and of what is left the covered share of its best
    template) and spans (start and stop word, label and covered share of each covered template). A null text is empty;
    null ids stay null; repeated rows are scanned each. An empty table gives an empty table.
    """
    keyed = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    schema = "id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<start:long,stop:long,label:string,covered:double>>"
    out = arrow_map(keyed, scanned_rows((tuple(templates), dict(phrases), least, gap, covered)), schema)
    return out.select(F.col("id").alias(id_col), *out.columns[1:])
