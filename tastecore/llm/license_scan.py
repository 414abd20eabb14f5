"""License scan: a generalised suffix automaton over the tokens of license texts.

The words of a file are streamed through the automaton, which gives at every word the longest
stretch ending there that occurs in some license text (matching statistics). Stretches that end at
their longest are chained, in text and template order, into spans; a template whose tokens a span
covers far enough gives its label. Whole base phrases are recognised from the same states: the
words read so far end with a phrase if the state lies at or below the phrase's state.

Edge cases: a null text is an empty one (no words, empty label strings, null places, score 0); each
repeated row is answered; texts are streamed whole; null ids are passed on. Only doc_id and text
are read.
"""

from __future__ import annotations

import functools
import re
from collections import defaultdict
from collections.abc import Sequence
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame

from tastecore.llm.batches import map_slices, text_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}

# Base phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Passages of public licenses and their usual notices, with labels.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    ("mit", "Released under the MIT License"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE"),
    ("gpl", "licensed under the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
)


def words_of(text: str | None) -> list[str]:
    text = text or ""
    return WORD.findall(text.lower() if text.isascii() else text.translate(LOWER))


class SuffixAutomaton:
    """All stretches of a set of token sequences; `ends[state]` lists where they end, as (sequence, place)."""

    def __init__(self, sequences: Sequence[Sequence[int]]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[set[tuple[int, int]]] = [set()]
        for number, sequence in enumerate(sequences):
            last = 0
            for place, token in enumerate(sequence):
                last = self._extend(last, token)
                self.ends[last].add((number, place + 1))
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self.ends[self.link[state]] |= self.ends[state]

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.link) - 1

    def _split(self, state: int, token: int) -> int:
        """The state for exactly the strings of `state` plus `token`."""
        target = self.next[state][token]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(token) == target:
            self.next[state][token] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, token: int) -> int:
        if token in self.next[last]:  # an earlier sequence has it already
            return self._split(last, token)
        new = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and token not in self.next[last]:
            self.next[last][token] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, token)
        return new

    def step(self, state: int, length: int, token: int) -> tuple[int, int]:
        """State and matched length after one more token."""
        while state and token not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        following = self.next[state].get(token)
        return (0, 0) if following is None else (following, length + 1)


class LicenseMatcher:
    def __init__(self, phrases=PHRASES, templates=TEMPLATES, least_match: int = 4, least_cover: float = 0.7, gap: int = 12) -> None:
        texts = [(label, words_of(text)) for label, text in templates] + [(label, words_of(text)) for text, label in phrases]
        self.labels, self.sizes = [x for x, _ in texts], [len(w) for _, w in texts]
        self.first_phrase = len(templates)
        self.vocabulary: dict[str, int] = {}
        coded = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words] for _, words in texts]
        self.automaton = SuffixAutomaton(coded)
        self.least_match, self.least_cover, self.gap = least_match, least_cover, gap
        # Phrases that the words read end with, by state: those of the state's own place and of its suffixes.
        self.phrases: list[list[tuple[int, int]]] = [[] for _ in self.automaton.link]
        at = {}
        for number in range(self.first_phrase, len(texts)):
            state = 0
            for token in coded[number]:
                state = self.automaton.next[state][token]
            at.setdefault(state, []).append((number, self.sizes[number]))
        for state in sorted(range(1, len(self.phrases)), key=self.automaton.length.__getitem__):
            self.phrases[state] = self.phrases[self.automaton.link[state]] + at.get(state, [])

    def match(self, words: Sequence[str]) -> tuple[list[tuple[int, str]], list[tuple[str, int, int, float]]]:
        """Places (first word, label) of base phrases; spans (label, start, end, covered share) of templates."""
        codes = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int32, len(words))
        known = np.concatenate(([0], (codes >= 0).astype(np.int8), [0]))
        change = np.diff(known)
        places: list[tuple[int, str]] = []
        matches: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # template: (start, end, template end)
        starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        long = ends - starts > 1
        for start, end in zip(starts[long].tolist(), ends[long].tolist()):
            state = length = 0
            for place, token in enumerate(codes[start:end].tolist(), start):
                after, reached = self.automaton.step(state, length, token)
                if reached <= length and length >= self.least_match:
                    self._keep(matches, state, length, place)
                state, length = after, reached
                for number, size in self.phrases[state]:
                    if length >= size:
                        places.append((place - size + 1, self.labels[number]))
            if length >= self.least_match:
                self._keep(matches, state, length, end)
        return places, [span for number in sorted(matches) for span in self._chain(number, matches[number])]

    def _keep(self, matches, state: int, length: int, end: int) -> None:
        for number, place in self.automaton.ends[state]:
            if number < self.first_phrase and place >= length:
                matches[number].append((end - length, end, place))

    def _chain(self, number: int, found: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """Spans from matches (start, end, template end) that follow each other in text and template, a few words apart at most.

        The chain that covers most of the template ends at each match, by dynamic programming over text and template
        places; the best chains that cover enough and don't overlap are spans.
        """
        found = sorted(set(found), key=lambda m: (m[1], m[2], m[0]))
        best: list[int] = []
        first: list[int] = []
        for i, (start, end, place) in enumerate(found):
            begin = place - (end - start)
            cover, origin = place - begin, start
            for j in range(i - 1, -1, -1):
                if found[j][1] < start - self.gap:
                    break
                if found[j][0] < start and found[j][2] < place:
                    more = best[j] + place - max(begin, found[j][2])
                    if (more, first[j]) > (cover, origin):
                        cover, origin = more, first[j]
            best.append(cover)
            first.append(origin)
        spans: list[tuple[str, int, int, float]] = []
        for i in sorted(range(len(found)), key=lambda i: (-best[i], found[i][1])):
            if best[i] < self.least_cover * self.sizes[number]:
                break
            if all(found[i][1] <= a or first[i] >= b for _, a, b, _ in spans):
                spans.append((self.labels[number], first[i], found[i][1], best[i] / self.sizes[number]))
        return sorted(spans, key=lambda s: s[1])


@functools.cache
def default_matcher() -> LicenseMatcher:
    return LicenseMatcher()


def scan(docs: DataFrame) -> DataFrame:
    """Per row: words, base places, their first and last word, labels, score, and the template spans.

    `score` is the largest covered share of a template; a base phrase is covered whole.
    """

    def run(ids: list, texts: list) -> dict[str, object]:
        out = defaultdict(list)
        matcher = default_matcher()
        for doc_id, text in zip(ids, texts):
            words = words_of(text)
            places, spans = matcher.match(words)
            base = {label for _, label in places}
            row = {
                "doc_id": doc_id,
                "n_words": len(words),
                "n_base": len(places),
                "first_word": min((p for p, _ in places), default=None),
                "last_word": max((p for p, _ in places), default=None),
                "base_labels": ",".join(sorted(base)),
                "labels": ",".join(sorted(base | {s[0] for s in spans})),
                "score": max([1.0 * bool(places), *(s[3] for s in spans)]),
                "spans": ",".join(f"{label}:{a}:{b}" for label, a, b, _ in spans),
            }
            for name, value in row.items():
                out[name].append(value)
        return out

    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, "
        "base_labels string, labels string, score double, spans string"
    )
    return map_slices(text_of(docs), ["doc_id", "text"], run, schema)
