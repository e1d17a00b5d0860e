"""License scans with a generalised suffix automaton of licence tokens.

The automaton is built from the word sequences of all templates (licence
notices and short phrases). A text is streamed through it: after each word the
automaton's state is the longest suffix of the text read so far that occurs in
any template (matching statistics). Maximal matches are chained per template,
in text and template order with bounded gaps; a chain that covers enough of
the template is a span, and its template gives a label. Notices of one family
differ in a word or a number: of their spans that overlap the best covered one
stands (ties: the longer template, the first in the text, the first template).

The automaton is only entered where two neighbouring words are neighbours in
some template; elsewhere the match length is at most one word.

The templates are notices and distinguishing clauses, not whole licence bodies.
A text of the clauses that the BSD licences share is labelled ``bsd``, unless it
goes on as the two-clause or the three-clause licence does.

Null and empty texts have no words, labels or spans and score 0. Every input
row, repeated or not, gives one row. Very long texts are scanned whole, by one
task, in time about proportional to their matches.
"""

from __future__ import annotations

from bisect import bisect
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chargeline.llm import text as tx

# Phrases and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Public licence notices, label and text.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                   "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("mit", "released under the mit license"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software."),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2"),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version."),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the License, "
                "or (at your option) any later version."),
    ("lgpl-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
                 "License, or (at your option) any later version."),
    ("lgpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation, either version 3 of the "
                 "License, or (at your option) any later version."),
    ("agpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
                 "License, or (at your option) any later version."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met: Redistributions of source code must retain the "
            "above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd-2-clause", "in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED"),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                     "promote products derived from this software without specific prior written permission."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and "
             "to alter it and redistribute it freely, subject to the following restrictions:"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc0-1.0", "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring "
                "rights to this software to the public domain worldwide."),
    ("epl-2.0", "made available under the terms of the Eclipse Public License 2.0"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-4.0", "licensed under a creative commons attribution 4.0 international license"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4.0"),
    ("all-rights-reserved", "all rights reserved"),
)

#: Labels whose notices differ in a few words: one span stands where theirs overlap.
FAMILIES = {"gnu": ("gpl-2.0", "gpl-3.0", "lgpl-2.1", "lgpl-3.0", "agpl-3.0")}
#: Labels that say less than one of others beside them.
GENERAL = {"bsd": ("bsd-2-clause", "bsd-3-clause")}


@dataclass(frozen=True)
class Limits:
    """Shortest match used in a chain, widest gap in a chain, least covered share of a template (words)."""

    min_match: int = 3
    max_gap: int = 12
    min_cover: float = 0.75


DEFAULT_LIMITS = Limits()

SCHEMA_FIELDS = [
    T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType()), T.StructField("spans", T.StringType())]


def words_of(text: str) -> list[bytes]:
    data = tx.lower(np.frombuffer(text.encode(), np.uint8))
    s, e, _ = tx.runs(tx.ALNUM_WORDS[data], np.array([0, len(data)]))
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(s, e)]


class Automaton:
    """Generalised suffix automaton over sequences of small integers."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.ends: list[set[tuple[int, int]]] = [set()]

    def _state(self, length: int, after: dict[int, int], link: int) -> int:
        self.next.append(dict(after))
        self.length.append(length)
        self.link.append(link)
        self.ends.append(set())
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """The state for the longest string of p followed by c, cloned from q if q is longer."""
        if self.length[q] == self.length[p] + 1:
            return q
        clone = self._state(self.length[p] + 1, self.next[q], self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def add(self, number: int, tokens: list[int]) -> None:
        last = 0
        for i, c in enumerate(tokens):
            if c in self.next[last]:
                last = self._split(last, c, self.next[last][c])
            else:
                new = self._state(self.length[last] + 1, {}, 0)
                p = last
                while p >= 0 and c not in self.next[p]:
                    self.next[p][c] = new
                    p = self.link[p]
                if p >= 0:
                    self.link[new] = self._split(p, c, self.next[p][c])
                last = new
            self.ends[last].add((number, i + 1))

    def finish(self) -> None:
        """Every state learns the template positions at which its strings end."""
        for s in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            if self.link[s] > 0:
                self.ends[self.link[s]] |= self.ends[s]

    def stream(self, tokens: list[int]):
        """(length, state) of the longest match that ends at each token."""
        s = n = 0
        for c in tokens:
            while s and c not in self.next[s]:
                s = self.link[s]
                n = self.length[s]
            if c in self.next[s]:
                s = self.next[s][c]
                n += 1
            yield n, s


class Scanner:
    """Templates and phrases as one automaton, with vectorised lookup of text words."""

    def __init__(self, templates=TEMPLATES, phrases=None, limits: Limits = DEFAULT_LIMITS):
        self.limits = limits
        phrases = BASE_PHRASES if phrases is None else phrases
        self.labels = [label for label, _ in templates] + list(phrases.values())
        sequences = [words_of(t) for t in [*(t for _, t in templates), *phrases]]
        self.n_templates = len(templates)
        family = {label: name for name, labels in FAMILIES.items() for label in labels}
        self.family = [family.get(label, t) for t, (label, _) in enumerate(templates)]
        self.sizes = [len(s) for s in sequences]
        vocabulary = sorted({w for s in sequences for w in s})
        data = np.frombuffer(b"".join(vocabulary), np.uint8)
        ends = np.cumsum([len(w) for w in vocabulary])
        hashes = tx.span_hashes(data, ends - [len(w) for w in vocabulary], ends)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        number = {vocabulary[v]: i for i, v in enumerate(order)}
        self.adjacent = np.zeros((len(vocabulary), len(vocabulary)), bool)
        self.automaton = Automaton()
        for n, s in enumerate(sequences):
            ids = [number[w] for w in s]
            self.automaton.add(n, ids)
            self.adjacent[ids[:-1], ids[1:]] = True
        self.automaton.finish()
        # per state: the phrases that are a suffix of its longest string, from its suffix link's on
        self.phrases_at: dict[int, list[int]] = {0: []}
        a = self.automaton
        for s in sorted(range(1, len(a.next)), key=lambda s: a.length[s]):
            own = [n for n, end in a.ends[s] if n >= self.n_templates and end == self.sizes[n]
                   and a.length[a.link[s]] < end <= a.length[s]]
            self.phrases_at[s] = self.phrases_at[a.link[s]] + own

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        return np.where(self.hashes[at] == hashes, at, -1)

    def segments(self, ids: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and end word of every stretch whose neighbours are neighbours in a template."""
        a, b = ids[:-1], ids[1:]
        pair = (a >= 0) & (b >= 0) & (docs[:-1] == docs[1:])
        pair[pair] = self.adjacent[a[pair], b[pair]]
        edge = np.diff(np.r_[False, pair, False].astype(np.int8))
        return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1

    def matches(self, ids: list[int], first: int):
        """Base phrase starts, and maximal matches (text start, length, state), of one stretch."""
        base, found, before = [], [], (0, 0)
        for i, (n, s) in enumerate(self.automaton.stream(ids)):
            for p in self.phrases_at[s]:
                if n >= self.sizes[p]:
                    base.append((first + i + 1 - self.sizes[p], p))
            if before[0] >= n:
                found.append((first + i - before[0], *before))
            before = (n, s)
        found.append((first + len(ids) - before[0], *before))
        return base, [m for m in found if m[1] >= 2]

    def chains(self, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int, float]]:
        """(template, first word, end word, coverage): chains that cover enough and, of a family, do not overlap;
        without one, the best chain of the family."""
        by_template: dict[int, set[tuple[int, int, int]]] = defaultdict(set)
        for at, n, s in found:
            for t, end in self.automaton.ends[s]:
                if t < self.n_templates and n >= min(self.limits.min_match, self.sizes[t]):
                    by_template[t].add((at, end - n, n))
        by_family: dict[str | int, list[tuple[float, int, int, int, int]]] = defaultdict(list)
        for t, items in by_template.items():
            items = sorted(items)
            best: list[tuple[int, int]] = []  # covered words, first text word
            reach = 0
            for i, (at, pos, n) in enumerate(items):
                covered, start = n, at
                # chained matches end at most max_gap words before, and none is longer than the template
                while items[reach][0] + self.sizes[t] + self.limits.max_gap < at:
                    reach += 1
                for j in range(reach, i):
                    a, p, m = items[j]
                    if a + m <= at <= a + m + self.limits.max_gap and p + m <= pos:
                        if best[j][0] + n > covered:
                            covered, start = best[j][0] + n, best[j][1]
                best.append((covered, start))
            by_family[self.family[t]] += [(-c / self.sizes[t], -self.sizes[t], s, items[i][0] + items[i][2], t)
                                          for i, (c, s) in enumerate(best)]
        out = []
        for ranked in by_family.values():
            ranked.sort()
            starts: list[int] = []
            ends: list[int] = []
            for cover, _, a, b, t in ranked:
                if -cover < self.limits.min_cover and starts:
                    break
                i = bisect(starts, a)  # taken spans do not overlap, so starts and ends ascend alike
                if (not i or ends[i - 1] <= a) and (i == len(starts) or b <= starts[i]):
                    starts.insert(i, a)
                    ends.insert(i, b)
                    out.append((t, a, b, -cover))
        return out


def _scan_slice(scanner: Scanner, data: np.ndarray, off: np.ndarray) -> dict[str, list]:
    n = len(off) - 1
    low = tx.lower(data)
    s, e, d = tx.runs(tx.ALNUM_WORDS[low], off)
    counts = np.bincount(d, minlength=n)
    first_of = np.cumsum(counts) - counts
    base: dict[int, list] = defaultdict(list)
    found: dict[int, list] = defaultdict(list)
    if len(s) > 1:
        ids = scanner.lookup(tx.span_hashes(low, s, e))
        for a, b in zip(*scanner.segments(ids, d)):
            doc = int(d[a])
            hits, more = scanner.matches(ids[a:b].tolist(), int(a - first_of[doc]))
            base[doc] += hits
            found[doc] += more
    out: dict[str, list] = {f.name: [] for f in SCHEMA_FIELDS}
    for doc in range(n):
        hits = sorted(base.get(doc, ()))
        chains = scanner.chains(found[doc]) if doc in found else []
        spans = sorted((a, b, scanner.labels[t], c) for t, a, b, c in chains if c >= scanner.limits.min_cover)
        own = sorted({scanner.labels[p] for _, p in hits})
        top = max([c for *_, c in chains], default=0.0)
        named = {x for _, _, x, _ in spans}
        named -= {x for x, more in GENERAL.items() if named & {*more}}
        out["n_words"].append(int(counts[doc]))
        out["n_base"].append(len(hits))
        out["first_word"].append(hits[0][0] if hits else None)
        out["last_word"].append(hits[-1][0] if hits else None)
        out["base_labels"].append(",".join(own))
        out["labels"].append(",".join(sorted({*own, *named})))
        out["score"].append(1.0 if hits else min(1.0, top))
        out["spans"].append(",".join(f"{x}:{a}:{b}" for a, b, x, _ in spans))
    return out


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES,
         limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Words, base phrase places, labels, score and covered template spans (label:first:end) of every text."""
    scanner = Scanner(templates, limits=limits)
    schema = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType), *SCHEMA_FIELDS])
    kinds = {T.LongType: pa.int64(), T.StringType: pa.string(), T.DoubleType: pa.float64()}

    def run(batches):
        for batch in batches:
            for a, b, data, off in tx.slices(batch.column(1)):
                out = _scan_slice(scanner, data, off)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a),
                     *[pa.array(out[f.name], kinds[type(f.dataType)]) for f in SCHEMA_FIELDS]], names=schema.names)

    return df.select(id_col, text_col).mapInArrow(run, schema)
