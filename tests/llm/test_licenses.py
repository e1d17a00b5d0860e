import collections
import re

import numpy as np

from chargeline.llm import text as tx
from chargeline.llm import licenses
from tests.llm.conftest import frame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def base(text):
    w, out = words(text), []
    for phrase, label in licenses.BASE_PHRASES.items():
        p = phrase.split()
        out += [(i, label) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    return len(w), len(out), min((i for i, _ in out), default=None), max((i for i, _ in out), default=None), \
        ",".join(sorted({x for _, x in out}))


EXTRA = ["MIT License", "the mit license mit license general public license, apache-license", "MIT_License mit\nlicense",
         "mit é license", "general public general public license", "license mit", "all rights reserved.",
         "KELVIN K mit license"]


def test_base_columns_match_brute_force(spark, edge_docs):
    docs = [*edge_docs, *((4000 + i, t) for i, t in enumerate(EXTRA))]
    rows = licenses.scan(frame(spark, docs, ", labels int, score string", (1, "x"))).collect()
    got = collections.Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows)
    assert got == collections.Counter((i, *base(t)) for i, t, *_ in docs)
    for r in rows:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1


def test_templates_are_found_with_gaps_and_not_in_clean_text(spark, small_docs):
    notice = licenses.TEMPLATES[3][1]
    cut = notice.replace("free of charge, ", "at no cost whatsoever ").replace("modify, merge, ", "")
    rows = {r.doc_id: r for r in licenses.scan(frame(spark, [
        (1, "some words before " + cut + " and words after"), (2, " ".join(notice.split()[::-1])),
        (3, notice[:200])])).collect()}
    assert rows[1].labels == "mit" and rows[1].score > 0.8 and rows[1].spans.startswith("mit:3:")
    assert rows[2].labels == "" and rows[3].labels == "" and 0 < rows[3].score < 0.75


def test_matching_statistics_match_brute_force():
    import random

    rnd = random.Random(5)
    for _ in range(40):
        seqs = [[rnd.randrange(4) for _ in range(rnd.randrange(1, 14))] for _ in range(4)]
        a = licenses.Automaton()
        for i, s in enumerate(seqs):
            a.add(i, s)
        a.finish()
        text = [rnd.randrange(5) for _ in range(40)]
        for i, (n, state) in enumerate(a.stream(text)):
            inside = lambda m: {(t, e) for t, s in enumerate(seqs) for e in range(m, len(s) + 1)
                                if s[e - m:e] == text[i + 1 - m:i + 1]}
            want = max(m for m in range(0, i + 2) if m == 0 or inside(m))
            assert n == want
            if n:
                assert a.ends[state] == inside(n)


def test_empty_table(spark):
    assert licenses.scan(frame(spark, [])).collect() == []


def text_of(label):
    return [t for x, t in licenses.TEMPLATES if x == label][-1]


def test_notices_of_one_family_are_told_apart(spark):
    clauses = ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
               "following disclaimer in the documentation and/or other materials provided with the distribution. ")
    end = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS WARRANTIES ARE DISCLAIMED.'
    docs = {"bsd-2-clause": text_of("bsd") + " 2. " + clauses + end,
            "bsd-3-clause": text_of("bsd") + " 2. " + clauses + "3. " + text_of("bsd-3-clause") + " " + end,
            "bsd": text_of("bsd"), "gpl,gpl-2.0": text_of("gpl-2.0"), "gpl,gpl-3.0": "x " + text_of("gpl-3.0") + " y",
            "gpl,lgpl-2.1": text_of("lgpl-2.1"), "gpl,lgpl-3.0": text_of("lgpl-3.0"), "agpl-3.0,gpl": text_of("agpl-3.0"),
            "gpl,gpl-2.0,lgpl-2.1": text_of("lgpl-2.1") + " and the rest: " + text_of("gpl-2.0"),
            "isc": text_of("isc"), "unlicense": text_of("unlicense"), "cc0-1.0": text_of("cc0-1.0"), "zlib": text_of("zlib")}
    rows = licenses.scan(frame(spark, list(enumerate(docs.values())))).collect()
    assert {list(docs)[r.doc_id]: r.labels for r in rows} == {k: k for k in docs}


def test_many_spans_in_one_text_take_linear_time(spark):
    import time

    docs = [(1, "all rights reserved " * 60_000), (2, text_of("mit") * 300), (3, "all rights all reserved " * 20_000)]
    start = time.time()
    rows = {r.doc_id: r for r in licenses.scan(frame(spark, docs)).collect()}
    assert time.time() - start < 45
    assert rows[1].spans.count("all-rights-reserved") == 60_000 and rows[2].spans.count("mit:") == 300


def test_chains_match_brute_force():
    """Best coverage of every template: over all orders of matches that the limits allow."""
    import random

    rnd = random.Random(4)
    for _ in range(60):
        templates = tuple((f"t{i}", " ".join(rnd.choice("abcde") for _ in range(rnd.randrange(3, 16)))) for i in range(3))
        scanner = licenses.Scanner(templates, {}, licenses.Limits(2, 3, 0.5))
        text = " ".join(rnd.choice("abcdefg") for _ in range(50)).encode()
        data = np.frombuffer(text, np.uint8)
        s, e, d = tx.runs(tx.ALNUM_WORDS[data], np.array([0, len(data)]))
        ids = scanner.lookup(tx.span_hashes(data, s, e))
        found = [m for a, b in zip(*scanner.segments(ids, d)) for m in scanner.matches(ids[a:b].tolist(), int(a))[1]]
        want = {}
        for t in range(3):
            items = {(at, end - n, n) for at, n, state in found for u, end in scanner.automaton.ends[state] if u == t and n >= 2}

            def longest(last):
                at, pos, n = last
                return n + max([longest(x) for x in items if x[0] + x[2] <= at <= x[0] + x[2] + 3 and x[1] + x[2] <= pos], default=0)

            if items:
                want[t] = max(map(longest, items)) / scanner.sizes[t]
        got = {}
        spans = {}
        for t, a, b, cover in scanner.chains(found):
            got[t] = max(cover, got.get(t, 0))
            spans.setdefault(t, []).append((a, b))
        assert got == want
        for own in spans.values():
            own.sort()
            assert all(x[1] <= y[0] for x, y in zip(own, own[1:]))
