import collections
import functools
import hashlib
import random
import re

import numpy as np
import pytest

from chargeline.llm import suffix_dedup as sd
from chargeline.llm import text as tx
from tests.llm.conftest import frame


def brute(texts, least):
    raw = [(t or "").encode() for t in texts]
    at = collections.Counter(b[i:i + least] for b in raw for i in range(len(b) - least + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - least + 1):
            if at[b[i:i + least]] > 1:
                gone[i:i + least] = True
        kept = np.frombuffer(b, np.uint8)[~gone[:-1]].tobytes()
        out.append((len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()),
                    hashlib.sha256(kept).hexdigest()))
    return out


def made(seed, n=60):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdé") for _ in range(rnd.randrange(1, 7)))
    passages = [" ".join(word() for _ in range(rnd.randrange(4, 60))) for _ in range(6)]
    docs = []
    for _ in range(n):
        parts = [" ".join(word() for _ in range(rnd.randrange(0, 40)))]
        for _ in range(rnd.randrange(0, 4)):
            p = rnd.choice(passages)
            if rnd.random() < 0.4:
                k = rnd.randrange(len(p))
                p = p[:k] + rnd.choice("xyz") + p[k + rnd.randrange(2):]
            parts += [p, " ".join(word() for _ in range(rnd.randrange(0, 12)))]
        docs.append(" ".join(parts))
    return docs + docs[:4] + ["", None, "ab" * 300, "a" * 700, "abc abc " * 50, "\0" * 90 + "q", "\0" * 95]


@pytest.mark.parametrize("seed,least,gram,shallow,group", [
    (1, 40, 16, 16, 1 << 15), (2, 80, 16, 24, 1 << 15), (3, 64, 64, 8, 1 << 15), (4, 100, 32, 96, 3), (5, 30, 8, 8, 2)])
def test_matches_brute_force(spark, seed, least, gram, shallow, group):
    texts = made(seed)
    df = frame(spark, list(enumerate(texts)), ", raw int, t1 string, copies int", (1, "x", 2)).repartition(5)
    rows = sd.dedup(df, least=least, gram=gram, shallow=shallow, group=group).collect()
    got = {r.doc_id: tuple(r[1:5]) for r in rows}
    assert got == dict(enumerate(brute(texts, least)))


def test_whole_documents_with_production_parameters(spark, edge_docs):
    rows = sd.dedup(frame(spark, edge_docs)).collect()
    got = collections.Counter((r.doc_id, *r[1:5]) for r in rows)
    want = collections.Counter((d[0], *x) for d, x in zip(edge_docs, brute([d[1] for d in edge_docs], 400)))
    assert got == want
    assert any(r.n_removed for r in rows)


def test_very_long_texts_are_anchored_in_blocks(monkeypatch):
    rnd = np.random.default_rng(1)
    data = rnd.integers(97, 101, 9000).astype(np.uint8)
    off = np.array([0, 50, 6000, 9000])
    whole = sd.anchors(data, off, 40, 16)
    monkeypatch.setattr(sd, "_BLOCK", 256)
    parts = sd.anchors(data, off, 40, 16)

    def windows(a):
        return {(d, w): (k, at) for k, d, at, f, l in zip(*a) for w in range(f, l + 1)}

    assert windows(whole) == windows(parts)
    assert len(windows(whole)) == (50 - 39) + (6000 - 50 - 39) + (3000 - 39)


def test_sort_orders_strings_with_their_common_prefixes():
    rnd = random.Random(2)
    strings = [bytes(rnd.choice(b"ab\0") for _ in range(rnd.randrange(0, 30))) for _ in range(150)]
    strings += [b"ab" * 20 + s for s in strings[:60]] + strings[:5]
    group = np.sort(np.array([rnd.randrange(5) for _ in strings]))
    data = np.frombuffer(b"".join(strings) + b"!", np.uint8)
    size = np.array([len(s) for s in strings])
    for shallow in (0, 8, 16, 64):
        order, common = sd.sort_strings(data, np.cumsum(size) - size, size, group, shallow)
        for g in range(5):
            mine = np.flatnonzero(group == g)
            got = [strings[i] for i in order[mine]]
            assert got == sorted(strings[i] for i in mine)
            for a, b, c in zip(got, got[1:], common[mine][1:]):
                assert a[:c] == b[:c] and (c == len(a) or c == len(b) or a[c] != b[c])


def test_empty_table(spark):
    assert sd.dedup(frame(spark, [])).collect() == []


def shared_places(texts):
    """n_shared by a plain scan: the anchors of all windows of 51 words, against those of the other texts."""
    def anchors_of(t):
        words = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())
        out = set()
        for i in range(len(words) - sd.PASSAGE_WORDS + 1):
            grams = [tuple(words[j:j + sd.PASSAGE_GRAM]) for j in range(i, i + sd.PASSAGE_WORDS - sd.PASSAGE_GRAM + 1)]
            out.add(min(grams, key=rank))
        return out

    @functools.cache
    def rank(gram):
        data = np.frombuffer(b" ".join(gram), np.uint8)
        s, e, _ = tx.runs(tx.SPACE_WORDS[data], np.array([0, len(data)]))
        h = tx.span_hashes(data, s, e)
        v = h[:1]
        for i in range(1, len(h)):
            v = tx.mix(v + h[i:i + 1])
        return int(v[0]) >> 24

    each = [anchors_of(t) for t in texts]
    held = collections.Counter(g for a in each for g in a)
    return [sum(held[g] > 1 for g in a) for a in each]


def test_shared_passages_are_told(spark, small_docs, monkeypatch):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(n) for n in (51, 60, 90, 15, 40)]
    docs = [" ".join((text(rnd.randrange(0, 120)), passages[i % 5], text(rnd.randrange(0, 120)))) for i in range(40)]
    docs += [text(200) for _ in range(30)] + [docs[0], None, "", text(51), "x y " * 300]
    rows = {r.doc_id: r for r in sd.dedup(frame(spark, list(enumerate(docs))).repartition(4)).collect()}
    want = shared_places(docs)
    assert [rows[i].n_shared for i in range(len(docs))] == want
    for i in range(40):  # the passages of 51 words and more are all found
        assert i % 5 > 2 or rows[i].n_shared > 0
    assert not any(rows[i].n_shared for i in range(40, 70))
    real = [t for _, t, *_ in small_docs[:50]]
    got = {r.doc_id: r.n_shared for r in sd.dedup(frame(spark, list(enumerate(real)))).collect()}
    assert [got[i] for i in range(len(real))] == shared_places(real)
    monkeypatch.setattr(sd, "_BLOCK", 64)  # long texts in overlapping blocks
    data = np.frombuffer(" ".join(real).encode(), np.uint8)
    off = np.array([0, len(data) // 3, len(data)])
    parts = {*zip(*(x.tolist() for x in sd.word_anchors(data, off)))}
    monkeypatch.undo()
    assert parts == {*zip(*(x.tolist() for x in sd.word_anchors(data, off)))}
