import collections
import random
import re

import numpy as np
import pytest

from chargeline.llm import ngram_join as nj
from tests.llm.conftest import frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(docs):
    sets = [shingles(t) for _, t, *_ in docs]
    group = list(range(len(docs)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    by = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            by[g].append(i)
    for i, s in enumerate(sets):
        shared = collections.Counter(j for g in s for j in by[g] if j < i)
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                group[find(i)] = find(j)
    low = {}
    for i, d in enumerate(docs):
        if sets[i] and d[0] is not None:
            low[find(i)] = min(low.get(find(i), d[0]), d[0])
    return collections.Counter((d[0], len(sets[i]), low.get(find(i)) if sets[i] else d[0]) for i, d in enumerate(docs))


def made(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcde") for _ in range(rnd.randrange(2, 6)))
    bases = [[word() for _ in range(rnd.randrange(20, 160))] for _ in range(8)]
    line = [word() for _ in range(30)]
    docs = []
    for i in range(260):
        w = list(rnd.choice(bases))
        for _ in range(rnd.randrange(0, 9)):
            k = rnd.randrange(len(w))
            w[k:k + rnd.randrange(2)] = [word()]
        if rnd.random() < 0.4:
            w = w[:rnd.randrange(1, len(w))]
        if rnd.random() < 0.5:
            w += line
        docs.append((i, " ".join(x.upper() if rnd.random() < 0.1 else x for x in w)))
    return docs + [(300 + i, d[1]) for i, d in enumerate(docs[:20])] + [
        (400, None), (401, ""), (402, "  "), (403, "a b"), (404, "A\nB"), (405, "b a"), (406, "a b c d e"), (3, docs[3][1])]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(nj, "HUB_GROUP", 16 if seed > 1 else 512)
    monkeypatch.setattr(nj, "FREQUENT", 50 if seed == 3 else 500_000)
    monkeypatch.setattr(nj, "FRAGMENT", {1: 1_500_000, 2: 700, 3: 90}[seed])
    monkeypatch.setattr(nj, "GATHER", 2000 if seed == 2 else 600_000)
    docs = made(seed)
    rows = nj.groups(frame(spark, docs, ", sig int, n string", (1, "x")).repartition(6)).collect()
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows) == brute(docs)


def test_real_documents_and_one_of_each(spark, edge_docs):
    df = frame(spark, edge_docs, ", component_id int", (1,))
    rows = nj.groups(df).collect()
    want = brute(edge_docs)
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id if r.doc_id is not None else None) for r in rows)
    assert got == collections.Counter({(i, n, c if i is not None else None): v for (i, n, c), v in want.items()})
    kept = nj.one_of_each(df)
    assert kept.columns == df.columns
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter(
        {i: v for (i, n, c), v in want.items() if i is None or i == c})


def test_empty_table_and_no_links(spark):
    assert nj.groups(frame(spark, [])).collect() == []
    rows = nj.groups(frame(spark, [(1, "a b c d e f"), (2, "u v w x y z"), (3, None)])).collect()
    assert {(r.doc_id, r.component_id) for r in rows} == {(1, 1), (2, 2), (3, 3)}


def test_components_of_a_long_path(spark):
    edges = spark.range(200).selectExpr("id as u", "id + 1 as v").repartition(4)
    rows = nj._components(edges).collect()
    assert {r.node: r.group for r in rows} == {i: 0 for i in range(201)}


def test_partial_counts_with_leaders_join_near_copies(spark, monkeypatch):
    """Without the pairs counted in full, the sums over the fragments already join an edited group of copies."""
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefg") for _ in range(rnd.randrange(2, 7)))
    base = [word() for _ in range(150)]
    docs = [(0, " ".join(base))]
    for i in range(1, 80):
        w = list(base)
        for _ in range(rnd.randrange(1, 4)):
            w[rnd.randrange(len(w))] = word()
        docs.append((i, " ".join(w)))
    docs += [(100 + i, " ".join(word() for _ in range(150))) for i in range(30)]
    monkeypatch.setattr(nj, "FRAGMENT", 400)
    monkeypatch.setattr(nj, "_cross_pairs", lambda members, limit: spark.createDataFrame([], "a long, a_n long, b long, b_n long"))
    rows = {r.doc_id: r.component_id for r in nj.groups(frame(spark, docs).repartition(5)).collect()}
    assert sum(rows[i] == 0 for i in range(80)) >= 76 and all(rows[100 + i] == 100 + i for i in range(30))


def test_fragments_follow_the_order():
    """Fragments are contiguous pieces of (class, hash), and hold about as many occurrences each."""
    rnd = np.random.default_rng(3)
    h = rnd.integers(0, 1 << 64, 20_000, dtype=np.uint64)
    top = (h[:300] >> np.uint64(32)).astype(np.int64)
    df = rnd.integers(8, 900, 300)
    order = nj.Order(top, df, 19_700 + int(df.sum()), 5000)
    cls = order.classes(h)
    assert (cls[:300] == np.floor(np.log2(df))).all() and (cls[300:] == 0).all()
    frag = order.fragment(cls, h)
    by = np.lexsort((h, cls))
    assert (np.diff(frag[by]) >= 0).all() and frag.max() < order.fragments
    weight = np.r_[df, np.ones(19_700)]
    assert np.bincount(frag, weight).max() < 3 * 5000
    assert nj.Order(np.zeros(0, np.int64), np.zeros(0, np.int64), 0, 10).fragments == 1


def test_byte_planes_round_trip():
    rnd = np.random.default_rng(4)
    arrays = [rnd.integers(0, 1 << 62, 77).astype(np.uint64), np.arange(5, dtype=np.int32) - 2, np.zeros(0, np.int64)]
    got = nj._unsqueezed(nj._squeezed(*arrays), (np.uint64, 77), (np.int32, 5), (np.int64, 0))
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, got))
    assert (nj._unpack(nj._pack(np.sort(arrays[0]))) == np.sort(arrays[0])).all()
