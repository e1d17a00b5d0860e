import collections
import math
import random
import re

import numpy as np
import pytest

from chargeline.llm import lexical_search as ls
from chargeline.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.conftest import SF_SMALL, frame
from tests.oracle_compare import compare, duckdb_for

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=50):
    bags = [(i, collections.Counter(terms(t))) for i, t, *_ in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n, length = len(bags), sum(x[2] for x in bags)
    df = collections.Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, words in {(i, frozenset(terms(t))) for i, t in items}:
        scored = []
        for i, b, size in bags:
            m = 100 - 50 + (50 * size * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * b[t]) // (1000 * b[t] + 20 * m))
                    for t in words if t in b)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[-1], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return collections.Counter(out)


def found(df):
    return collections.Counter((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect())


def asked(spark, items):
    return spark.createDataFrame([(*i, 1, "x") for i in items], "item_id long, text string, doc_id int, score string")


def made(seed, n=900):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdeéß0") for _ in range(rnd.randrange(1, 5))) for _ in range(300)]
    text = lambda k: " ".join(rnd.choice(words[:rnd.choice((20, 80, 300))]) for _ in range(k))
    docs = [(i, text(rnd.randrange(1, 60)).replace("a", "A", 2)) for i in range(n)]
    hot = text(25)
    docs += [(2000 + i, hot) for i in range(n // 2)]  # a third are copies
    docs += [(3000, None), (3001, ""), (3002, " ,.-\n"), (3003, text(4000)), (None, text(9)), (None, hot), (5, docs[5][1]),
             (5, docs[5][1]), (6, "another text of one id")]
    items = [(i, text(rnd.randrange(1, 30))) for i in range(30)]
    items += [(100 + i, items[0][1]) for i in range(15)] + [(200, hot), (201, None), (202, ""), (203, "-"), (204, "unheardof"),
                                                           (None, text(5)), (3, items[3][1]), (3, "ab c d"), (205, docs[-6][1])]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_matches_brute_force(spark, seed, monkeypatch):
    if seed > 1:
        monkeypatch.setattr(ls, "SAMPLE", 20 * seed)
    if seed == 3:
        monkeypatch.setattr(ls, "VOCABULARY", 150)
    if seed == 4:
        monkeypatch.setattr(ls, "ITEMS", 11)
    docs, items = made(seed)
    got = ls.search(frame(spark, docs, ", item_id int, score string, n long", (1, "x", 2)).repartition(5), asked(spark, items))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert found(got) == brute(docs, items)


@pytest.mark.parametrize("block, leaf", [(64, 4), (1000, 7)])
def test_bounds_hold_and_prune(spark, block, leaf, monkeypatch):
    """Every node's bound is above all its documents' scores; a search with trees equals a scan."""
    monkeypatch.setattr(ls, "LEAF", leaf)
    rnd = np.random.default_rng(leaf)
    v, n = 60, block
    off = np.r_[0, np.cumsum(rnd.integers(1, 9, n))]
    words = np.concatenate([np.sort(rnd.choice(v // 2, b - a, False)) + (v // 2) * (i % 2) for i, (a, b) in
                            enumerate(zip(off[:-1], off[1:]))])
    held = np.bincount(words, minlength=v)
    rank = ls.Ranking(n, int(5 * n), held)
    docs = ls.Docs(np.arange(n), rnd.integers(8, 60, n), off, words, rnd.integers(1, 4, len(words)), rank)
    tree = ls.Tree(docs, rank)
    queries = [np.sort(rnd.choice(v // 2, 5, False)) + (v // 2) * (q % 2) for q in range(40)]
    queries = [(t, rank.weight[t]) for t in queries]
    score = np.zeros((len(queries), n), np.int64)
    for q, (t, w) in enumerate(queries):
        weight = np.zeros(v, np.int64)
        weight[t] = w
        np.add.at(score[q], docs.doc, weight[docs.terms] * docs.value)
        bound = tree.bounds(t, w)
        for i, (a, b) in enumerate(tree.spans):
            assert bound[i] > score[q][tree.order[a:b]].max()
    best = ls.Best(len(queries), 3, np.zeros(len(queries), np.int64))
    leaves = sum(c is None for c in tree.child)
    assert ls.search_tree(tree, queries, best) < 0.7 * len(queries) * leaves
    for q in range(len(queries)):
        want = sorted((-s, i) for i, s in enumerate(score[q]) if s > 0)[:3]
        assert list(zip(best.score[q], best.ids[q])) == [(-s, i) for s, i in want]


def test_small_blocks(spark, monkeypatch):
    # read in the test process only; tasks have the default, so trees of the whole task are searched there
    docs, items = made(9, 200)
    spark.conf.set("spark.sql.shuffle.partitions", "31")
    try:
        assert found(ls.search(frame(spark, docs), asked(spark, items), k=3)) == brute(docs, items, 3)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_empty_tables(spark):
    docs, items = made(1, 10)
    assert ls.search(frame(spark, []), asked(spark, items)).collect() == []
    assert ls.search(frame(spark, docs), asked(spark, [])).collect() == []
    assert ls.search(frame(spark, [(1, None), (2, "-")]), asked(spark, items)).collect() == []
    assert ls.search(frame(spark, docs), asked(spark, [(1, None), (2, "!")])).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    assert not compare(QUERIES[name](spark, SF_SMALL), duckdb_for(SF_SMALL), ORACLE_SQL[name])
