import math
import random
from fractions import Fraction

import numpy as np
import pytest

from chargeline.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, n string, component int, v string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 7, "y") for i, v in rows], SCHEMA)


def entries(rows):
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    return [(i, [math.floor(64 * float(np.float32(c))) + 1000000 for c in v]) for i, v in good]


def check(got, rows, dim):
    x = entries(rows)
    n = len(x)
    s = [sum(v[d] for _, v in x) for d in range(dim)]
    centred = [[n * v[d] - s[d] for d in range(dim)] for _, v in x]
    cov = np.array([[float(Fraction(sum(r[a] * r[b] for r in centred), n ** 3)) for b in range(dim)] for a in range(dim)])
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    c = min(32, dim)
    assert len(got) == n * c
    assert {r.n for r in got} == {n} and {r.component for r in got} == set(range(1, c + 1))
    want = {}
    for (i, _), m in zip(x, centred):
        want.setdefault(i, []).append((sum(a * a for a in m), np.array(m, float) / n))
    by = {}
    for r in got:
        by.setdefault(r.vec_id, []).append(r)
    y = np.zeros((n, c))
    for k, (i, m) in enumerate(want.items()):
        assert len(m) == len(by[i]) // c
        if len(m) == 1:
            assert {r.deviation for r in by[i]} == {m[0][0]}
    assert all(abs(r.explained - e[r.component - 1] / e.sum()) <= 1e-9 * e[r.component - 1] / e.sum() for r in got)
    single = [i for i in want if len(want[i]) == 1]
    y = np.array([[r.whitened for r in sorted(by[i], key=lambda r: r.component)] for i in single])
    z = np.array([want[i][0][1] for i in single]) @ u[:, :c] / np.sqrt(e[:c])
    sign = np.sign((y * z).sum(0))
    assert np.allclose(y, z * sign, atol=1e-7)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9
    if len(single) == n:
        assert np.abs(y.T @ y / n - np.eye(c)).max() < 1e-8


@pytest.mark.parametrize("seed, rows, dim", [(1, 300, 5), (2, 900, 40), (3, 70, 33)])
def test_matches_exact_arithmetic(spark, monkeypatch, seed, rows, dim):
    monkeypatch.setattr(wh, "ROWS", 64 if seed > 1 else 8192)
    rnd = random.Random(seed)
    data = [(i, [rnd.gauss(0, 1 + d) * (50 if seed == 3 else 1) for d in range(dim)]) for i in range(rows)]
    data += [(5000, None), (5001, [1.0, None] + [0.0] * (dim - 2)), (5002, [float("nan")] * dim),
             (5003, [float("-inf")] * dim), (5004, []), (None, [1.0] * dim), (7, data[0][1]), (7, data[1][1])]
    got = wh.whiten(table(spark, data).repartition(5)).collect()
    check(got, data, dim)
    other = data + [(6000, [1.0]), (6001, [2.0] * (dim + 1))]  # of another length: no part
    assert len(wh.whiten(table(spark, other)).collect()) == len(got)


def test_popcounts_are_exact_cross_products():
    rnd = np.random.default_rng(1)
    y = rnd.integers(0, 1 << 13, (777, 6)).astype(np.uint64)
    counts = np.zeros((25, 7, 7), np.int64)
    for at in range(0, 777, 64):
        wh.add_counts(counts, wh.planes(y[at:at + 64], 13))
    full = np.concatenate([y, np.ones((777, 1), np.uint64)], 1).astype(object)
    want = full.T @ full
    got = sum((1 << w) * counts[w].astype(object) for w in range(25))
    assert all(got[a, b] == want[a, b] for a in range(7) for b in range(a, 7))


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    check(wh.whiten(df).collect(), [(r.vec_id, r.embedding) for r in df.collect()], 64)


def test_large_entries_sum_exactly(spark):
    data = [(i, [float(2 ** (20 + i % 5)), -float(2 ** 50) if i == 3 else float(i)]) for i in range(9)]
    got = wh.whiten(table(spark, data)).collect()
    x = entries(data)
    s = [sum(v[d] for _, v in x) for d in range(2)]
    want = {i: sum((9 * v[d] - s[d]) ** 2 for d in range(2)) for i, v in x}
    assert {r.vec_id: r.deviation for r in got} == {i: d if d < 1 << 63 else None for i, d in want.items()}
    assert wh.whiten(table(spark, [(1, [1e38, 0.0]), (2, [-1e38, 1.0]), (3, [1.0, 2.0])])).count() == 6


def test_no_spread_and_empty_table(spark):
    rows = wh.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert len(rows) == 4 and all(r.whitened is None and r.deviation == 0 and r.explained is None for r in rows)
    rows = wh.whiten(table(spark, [(1, [1.0, 2.0]), (2, [3.0, 4.0])])).collect()  # one direction only
    assert sorted((r.component, r.whitened is None) for r in rows) == [(1, False), (1, False), (2, True), (2, True)]
    assert wh.whiten(table(spark, [])).collect() == [] == wh.whiten(table(spark, [(1, None), (2, [])])).collect()
