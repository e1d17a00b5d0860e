import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chargeline.llm import voronoi_topk as vt

SCHEMA = "vec_id long, embedding array<float>, label int, cell string, score double"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 0.5) for i, v in rows], SCHEMA)


def brute(rows, step, k=5):
    """query_id -> sorted answers, by a plain scan; rows equal in id and vector count once."""
    whole = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = [math.floor(256 * float(np.float32(c))) for c in v]
        while x and not x[-1]:
            x.pop()
        whole[i, tuple(x)] = True
    out = []
    for q, x in whole:
        if q % step:
            continue
        scores = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in whole if i != q)[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


@pytest.mark.parametrize("seed, pivots", [(1, 1), (2, 7), (3, 40)])
def test_matches_brute_force(spark, seed, pivots, monkeypatch):
    monkeypatch.setattr(vt, "BLOCK_BYTES", 4096 if seed > 1 else 16 << 20)
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(6)] for _ in range(6)]
    rows = [(i, [c + rnd.gauss(0, 0.2) for c in rnd.choice(centres)]) for i in range(700)]
    rows += [(1000 + i, rows[3][1]) for i in range(300)]  # one vector of a third of the rows
    rows += [(2000 + i, [float(rnd.randrange(-1, 2)) for _ in range(6)]) for i in range(200)]  # many ties
    rows += [(3000, None), (3050, [1.0, None] * 3), (3100, [float("nan")] * 6), (3150, [float("inf")] * 6), (None, [1.0] * 6),
             (3200, []), (3250, [1.0]), (3300, [0.5] * 9), (3350, [0.0] * 6), rows[0], rows[50], (50, [2.0] * 6),
             (-50, [0.25] * 6)]
    rnd.shuffle(rows)
    got = vt.search(table(spark, rows).repartition(5), F.col("vec_id") % 50 == 0, pivots=pivots)
    assert found(got) == brute(rows, 50)


def test_bounds_leave_groups_out(spark, monkeypatch):
    rnd = random.Random(5)
    rows = [(i, [(30.0 if j == i % 8 else 0.0) + rnd.gauss(0, 0.05) for j in range(8)]) for i in range(800)]
    seen = []
    solve = vt._solve
    monkeypatch.setattr(vt, "_solve", lambda visits, *a: (seen.append(visits.count()), solve(visits, *a))[1])
    assert found(vt.search(table(spark, rows), F.col("vec_id") % 20 == 0, pivots=8)) == brute(rows, 20)
    assert seen[0] == 40 and seen[1] <= 20  # one group each, and few more of the other seven


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert found(vt.search(df, F.col("vec_id") % 50 == 0)) == brute(rows, 50)


def test_few_rows_no_queries_and_empty_table(spark):
    query = F.col("vec_id") % 50 == 0
    assert found(vt.search(table(spark, [(0, [1.0, 2.0]), (1, [3.0]), (2, [])]), query)) == [(0, 1, 1, 196608), (0, 2, 2, 0)]
    assert found(vt.search(table(spark, [(0, [1.0])]), query)) == []
    assert found(vt.search(table(spark, [(1, [1.0]), (2, [1.0])]), query)) == []
    assert found(vt.search(table(spark, []), query)) == []
    assert found(vt.search(table(spark, [(0, None)]), query)) == []


def test_very_large_components(spark):
    rows = [(0, [1e30, -1e30]), (1, [1e30, 1.0]), (2, [3e6, 3e6]), (50, [2e6, 1e6])]
    top = (1 << 63) - 1
    got = {(q, i): s for q, _, i, s in found(vt.search(table(spark, rows), F.col("vec_id") % 50 == 0))}
    assert got[0, 1] == top and got[50, 2] == math.floor(256 * 3e6) * math.floor(256 * 2e6) + math.floor(256 * 3e6) * 256 * 10**6
    assert got[0, 2] == 0
