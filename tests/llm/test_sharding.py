import collections
import hashlib
import math
import zlib

from pyspark.sql import functions as F

from chargeline.llm import sharding
from tests.llm.conftest import frame


def run(spark, rows, shards=40, more="", values=()):
    tree = sharding.even_tree(shards)
    return sharding.assign(frame(spark, rows, more, values), tree, sharding.grow(tree)).collect()


def test_slots_sizes_and_checksums(spark, edge_docs):
    rows = run(spark, edge_docs)
    assert len(rows) == len(edge_docs)
    want = collections.Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))
                               for i, t, *_ in edge_docs)
    assert collections.Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
        assert r.law == "key" and 0 <= r.shard < 40
    assert all(sorted(s) == list(range(len(s))) for s in by.values())


def test_growth_moves_rows_only_into_the_new_shard(spark):
    rows = run(spark, [(i, "t") for i in range(6000)])
    moved = [r for r in rows if r.grown_shard != r.shard]
    assert moved and {r.grown_shard for r in moved} == {40}
    assert abs(len(moved) - 6000 / 41) < 60
    count = collections.Counter(r.shard for r in rows)
    assert len(count) == 40 and max(count.values()) < 2 * min(count.values())


def test_a_changed_weight_moves_rows_only_in_its_subtree(spark):
    from dataclasses import replace

    from pyspark.sql import functions as F

    tree = sharding.even_tree(16, regions=4, racks=2)
    heavier = [replace(s, weight=3.0) if s.shard == 5 else s for s in tree]
    region, rack = tree[5].region, tree[5].rack
    df = spark.range(4000).select(sharding.shard_of(F.col("id"), tree).alias("a"),
                                  sharding.shard_of(F.col("id"), heavier).alias("b"))
    for r in df.collect():
        if r.a != r.b:
            assert tree[r.b].region == region
            if tree[r.a].region == region:
                assert tree[r.b].rack == rack or tree[r.a].rack == rack


def test_weights_shape_the_load(spark):
    from pyspark.sql import functions as F

    tree = [sharding.Shard(0, 0, 0, 1.0), sharding.Shard(1, 0, 1, 2.0), sharding.Shard(2, 1, 0, 5.0)]
    n = collections.Counter(r.s for r in spark.range(8000).select(sharding.shard_of(F.col("id"), tree).alias("s")).collect())
    assert [abs(n[i] / 8000 - w / 8) < 0.02 for i, w in enumerate((1, 2, 5))] == [True] * 3


def test_empty_table_extra_columns_and_one_key(spark):
    assert run(spark, []) == []
    rows = run(spark, [(7, "same")] * 50, more=", shard int, slot string, size int", values=(1, "x", 2))
    assert len({r.shard for r in rows}) == 1 and sorted(r.slot for r in rows) == list(range(50))


def test_written_shards(spark, tmp_path, small_docs):
    tree = sharding.even_tree(4)
    sharding.write_shards(frame(spark, small_docs), str(tmp_path / "out"), tree)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(small_docs)


def placed(key, tree):
    """The shard of a key, level by level, by hand."""
    def draw(node, weight):
        bits = int(hashlib.md5(f"{key}|{node}".encode()).hexdigest()[:13], 16)
        return -math.log((bits + 0.5) / (1 << 52)) / weight

    left = tree
    for level in range(3):
        nodes = {}
        for s in left:
            nodes[s.path()[level]] = nodes.get(s.path()[level], 0) + s.weight
        best = min(nodes, key=lambda n: draw(n, nodes[n]))
        left = [s for s in left if s.path()[level] == best]
    return left[0].shard


def test_placement_matches_brute_force(spark):
    tree = sharding.tree_of(41)
    rows = spark.createDataFrame([(i,) for i in [*range(800), None, -5]], "k long")
    got = rows.select("k", sharding.shard_of(rows.k, tree).alias("s")).collect()
    assert [r.s for r in got] == [placed("null" if r.k is None else r.k, tree) for r in got]


def test_one_tree_for_each_number_of_shards(spark):
    assert sharding.tree_of(41) == sharding.grow(sharding.tree_of(40), 0, 0)
    assert [s.shard for s in sharding.tree_of(7)] == list(range(7))
    counts = (32, 33, 39, 40, 41, 42)
    df = spark.range(3000).select(*[sharding.shard_of(F.col("id"), sharding.tree_of(n)).alias(f"n{n}") for n in counts])
    rows = df.collect()
    for a, b in zip(counts, counts[1:]):
        moved = {r[f"n{b}"] for r in rows if r[f"n{a}"] != r[f"n{b}"]}
        assert moved <= set(range(a, b)) and moved
    load = collections.Counter(r.n42 for r in rows)
    assert len(load) == 42 and max(load.values()) < 2.2 * 3000 / 42
