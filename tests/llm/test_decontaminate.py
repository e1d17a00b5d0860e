import math
import random

import numpy as np

from chargeline.llm import decontaminate as dc
from tests.llm.conftest import frame

SF = "/root/testdata/sf0.01"


def brute(docs, items, limits=dc.DEFAULT_LIMITS):
    """(row, item number) of every pair that some window matches, scored item by item."""
    parsed = []
    for number, text in items:
        w = dc.words_of(text)
        if w:
            n = max(1, round(len(w) * limits.answer_share)) if len(w) >= 4 else 0
            parsed.append((number, w[:len(w) - n], w[len(w) - n:], w))
    df = {}
    for *_, w in parsed:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    mean = sum(len(w) for *_, w in parsed) / max(1, len(parsed))
    def span_of(w):
        span = 32
        while span < len(w):
            span *= 2
        return span

    out = set()
    for row, (_, text, *_) in enumerate(docs):
        words = dc.words_of(text)
        for span, a in ((span, a) for span in {span_of(w) for *_, w in parsed} for a in range(0, max(1, len(words)), span)):
            passage = words[a:a + 2 * span]
            there = set(passage)
            grams = {tuple(passage[i:i + 3]) for i in range(len(passage) - 2)} | {(x,) for x in passage}
            for number, q, ans, w in parsed:
                if span_of(w) != span:
                    continue

                def weight(t):
                    tf = w.count(t)
                    idf = math.log(1 + (len(parsed) - df[t] + .5) / (df[t] + .5))
                    return idf * tf * (dc.K1 + 1) / (tf + dc.K1 * (1 - dc.B + dc.B * len(w) / mean))
                total = sum(map(weight, set(w)))
                if sum(weight(t) for t in set(w) & there) / total < limits.min_score - 1e-9:
                    continue
                k = 3 if len(q) >= 3 else 1
                mine = {tuple(q[i:i + k]) for i in range(len(q) - k + 1)}
                if (not mine or len(mine & grams) / len(mine) >= limits.min_question) and (
                        not ans or len(set(ans) & there) / len(set(ans)) >= limits.min_answer):
                    out.add((row, number))
    return out


def test_matches_brute_force(spark, small_docs):
    import duckdb

    items = duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()[:25] + [
        (900, None), (901, ""), (902, "tiny item"), (903, "?!")]
    rnd = random.Random(3)
    docs = [(i, t) for i, (_, t, *_) in enumerate(small_docs[:40])]
    for i, (_, t) in enumerate(items[:25]):
        w = t.split()
        for kind in range(3):
            x = list(w)
            if kind == 1:
                x = [v.upper() + "," for v in x]
            if kind == 2:
                for _ in range(len(x) // 4):
                    x[rnd.randrange(len(x))] = "other"
            host = small_docs[i][1].split()
            at = rnd.randrange(len(host))
            docs.append((100 + 3 * i + kind, " ".join(host[:at] + x + host[at:])))
    docs += [(900, None), (901, ""), (902, "a Tiny, item here")]
    want = {(docs[r][0], n) for r, n in brute(docs, items)}
    df = frame(spark, docs, ", item_id int, score string", (1, "x"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for shard in (10_000, 6):
        got = {(r.doc_id, r.item_id) for r in dc.search(df, bench, shard_items=shard).collect()}
        assert got == want
    assert {100 + 3 * i for i in range(25)} | {101 + 3 * i for i in range(25)} <= {d for d, _ in want}
    assert not {d for d, _ in want if d < 40} - {d for d, _ in want if d < 40 and any(
        " ".join(t.split()[:5]) in (docs[d][1] or "") for _, t in items if t)}
    left = dc.clean(df, bench, shard_items=6)
    assert left.schema == df.schema and {r.doc_id for r in left.collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_survivors_and_wand_find_all_items_above_the_threshold():
    rnd = random.Random(1)
    items = [(i, [b"w%d" % rnd.randrange(60) for _ in range(rnd.randrange(2, 14))]) for i in range(70)]
    hashed = [(i, dc.hash_words(w[:-1]), dc.hash_words(w[-1:])) for i, w in items]
    df = {}
    for _, q, a in hashed:
        for t in set(q.tolist()) | set(a.tolist()):
            df[t] = df.get(t, 0) + 1
    index = dc.Index(hashed, df, 70, 7.0, 32)
    for _ in range(50):
        words = sorted({rnd.randrange(len(index.terms)) for _ in range(12)})
        exact = {i: sum(x for t in words for j, x in index.postings[t] if j == i) for i in range(70)}
        want = {i for i, s in exact.items() if s >= 0.5 - 1e-9}
        ids = np.array(words)
        _, blocks = index.survivors(ids, np.zeros(len(ids), int), np.array([True, True]), 0.5)
        got = {i for b in set(blocks.tolist()) for i, _ in index.wand(words, b, 0.5)}
        assert got == want


def test_empty_tables(spark, small_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = frame(spark, small_docs[:5])
    assert dc.search(docs, none).collect() == [] and dc.clean(docs, none).count() == 5
    bench = spark.createDataFrame([(1, "some words to find")], "item_id long, text string")
    assert dc.search(frame(spark, []), bench).collect() == []


def hits(spark, docs, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in dc.search(frame(spark, docs), bench).collect()}


def test_items_of_common_words_alone_are_found(spark, small_docs):
    items = [(i, f"what is {i // 10 % 10} plus {i % 10}") for i in range(400)] + [(400, "what is plus"), (401, "is")]
    rnd = random.Random(5)
    docs = [(i, t) for i, (_, t, *_) in enumerate(small_docs[:20])]
    docs += [(100 + k, f"{small_docs[k][1]} {items[rnd.randrange(400)][1]} then {rnd.randrange(10)}") for k in range(30)]
    docs += [(200, items[34][1]), (201, "what plus is"), (202, "plus 3 what is 4")]
    want = {(docs[r][0], n) for r, n in brute(docs, items)}
    assert {d for d, _ in want} >= {*range(100, 130), 200} and (200, 134) in want
    assert hits(spark, docs, items) == want


def test_a_benchmark_with_a_third_of_its_rows_equal(spark, small_docs):
    rnd = random.Random(6)
    word = lambda: "w%d" % rnd.randrange(900)
    items = [(i, " ".join(word() for _ in range(12))) for i in range(200)]
    items += [(1000 + i, "the very same question stands here over and over again") for i in range(100)]
    docs = [(i, f"{small_docs[i][1]} {items[i][1]} end") for i in range(20)]
    docs += [(50, "before it the very same question stands here over and over again after it"), (51, "the very same")]
    want = {(docs[r][0], n) for r, n in brute(docs, items)}
    assert {(50, 1000 + i) for i in range(100)} <= want and {(i, i) for i in range(20)} <= want
    assert hits(spark, docs, items) == want


def test_survivors_in_small_steps_are_the_same(monkeypatch):
    rnd = random.Random(8)
    items = [((i,), [b"w%d" % rnd.randrange(30) for _ in range(8)]) for i in range(90)]
    hashed = [(i, dc.hash_words(w[:-1]), dc.hash_words(w[-1:])) for i, w in items]
    df = {}
    for _, q, a in hashed:
        for t in set(q.tolist()) | set(a.tolist()):
            df[t] = df.get(t, 0) + 1
    index = dc.Index(hashed, df, 90, 8.0, 32)
    chunk = np.repeat(np.arange(40), 15)
    ids = np.array([rnd.randrange(-3, len(index.terms)) for _ in chunk])
    new_doc = np.array([k % 7 == 0 for k in range(41)])
    whole = index.survivors(ids, chunk, new_doc, 0.5)
    for step in (1, 40, 300):
        monkeypatch.setattr(dc, "EXPANDED", step)
        assert all((x == y).all() for x, y in zip(whole, index.survivors(ids, chunk, new_doc, 0.5)))


def test_a_long_item_does_not_change_what_others_find(spark, monkeypatch):
    """Each item is searched in windows of its own length; shards of several spans and passes give the same."""
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghijk") for _ in range(rnd.randrange(3, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate((24, 20, 33, 64, 65, 100))] + [(9, text(400))]
    docs = [(i, " ".join((text(rnd.randrange(400)), t, text(rnd.randrange(400))))) for i, t in items]
    # the words of an item strewn over a long stretch: a window as wide as the longest item would hold most of them
    strewn = " ".join(f"{w} {text(12)}" for w in items[0][1].split())
    docs += [(50, strewn), (51, text(900)), (52, None), (53, "")]
    table = lambda rows: spark.createDataFrame(rows, "item_id long, text string")
    found = lambda rows, **k: {(r.doc_id, r.item_id) for r in dc.search(frame(spark, docs), table(rows), **k).collect()}
    want = {(i, i) for i, _ in items}
    assert found(items) == want == {(docs[r][0], i) for r, i in brute(docs, items)}
    assert found(items[:-1]) == want - {(9, 9)}
    monkeypatch.setattr(dc, "SHARD_WORDS", 50)
    monkeypatch.setattr(dc, "PASS_WORDS", 120)
    assert found(items, shard_items=1) == want
    left = dc.clean(frame(spark, docs), table(items), shard_items=1)
    assert {r.doc_id for r in left.collect()} == {50, 51, 52, 53}
