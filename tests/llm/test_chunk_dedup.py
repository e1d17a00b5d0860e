import collections
import random

import numpy as np

from chargeline.llm import chunk_dedup as cd
from tests.llm.conftest import frame


def pieces(text, how=cd.DEFAULT_CHUNKING):
    """Chunks of one text, byte by byte."""
    raw = (text or "").encode()
    edges, last = [0], None
    for i in range(len(raw)):
        h = sum(int(cd.GEAR32[raw[i - j]]) << j for j in range(min(cd.WINDOW, i + 1))) % (1 << 32)
        nxt = raw[i + 1] if i + 1 < len(raw) else 0
        if h < (1 << 32) // how.mean_bytes and i + 1 >= cd.WINDOW and not (i + 1 < len(raw) and 0x80 <= nxt < 0xC0):
            if last is None or i + 1 - last >= how.min_bytes:
                edges.append(i + 1)
            last = i + 1
    edges = sorted({*edges, len(raw)})
    out = []
    for a, b in zip(edges, edges[1:]):
        cuts = [a]
        for c in range(a + how.max_bytes, b, how.max_bytes):
            while 0x80 <= raw[c] < 0xC0:
                c += 1
            cuts.append(c)
        cuts.append(b)
        out += [(s, e, raw[s:e]) for s, e in zip(cuts, cuts[1:])]
    return out


def brute(docs, how=cd.DEFAULT_CHUNKING):
    low = -(1 << 63)
    first = {}
    for i, t, *_ in docs:
        for _, _, c in pieces(t, how):
            first[c] = min(first.get(c, 1 << 63), low if i is None else i)
    out = collections.Counter()
    for i, t, *_ in docs:
        doc, seen, runs = low if i is None else i, set(), []
        for s, e, c in pieces(t, how):
            if first[c] < doc or c in seen:
                if runs and runs[-1][1] == s:
                    runs[-1][1:] = [e, runs[-1][2] + 1, min(runs[-1][3], first[c])]
                else:
                    runs.append([s, e, 1, first[c]])
            seen.add(c)
        for s, e, n, k in runs:
            if e - s >= how.min_run_bytes:
                out[i, s, e, n, None if k == low else k] += 1
    return out


def test_matches_brute_force(spark, edge_docs):
    docs = [d for d in {d[0]: d for d in edge_docs}.values() if d[0] != 1003]
    rows = cd.duplicates(frame(spark, docs, ", start int, h1 string, kept int", (1, "x", 2)).repartition(5)).collect()
    assert collections.Counter(tuple(r) for r in rows) == brute(docs)


def test_shared_passages_are_caught_wherever_they_stand(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    docs, planted = [], set()
    for p in range(60):
        passage = text(55)
        for k in range(3):
            i = 10 * p + k
            docs.append((i, f"{text(rnd.randrange(60))} {passage} {text(rnd.randrange(60))}"))
            planted.add(i)
        docs.append((10 * p + 9, text(120)))
    found = {i for r in cd.duplicates(frame(spark, docs)).collect() for i in (r.doc_id, r.kept_doc_id)}
    assert not found - planted and len(found) >= 0.98 * len(planted)


def test_an_insertion_moves_no_distant_cut():
    rnd = np.random.default_rng(3)
    a = rnd.integers(97, 123, 4000).astype(np.uint8)
    b = np.concatenate([a[:1000], np.frombuffer(b"inserted", np.uint8), a[1000:]])
    cut = [set(cd.chunks(x, np.array([0, len(x)]))[1].tolist()) for x in (a, b)]
    assert {c + 8 for c in cut[0] if c > 1100} == {c for c in cut[1] if c > 1108}


def test_repeated_rows_remove_and_empty_table(spark):
    assert cd.duplicates(frame(spark, [])).collect() == []
    rnd = random.Random(9)
    a, b = ("".join(rnd.choice("abcdeé ") for _ in range(900)) for _ in range(2))
    docs = [(1, a), (2, a), (3, b + a), (4, None), (5, b), (5, b)]
    assert {r.doc_id for r in cd.duplicates(frame(spark, docs)).collect()} == {2, 3, 5}
    out = collections.defaultdict(list)
    for r in cd.remove(frame(spark, docs)).collect():
        out[r.doc_id].append(r.text)
    assert out[1] == [a] and out[2] == [""] and out[4] == [None] and b[:800] in out[3][0] and len(out[3][0]) < 1000


def test_the_query_reports_short_texts_and_every_run(spark, edge_docs, tmp_path):
    from chargeline.llm.queries import op10_chunk_dedup

    docs = [d for d in {d[0]: d for d in edge_docs}.values() if d[0] != 1003]
    docs += [(2000, "Thank you."), (2001, "Thank you."), (2002, "é"), (2003, "é")]
    frame(spark, docs).write.parquet(str(tmp_path / "documents.parquet"))
    got = collections.Counter(tuple(r) for r in op10_chunk_dedup(spark, str(tmp_path)).collect())
    assert got[2001, 0, 10, 1, 2000] == got[2003, 0, 2, 1, 2002] == got[1005, 0, 7, 1, 1004] == 1
    assert got == brute(docs, cd.EVERY_RUN)


def test_rows_without_an_id_are_documents_of_their_own(spark):
    rnd = random.Random(7)
    a, b = ("".join(rnd.choice("abcdefgh ") for _ in range(700)) for _ in range(2))
    rows = cd.duplicates(frame(spark, [(None, a), (None, a), (None, b), (7, b), (8, "other")]).coalesce(1), how=cd.EVERY_RUN).collect()
    assert collections.Counter((r.doc_id, r.first_byte, r.end_byte, r.kept_doc_id) for r in rows) == {
        (None, 0, 700, None): 1, (7, 0, 700, None): 1}
    out = collections.Counter((r.doc_id, r.text) for r in cd.remove(frame(spark, [(None, a), (None, a), (7, a)])).collect())
    assert out == {(None, a): 2, (7, ""): 1}


def test_hot_digests_give_the_same(spark, edge_docs, monkeypatch):
    docs = [d for d in {d[0]: d for d in edge_docs}.values() if d[0] != 1003]
    docs += [(5000 + i, "one line that every text has, and no other " + str(i)) for i in range(200)]
    monkeypatch.setattr(cd, "HOT_FROM", 3)
    monkeypatch.setattr(cd, "HOT_SHARE", 200)
    df = frame(spark, docs).repartition(5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = cd.duplicates(df, how=cd.EVERY_RUN)
        assert collections.Counter(tuple(r) for r in rows.collect()) == brute(docs, cd.EVERY_RUN)
        assert "BroadcastHashJoin" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
