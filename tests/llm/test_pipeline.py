import collections

import corpus_pipeline


from chargeline.llm.queries import QUERIES, benchmark
from tests.llm.conftest import frame
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_ngram_join import brute as near
from tests.llm.test_packing import ids_of
from tests.llm.test_pii import base
from tests.llm.test_quality import brute as quality

SF = "/root/testdata/sf0.001"


def test_stages_match_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in benchmark(spark, SF).collect()]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert out.dtypes == docs.dtypes
            got = {r.doc_id: r for r in out.collect()}
            if k == 0:
                rows = [r for r in rows if quality(r[1])[-1]]
            elif k == 1:
                rows = [r for r in rows if (r[0], r[0]) in {(i, c) for i, _, c in near(rows)}]
            elif k == 2:
                bad = {rows[i][0] for i, _ in leaks(rows, items)}
                assert bad
                rows = [r for r in rows if r[0] not in bad]
            else:
                for i, t in rows:
                    if not base(t):
                        assert got[i].text == t or "[" in got[i].text
                    else:
                        assert "[" in got[i].text and got[i].n_chars == len(got[i].text)
                rows = [(i, got[i].text) for i, _ in rows]
            assert sorted(got) == sorted(i for i, _ in rows)
            if k != 3:
                assert all(got[i].text == t for i, t in rows)
        docs = out
    total = sum(len(x) + 1 for x in ids_of([t for _, t in rows]))
    assert sum(r.length for r in docs.collect()) == total
    whole = corpus_pipeline.run(spark, SF).collect()
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
    assert sum(r.length for r in whole) == total and {r.doc_id for r in whole} == {i for i, _ in rows}
    assert len({key(r)[:2] for r in whole}) == len(whole)


def test_every_operator_is_registered(spark):
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in QUERIES} and "pipeline" in names
    assert set(QUERIES) <= set(names)


def test_empty_table_through_all_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_stages_on_odd_rows(spark, edge_docs):
    """Null, empty, very long, tied and repeated rows, rows without an id, and columns of clashing names."""
    more = ", component_id int, kept string, n_words int, found string"
    df = frame(spark, edge_docs, more, (1, "x", 2, "y"))
    count = lambda rows: collections.Counter((r.doc_id, r.text) for r in rows)
    given = count(df.collect())
    good = corpus_pipeline.quality_rules(spark, df, SF)
    assert good.schema == df.schema
    assert count(good.collect()) == {(i, t): n for (i, t), n in given.items() if quality(t)[-1]}
    one = corpus_pipeline.near_duplicates(spark, df, SF)
    assert one.schema == df.schema
    keep = {(i, n) for i, n, c in near(edge_docs) if i is None or i == c}
    assert {i for i, _ in count(one.collect())} == {i for i, _ in keep}
    clean = corpus_pipeline.decontamination(spark, df, SF)
    assert clean.schema == df.schema
    items = [(r.item_id, r.text) for r in benchmark(spark, SF).collect()]
    bad = {k for k, _ in leaks(edge_docs, items)}
    assert count(clean.collect()) == collections.Counter((d[0], d[1]) for k, d in enumerate(edge_docs) if k not in bad)
    safe = corpus_pipeline.personal_data(spark, df, SF)
    assert safe.schema.names == df.schema.names and safe.count() == len(edge_docs)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in safe.collect())
    pieces = corpus_pipeline.packed(spark, df, SF).collect()
    assert {r.doc_id for r in pieces} == {d[0] for d in edge_docs}
    assert sum(r.length for r in pieces) == sum(len(x) + 1 for x in ids_of([d[1] for d in edge_docs]))
