import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from chargeline.llm import langid
from tests.llm.conftest import frame

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = langid.predict(docs, langid.train(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_only_rows_not_held_out_are_learned_from(spark, edge_docs):
    df = frame(spark, edge_docs)
    poisoned = df.withColumn("lang", F.when(langid.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    a, b = langid.train(df), langid.train(poisoned)
    assert a.langs == b.langs and (a.weights == b.weights).all()


def test_edge_texts_extra_columns_and_empty_training(spark, edge_docs):
    docs = [*edge_docs, (5000, "12345 !?", "en", "s"), (5001, "ж", "en", "s")]
    df = frame(spark, docs, ", lang_pred string, score int", ("x", 1))
    model = langid.train(df)
    rows = {r.doc_id: r for r in langid.predict(df, model).collect()}
    assert [rows[i].lang_pred for i in (1000, 1001, 1002, 5000)] == ["und"] * 4
    assert rows[5001].lang_pred in model.langs and rows[1000].score == 0.0 and rows[1000].ambiguous
    assert langid.train(frame(spark, [])) is None
    assert langid.train(df.withColumn("lang", F.lit(None).cast("string"))) is None
    assert {r.lang_pred for r in langid.predict(df, None).collect()} == {"und"}


def test_codewords_are_distinct():
    for k in (1, 2, 3, 4, 5, 6, 20, 60):
        code = langid.codewords(k)
        assert len({tuple(r) for r in code.tolist()}) == k
        assert k == 1 or all(abs(c.sum()) < k for c in code.T)


def test_wrong_bits_are_corrected():
    import numpy as np

    code = langid.codewords(5)
    n = code.shape[1]
    m = langid.Model(list("abcde"), code, None, None, None, np.full(n, 1 / n))
    for i in range(5):
        margins = code[i].astype(float)
        margins[:3] *= -1
        assert m.decode(margins[None])[0][0] == i


def by_hand(model, text):
    """Margins and decoding of one text, n-gram by n-gram and bit by bit."""
    data = text.encode()
    folded = [(b | 0x20) if chr(b).isascii() and chr(b).isalpha() else b if b >= 0x80 else 0x20 for b in data]
    grams = []
    for order in langid.ORDERS:
        for i in range(len(folded) - order + 1):
            gram = folded[i:i + order]
            if any(b != 0x20 for b in gram):
                code = 0
                for b in gram:
                    code = (code << 8 | b) & 0xFFFFFFFF
                grams.append((code * 0x9E3779B1 & 0xFFFFFFFF) >> 18 | (order - langid.ORDERS[0]) * langid.BUCKETS)
    bits = len(model.middle)
    margins = []
    for j in range(bits):
        mean = sum(float(model.weights[g, j]) for g in grams) / max(1, len(grams))
        margins.append(min(3.0, max(-3.0, (mean - model.middle[j]) / model.scale[j])))
    losses = [sum(model.strength[j] * math.log1p(math.exp(-langid.SHARPNESS * margins[j] * int(model.code[c, j])))
                  for j in range(bits)) for c in range(len(model.langs))]
    like = [math.exp(-langid.SHARPNESS * (x - min(losses))) for x in losses]
    best = min(range(len(losses)), key=lambda c: losses[c])
    share = sorted((x / sum(like) for x in like), reverse=True)
    return model.langs[best], share[0], share[0] - (share[1] if len(share) > 1 else 0)


def test_margins_and_decoding_match_brute_force(spark, edge_docs):
    df = frame(spark, edge_docs)
    model = langid.train(df)
    some = [d for d in edge_docs if d[1] and len(d[1]) < 4000 and any(c.isalpha() for c in d[1])][:60]
    rows = langid.predict(frame(spark, some).coalesce(1), model).collect()
    for r, (i, text, *_) in zip(rows, some):
        name, score, lead = by_hand(model, text)
        assert (r.doc_id, r.lang_pred) == (i, name) and abs(r.score - score) < 1e-4
        assert r.ambiguous == (lead < langid.AMBIGUOUS_LEAD) or abs(lead - langid.AMBIGUOUS_LEAD) < 1e-4


def test_the_weights_are_the_log_odds_of_the_counts():
    rnd = np.random.default_rng(1)
    size = len(langid.ORDERS) * langid.BUCKETS
    counts = {x: rnd.integers(0, 4, size).astype(float) for x in "abcd"}
    model = langid.fit(counts)
    p = {x: (c + langid.SMOOTHING) / (c + langid.SMOOTHING).sum() for x, c in counts.items()}
    for j in range(model.code.shape[1]):
        one = sum(p[x] for i, x in enumerate(model.langs) if model.code[i, j] > 0) / (model.code[:, j] > 0).sum()
        zero = sum(p[x] for i, x in enumerate(model.langs) if model.code[i, j] < 0) / (model.code[:, j] < 0).sum()
        assert np.allclose(model.weights[:, j], np.log(one / zero), atol=1e-5)
