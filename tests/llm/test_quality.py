import collections
import re

import zstandard

from chargeline.llm import quality
from tests.llm.conftest import frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n = collections.Counter(windows)
    repeat = set()
    for i, w in enumerate(windows):
        if n[w] >= 2:
            repeat |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(repeat) > 50 * len(words)
    bands, raw, packer = quality.DEFAULT_BANDS, text.encode(), zstandard.ZstdCompressor(level=3)
    ok = False
    if raw:
        low, high = bands.limits(len(raw))
        size = bands.chunk_bytes
        full = [raw[i:i + size] for i in range(0, len(raw) - size + 1, size)]
        if len(raw) > size and len(raw) % size:
            full.append(raw[-size:])
        odd = sum(not bands.chunk[0] <= len(packer.compress(c)) / size <= bands.chunk[1] for c in full)
        ok = low <= len(packer.compress(raw)) / len(raw) <= high and (not full or odd / len(full) <= bands.max_odd_chunks)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(repeat), failed,
            ok and not failed)


def test_matches_brute_force(spark, edge_docs):
    docs = [*edge_docs, (2000, "a b c\n\na b c\n a b c\na b c a b c\n", "en", "s"), (2001, "é# ß*\n" * 40, "de", "s")]
    rows = quality.score(frame(spark, docs, ", kept boolean, n_words string", (None, "x"))).collect()
    got = collections.Counter((r.doc_id, *r[1:8]) for r in rows)
    assert got == collections.Counter((i, *brute(t)) for i, t, *_ in docs)


def test_bands_reject_repetition_and_noise(spark, small_docs):
    import base64
    import random

    noise = base64.b85encode(random.Random(1).randbytes(6000)).decode()
    noise = " ".join(noise[i:i + 9] for i in range(0, len(noise), 9))
    lines = [f"{i} the same words come again and again in this line" for i in range(400)]
    rows = {r.doc_id: r for r in quality.score(frame(spark, [(1, noise), (2, "\n".join(lines)), (3, small_docs[0][1])])).collect()}
    assert not rows[1].base_failed and not rows[1].kept
    assert not rows[2].kept and rows[3].kept


def test_keep_returns_whole_rows(spark, edge_docs):
    df = frame(spark, edge_docs, ", kept boolean, ratio string", (None, "x"))
    want = collections.Counter(i for i, t, *_ in edge_docs if brute(t)[-1])
    out = quality.keep(df)
    assert out.schema == df.schema
    assert collections.Counter(r.doc_id for r in out.collect()) == want


def test_clean_labelled_documents_stay(spark):
    d = "/root/testdata/sf0.01"
    good = spark.read.parquet(f"{d}/labels.parquet").where("quality = 1")
    rows = quality.score(spark.read.parquet(f"{d}/documents.parquet")).join(good, "doc_id").where("not base_failed")
    assert rows.where("not kept").count() == 0


def test_empty_table(spark):
    assert quality.score(frame(spark, [])).collect() == [] == quality.keep(frame(spark, [])).collect()


def test_the_end_of_a_text_is_seen(spark, small_docs):
    """A text of ordinary words whose last part, less than a chunk, is one word again and again."""
    words = " ".join(t for _, t, *_ in small_docs[:40] if t).split()
    size = quality.DEFAULT_BANDS.chunk_bytes
    clean = " ".join(words)[:size + 40]
    tail = "".join(dict.fromkeys("abcdefghij")) + " "
    rows = {r.doc_id: r for r in quality.score(frame(spark, [(1, clean + tail * 180), (2, clean)])).collect()}
    assert rows[1].odd_chunks >= 0.5 and rows[2].odd_chunks == 0
