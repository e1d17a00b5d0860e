import collections
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from chargeline.llm import packing
from chargeline.llm.queries import vocabulary
from tests.llm.conftest import frame

PATH = public_tokenizers.path("byte_bpe_50k.json")
VOCABULARY = vocabulary()


def ids_of(texts):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [x.ids for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_round_trip_and_gapless_sequences(spark, edge_docs):
    odd = ["a  b", " lead", "trail ", "a\n\nb", "tab\tb \nc", "it's we'll 'S", " x y", "a\x00b c", "x \n y",
           "<|endoftext|> b", "😀 é\nü", "\n", "12 3456,7 ?!"]
    docs = [*edge_docs, *((6000 + i, t, "en", f"s{i % 3}") for i, t in enumerate(odd))]
    rows = packing.pack(frame(spark, docs, ", start int, ids string", (1, "x")), VOCABULARY).collect()
    want = collections.Counter((i, tuple(x) + (0,)) for (i, *_), x in zip(docs, ids_of([d[1] for d in docs])))
    by = collections.defaultdict(list)
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length and r.length > 0
        by[r.doc_id, r.source].append(r)
    got = collections.Counter()
    for (doc, _), pieces in by.items():
        # repeated rows give several pieces per start: join them by start and length
        starts = collections.defaultdict(list)
        for p in pieces:
            starts[p.start].append(p)
        while starts:
            at, ids = 0, []
            total = None
            while total is None or at < total:
                options = starts[at]
                p = options.pop()
                if not options:
                    del starts[at]
                ids += np.frombuffer(p.ids, "<u4").tolist()
                at, total = at + p.length, p.doc_tokens
            got[doc, tuple(ids)] += 1
    singles = {i for i, n in collections.Counter(d[0] for d in docs).items() if n == 1}
    assert {k: v for k, v in got.items() if k[0] in singles} == {k: v for k, v in want.items() if k[0] in singles}
    places = sorted((r.sequence_id * 1024 + r.offset, r.length) for r in rows)
    at = 0
    for place, n in places:
        assert place == at and place % 1024 + n <= 1024
        at += n
    assert at == sum(len(k[1]) * v for k, v in want.items())


def test_ranks_give_the_ids_of_the_tokenizer(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    texts += ["x" * 9000 + " y", " " * 5000 + "z", "ab" * 400]
    for v in (VOCABULARY, packing.Vocabulary(PATH)):
        encoder = packing.Encoder(v)
        assert [encoder.encode(t).tolist() for t in texts] == ids_of(texts)


ENCODER = packing.Encoder(VOCABULARY)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=30) | st.text(alphabet="ab é\n\t '0.,S\u2003\u3000ſ\u0130", max_size=30), max_size=6))
def test_any_text_encodes_alike(texts):
    assert [ENCODER.encode(t).tolist() for t in texts] == ids_of(texts)


def test_windows_hold_the_mixture():
    tokens = [100_000, 30_000, 7_000, 1]
    phases = packing.schedule(tokens, None, 4096)
    plan, place = packing.Planner(phases), {}
    for q, n in enumerate(tokens):
        for start, at, length in plan.runs(q, 0, n):
            for i in range(length):
                assert at + i not in place
                place[at + i] = q
    assert sorted(place) == list(range(sum(tokens)))
    (p,) = phases
    for w in range(p.windows):
        first = [packing.served(n, w, p.windows) for n in p.takes]
        assert all(abs(f - Fraction(n * w, p.windows)) <= Fraction(1, 2) for f, n in zip(first, tokens))


def test_targets_hold_until_a_source_is_empty():
    tokens, targets = [50_000, 40_000, 5_000], [Fraction(1), Fraction(1), Fraction(2)]
    phases = packing.schedule(tokens, targets, 1000)
    assert phases[0].takes == (2500, 2500, 5000)
    assert [sum(p.takes[i] for p in phases) for i in range(3)] == tokens
    plan, seen = packing.Planner(phases), set()
    for q, n in enumerate(tokens):
        # any split of the queue gives the same places
        for cut in (0, 1, 777, 4999):
            one = [(a + s, p) for a, b in ((0, cut), (cut, n - cut)) for s, p, m in plan.runs(q, a, b)]
            assert len(one) >= 1
        for s, p, m in plan.runs(q, 0, n):
            seen.update(range(p, p + m))
    assert seen == set(range(sum(tokens)))


def test_empty_table(spark):
    assert packing.pack(frame(spark, []), VOCABULARY).collect() == []


def test_the_query_and_the_pipeline_encode_added_tokens_as_the_tokenizer_file(spark, tmp_path):
    import corpus_pipeline
    from chargeline.llm.queries import op7_packing

    texts = ["hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|><|endoftext|>b", "<|endoftext|", "plain", None]
    plain = Tokenizer.from_file(PATH)
    want = {i: [*plain.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    assert want[0] == [31373, 220, 50256, 995, 0]
    docs = frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for rows in (op7_packing(spark, str(tmp_path)), corpus_pipeline.packed(spark, docs, "")):
        got = {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in rows.collect()}
        assert got == {i: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want.items()}


def round_robin(tokens, targets, window):
    """Deficit round-robin step by step: the queue of every token, in order."""
    left, out = list(tokens), []
    while any(left):
        weight = [Fraction(n) if targets is None else t if n else Fraction(0) for n, t in zip(left, targets or tokens)]
        if not any(w and n for w, n in zip(weight, left)):
            weight = [Fraction(n) for n in left]
        rounds = min(n / w for n, w in zip(left, weight) if n and w)
        takes = [n if w * rounds == n else int(w * rounds) for n, w in zip(left, weight)]
        windows = -(-sum(takes) // window)
        deficit = [Fraction(0)] * len(left)
        for _ in range(windows):
            for q, n in enumerate(takes):
                deficit[q] += Fraction(n, windows)
                now = int(deficit[q] + Fraction(1, 2))
                deficit[q] -= now
                out += [q] * now
        left = [n - t for n, t in zip(left, takes)]
    return out


def test_closed_form_is_the_round_robin_step_by_step():
    import random

    rnd = random.Random(2)
    for _ in range(40):
        tokens = [rnd.randrange(0, 900) for _ in range(rnd.randrange(1, 8))]
        targets = rnd.choice([None, [Fraction(rnd.randrange(0, 5)) for _ in tokens]])
        window = rnd.choice([1, 7, 64, 500])
        plan, place = packing.Planner(packing.schedule(tokens, targets, window)), {}
        for q, n in enumerate(tokens):
            for s, at, length in plan.runs(q, 0, n):
                place.update((at + i, q) for i in range(length))
        assert [place[i] for i in range(sum(tokens))] == round_robin(tokens, targets, window)


def test_any_number_of_sources(spark):
    """10,000 sources and more: the largest have queues, the others share one; nothing is lost or doubled."""
    docs = [(i, "word " * (1 + i % 3), "en", f"host{i}") for i in range(10_000)]
    docs += [(20_000 + i, "a longer text " * 40, "en", None if i % 2 else "big") for i in range(60)]
    rows = packing.pack(frame(spark, docs).repartition(6), VOCABULARY, queues=5, temper=0.5).collect()
    assert {r.doc_id for r in rows} == {d[0] for d in docs}
    assert {(r.doc_id, r.source) for r in rows} == {(d[0], d[3]) for d in docs}
    total = dict(zip((d[0] for d in docs), (len(x) + 1 for x in ids_of([d[1] for d in docs]))))
    got = collections.Counter()
    for r in rows:
        got[r.doc_id] += r.length
    assert got == total
    at = 0
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.sequence_id * 1024 + r.offset == at
        at += r.length
    assert at == sum(total.values())


def test_tempered_targets_bring_small_sources_sooner(spark):
    docs = [(i, "a b c d e f g h " * 60, "en", "large") for i in range(200)] + [(1000 + i, "x y z " * 60, "en", "small") for i in range(20)]
    df = frame(spark, docs)
    pack = lambda **k: packing.pack(df, VOCABULARY, window_sequences=4, **k).collect()
    plain, tempered = pack(), pack(temper=0.5)
    where = lambda rows: max(r.sequence_id for r in rows if r.source == "small") / max(r.sequence_id for r in rows)
    assert where(plain) > 0.9 and where(tempered) < 0.7
    named = pack(targets={"small": 3, "large": 1})
    window = packing.schedule([sum(r.length for r in named if r.source == x) for x in ("large", "small")], [1, 3], 4096)[0]
    first = [r for r in named if r.sequence_id * 1024 + r.offset < sum(window.takes) // window.windows]
    share = sum(r.length for r in first if r.source == "small") / sum(r.length for r in first)
    assert abs(share - 0.75) < 0.01


def test_the_query_over_its_whole_table(spark):
    """Ids of the tokenizer file, each in one piece, sequences without gaps."""
    from chargeline.llm.queries import op7_packing

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    t = Tokenizer.from_file(PATH)
    ids = {i: np.array([*x.ids, 0], "<u4") for i, x in zip(texts, t.encode_batch(list(texts.values()), add_special_tokens=False))}
    rows = op7_packing(spark, "/root/testdata/sf0.001").collect()
    seen = collections.Counter()
    for r in rows:
        assert r.doc_tokens == len(ids[r.doc_id])
        assert zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes()) == r.ids_crc32
        seen.update((r.doc_id, x) for x in range(r.start, r.start + r.length))
    assert set(seen.values()) == {1} and len(seen) == sum(map(len, ids.values()))
    at = 0
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.sequence_id * 1024 + r.offset == at
        at += r.length
