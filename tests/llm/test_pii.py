import collections
import hashlib
import re

from chargeline.llm import pii
from tests.llm.conftest import frame

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c)
        total += x if i % 2 == 0 else (2 * x if x < 5 else 2 * x - 9)
    return total % 10 == 0


def base(text):
    text, out = text or "", []
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out += [(m.start(), 0, m.end(), "email") for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end(), "ip") for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(m.start(), 2, m.end(), "card") for m in CARD.finditer(text)
            if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end(), "phone") for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(out)


TRICKY = [
    "a@b.c_d@e.f and x.y@z.co.uk, é@ä.de ü a@b..c a@b", "@a.b a@@b.c a@b.c@d.e", "1.2.3.4.5.6.7.8 1.2.3.4. 256.1.1.1 0255.1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 4111  1111 1111 1111", "12345678901234567890123 79927398713",
    "call +1 (415) 555-2671 now, +49-30-1234567. +1.2 +0123456789012345", "ip 10.0.0.1:80 ä 10.0.0.1",
    "é 4111111111111111 ü +44 20 7946 0958 x@y.zz", "my iban is GB82 WEST 1234 5698 7654 32 ok", "GB82 WEST 1234 5698 7654 33",
    "ssn 078-05-1120" + " filler" * 12 + " version 078-05-1120", "", None, " ", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
    "😀 a@b.cd 😀 1.1.1.1", "aaaaaaaa" * 2000 + "@b.c", "9" * 40 + " " + "1.1.1.1." * 50]


def found(spark, docs):
    return pii.summary(pii.find(frame(spark, docs, ", found int, spans string", (1, "x")))).collect()


def test_base_kinds_match_brute_force(spark, edge_docs):
    docs = [*edge_docs, *((3000 + i, t) for i, t in enumerate(TRICKY))]
    got = collections.Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in found(spark, docs))
    want = collections.Counter()
    for i, t, *_ in docs:
        hits = base(t)
        n = collections.Counter(k for *_, k in hits)
        text = ",".join(f"{k}:{s}:{e}" for s, _, e, k in hits)
        want[i, n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(text.encode()).hexdigest()] += 1
    assert got == want


def test_added_kinds_and_context(spark):
    rows = {r.doc_id: r for r in found(spark, [(i, t) for i, t in enumerate(TRICKY)])}
    assert "iban:11:38" in rows[8].spans and "iban" not in rows[9].spans
    assert rows[10].spans == "national_id:4:15"


def test_redaction(spark):
    docs = [(1, "write to a@b.cd or 4111111111111111!"), (2, None), (3, "nothing"), (4, "é +44 20 7946 0958")]
    out = {r.doc_id: r.text for r in pii.redact(frame(spark, docs, ", _spans int", (1,))).collect()}
    assert out == {1: "write to [EMAIL] or [CARD]!", 2: None, 3: "nothing", 4: "é [PHONE]"}
    assert found(spark, []) == []


def test_no_python_in_the_plan(spark, small_docs):
    plan = pii.redact(frame(spark, small_docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("ArrowEval", "")


def test_ibans_before_other_tokens_and_near_invoices(spark):
    good = ["AT611904300234573201", "AT61 1904 3002 3457 3201", "BE68 5390 0754 7034", "ES9121000418450200051332",
            "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947", "FR14 2004 1010 0505 0001 3M02 606",
            "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "PL61 1090 1014 0000 0712 1981 2874"]
    texts = [f"{a}{x}{b}" for a in ("", "pay the invoice to ", "BE68 5390 0754 ", "XX00 1234 5678 ")
             for x in good for b in (" BIC BKAUATWW", " EUR 100", " BIC", " 1234 5678", ".", "")]
    want = [f"iban:{t.index(x)}:{t.index(x) + len(x)}" for t in texts for x in good if x in t]
    texts = [t for t in texts for x in good if x in t]
    rows = {r.doc_id: r for r in found(spark, [*enumerate(texts), (9000, "AT61 1904 3002 3457 3202 BIC"), (9001, "BE68 5390 0754 7034 X1"),
                                               (9002, "a DE89 3704 0044 0532 0130 00 b GB82WEST12345698765432 c")])}
    assert [w for i, w in enumerate(want) if w not in rows[i].spans.split(",")] == []
    assert "iban" not in rows[9000].spans and rows[9001].spans == "iban:0:19"
    assert rows[9002].spans == "iban:2:29,iban:32:54"
    assert {float(x) for r in rows.values() for k, x in zip(r.spans.split(","), r.scores.split(",")) if "iban" in k} <= {.5, .7, .95}


def test_redaction_of_an_iban_before_its_bic(spark):
    docs = [(1, "invoice AT61 1904 3002 3457 3201 BIC BKAUATWW")]
    assert [r.text for r in pii.redact(frame(spark, docs)).collect()] == ["invoice [IBAN] BIC BKAUATWW"]


def test_very_many_labels_and_hits_in_one_text(spark):
    """100,000 labels in one address (no recursion), 50,000 addresses in one text (no squares)."""
    import time

    docs = [(1, "x a@b" + ".c" * 100_000 + " y"), (2, "1.1.1.1 " * 50_000), (3, "1." * 50_000), (4, "+1 " + "(" * 100_000),
            (5, "a@b.c " * 30_000 + "é" * 5000 + " 4111111111111111"), (6, "token = " * 20_000), (7, "1-" * 60_000),
            (8, "GB82 WEST 1234 5698 7654 32 " * 5000), (9, "+1 415 555 2671;" * 10_000)]
    start = time.time()
    rows = {r.doc_id: r for r in found(spark, docs)}
    assert time.time() - start < 60
    for i, t in docs:
        hits = base(t)
        n = collections.Counter(k for *_, k in hits)
        text = ",".join(f"{k}:{s}:{e}" for s, _, e, k in hits)
        assert (rows[i].n_email, rows[i].n_ip, rows[i].n_card, rows[i].n_phone) == (n["email"], n["ip"], n["card"], n["phone"])
        assert rows[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert rows[1].n_email == 1 and rows[2].n_ip == 50_000 and rows[8].spans.count("iban") == 5000
    start = time.time()
    out = {r.doc_id: r.text for r in pii.redact(frame(spark, docs)).collect()}
    assert time.time() - start < 60
    assert out[1] == "x [EMAIL] y" and out[2] == "[IP] " * 50_000 and out[5] == "[EMAIL] " * 30_000 + "é" * 5000 + " [CARD]"


def test_secrets(spark):
    key = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    texts = [f'a token = "{key}" b', f"API_KEY:{key}", "AKIA" + "A1B2C3D4E5F6G7H8", "a token of appreciation and nothing else",
             "password: correct horse", "secret=aaaaaaaaaaaaaaaaaaaaaaaa1", f"mytoken = {key}", f"Bearer {key}."]
    rows = {r.doc_id: r for r in found(spark, enumerate(texts))}
    assert [rows[i].n_secret for i in range(len(texts))] == [1, 1, 1, 0, 0, 0, 0, 1]
    assert rows[0].spans.startswith("secret:2:") and rows[0].n_spans == rows[0].spans.count(",") + 1
    out = {r.doc_id: r.text for r in pii.redact(frame(spark, enumerate(texts))).collect()}
    assert out[0] == "a [SECRET] b" and out[3] == texts[3]


def test_running_sums_in_blocks(spark):
    import random

    from pyspark.sql import functions as F

    rnd = random.Random(1)
    rows = [([rnd.randrange(9) for _ in range(n)],) for n in (0, 1, 2, 63, 64, 65, 500, 5000)]
    df = spark.createDataFrame(rows, "v array<int>")
    for r in df.select("v", pii.running(F.col("v"), lambda a, x: a + x).alias("s"),
                       pii.running(F.col("v"), lambda a, x: F.greatest(a, x)).alias("m")).collect():
        assert r.s == [sum(r.v[:i]) for i in range(len(r.v) + 1)]
        assert r.m == [max(r.v[:i], default=0) for i in range(len(r.v) + 1)]


def test_redaction_matches_brute_force(spark, edge_docs):
    """Every span's text goes, everything else stays, whatever overlaps; short pieces are joined again."""
    docs = [*edge_docs, *((3000 + i, t) for i, t in enumerate(TRICKY))]
    df = frame(spark, docs).where("doc_id is not null").dropDuplicates(["doc_id"])
    hits = {r.doc_id: [x.split(":") for x in r.spans.split(",") if x] for r in pii.summary(pii.find(df)).collect()}
    texts = {r.doc_id: r.text for r in df.collect()}
    for r in pii.redact(df).collect():
        out, pos = "", 0
        for kind, s, e in hits[r.doc_id]:
            if int(s) >= pos:
                out += texts[r.doc_id][pos:int(s)] + f"[{kind.upper()}]"
            pos = max(pos, int(e))
        assert r.text == (None if texts[r.doc_id] is None else out + texts[r.doc_id][pos:])
