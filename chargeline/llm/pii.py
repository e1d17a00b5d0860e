"""Personal data: regular expressions propose, checksums confirm, context scores (native).

Every step is a Spark SQL expression. ``regexp_extract_all`` gives a kind's
leftmost, non-overlapping matches and ``split`` by the same pattern gives the
text between them, so the running sum of their lengths gives the positions
(code points, end exclusive). Candidates are then validated (Luhn, mod-97,
octet range, digit count, mixed characters) and scored from words near by: up
to ``CONTEXT_CHARS`` characters on either side, as far as two neighbouring
matches of the kind.

Base kinds (email, ip, card, phone) are kept whenever they are valid; their
score only informs. The method's own kinds (iban, national_id, secret) are kept
where the score reaches ``MIN_SCORE``; an account number of its country's length
and with right check digits never scores less.

Null and empty texts give no spans, and stay as they are when redacted. Repeated
rows are handled one by one. Spans that begin at one place come in the order of
the kinds; where spans overlap, redaction puts the first one's name. Very long
texts are handled whole: patterns that repeat a group do so without recursion,
and running sums are taken in blocks, so the work is about proportional to the
text and to n * sqrt(n) for n matches in one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "national_id", "secret")

#: Length of an account number by country, without spaces; a run of another country may have any length.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}


def _iban_pattern() -> str:
    """Four characters, the whole number looked ahead as group 1, so one inside a wrong one is tried too."""
    def body(n: int) -> str:
        q, r = divmod(n - 4, 4)
        return rf"[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{q}}}" + (rf"\x20?[A-Z0-9]{{{r}}}" if r else "")

    known = "|".join(codes.replace(" ", "|") for codes in IBAN_LENGTHS.values())
    each = "|".join(f"(?:{codes.replace(' ', '|')}){body(n)}" for n, codes in IBAN_LENGTHS.items())
    other = rf"(?!{known})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}(?:\x20?[A-Z0-9]{{1,3}})?"
    return rf"(?<![A-Za-z0-9])(?=((?:{each}|{other})(?![A-Za-z0-9])))[A-Z]{{2}}[0-9]{{2}}"


# The look-behind keeps a long word from being tried at each of its letters;
# \G lets a match begin right after the one before. Groups that may repeat often
# are possessive: nothing after them could match what they give back, and a
# greedy group would recurse once per repetition.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    # 14 digits at least: shorter runs match the base pattern but fail its count
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": _iban_pattern(),
    "national_id": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    # a named value, or a key of a known form
    "secret": (r"(?<![A-Za-z0-9_])(?:(?i:api[_-]?key|access[_-]?key|secret(?:[_-]?key)?|(?:auth[_-]?)?token|password|passwd|bearer)"
               r"[\"']?[\x20\t]{0,4}[:=]?[\x20\t]{0,4}[\"']?[A-Za-z0-9+/=_.-]{16,}+[\"']?"
               r"|AKIA[0-9A-Z]{16}(?![0-9A-Z])|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9_-]{20,}+)"),
}
#: A text without this cannot hold the kind, so its pattern is not tried.
NEEDS = {"email": "@", "ip": ".", "phone": "+", "national_id": "-"}
#: Group and length of what a match takes up, where the candidate is a group looked ahead.
AHEAD = {"iban": (1, 4)}
#: Score of a validated candidate before context.
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.5, "iban": 0.7, "national_id": 0.3, "secret": 0.6}
CONTEXT = {
    "email": "mail|contact|write|kontakt|correo|courriel",
    "ip": r"\bip\b|address|server|host|login|adresse",
    "card": "card|visa|credit|payment|karte|carte|tarjeta",
    "phone": "phone|call|tel|mobile|fax|ruf",
    "iban": "iban|account|bank|transfer|konto|compte|cuenta",
    "national_id": "ssn|social security|national id|identity|tax",
    "secret": "key|secret|token|login|auth|credential",
}
AGAINST = r"version|isbn|order no|invoice|example|serial"
CONTEXT_CHARS = 48
CONTEXT_GAIN = 0.25
MIN_SCORE = 0.5

#: Code points of a piece when a text with spans is cut up.
PIECE = 1024

_HIT = "array<struct<s:int,e:int,hit:string,near:string>>"
_OCTET = r"0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, add) -> Column:
    """For an array of ints: what ``add`` makes of all entries before each one, from 0, and of all at the end.

    Appending to an array copies it, so the array is cut into blocks of about the
    square root of its size.
    """
    def fold(xs: Column) -> Column:
        zero = F.struct(F.lit(0).alias("sum"), F.expr("CAST(array() AS array<int>)").alias("out"))
        return F.aggregate(xs, zero, lambda a, x: F.struct(
            add(a["sum"], x).alias("sum"), F.concat(a["out"], F.array(a["sum"])).alias("out")))

    def blocked(xs: Column) -> Column:
        size = F.greatest(F.lit(64), F.ceil(F.sqrt(F.size(xs))).cast("int"))
        starts = F.when(F.size(xs) > 0, F.sequence(F.lit(1), F.size(xs), size)).otherwise(F.expr("CAST(array() AS array<int>)"))
        return _let(F.transform(starts, lambda at: fold(F.slice(xs, at, size))), lambda blocks: _let(
            fold(F.transform(blocks, lambda b: b["sum"])), lambda tops: F.concat(
                F.flatten(F.zip_with(blocks, tops["out"], lambda b, t: F.transform(b["out"], lambda v: add(v, t)))),
                F.array(tops["sum"]))))

    return _let(values, blocked)


def candidates(text: Column, kind: str, check=lambda kind, hit: F.lit(True)) -> Column:
    """Matches of a kind's pattern that pass ``check``: positions, text, and the text around (lower case)."""
    p = F.lit(PATTERNS[kind])
    group, taken = AHEAD.get(kind, (0, None))

    def place(z: Column) -> Column:
        hits, gaps = z["hits"], z["gaps"]
        taken_up = (lambda h: F.length(h)) if taken is None else (lambda h: F.lit(taken))
        steps = F.transform(hits, lambda h, i: F.length(F.get(gaps, i)) + taken_up(h))

        def around(i: Column, hit: Column) -> Column:
            """What lies between the neighbours of the neighbouring matches, the match itself left out."""
            one, two = F.coalesce(F.get(gaps, i + 1), F.lit("")), F.coalesce(F.get(gaps, i + 2), F.lit(""))
            before = F.concat(F.when(i > 0, F.concat(F.get(gaps, i - 1), F.get(hits, i - 1))).otherwise(""), F.get(gaps, i))
            after = F.concat(one, F.coalesce(F.get(hits, i + 1), F.lit("")), two)
            if taken is not None:  # the rest of the match lies in the text after it
                before = F.get(gaps, i)
                after = F.substr(one, F.length(hit) - taken + 1)
            return F.lower(F.concat_ws(" ", F.right(before, F.lit(CONTEXT_CHARS)), F.left(after, F.lit(CONTEXT_CHARS))))

        good = F.filter(F.transform(hits, lambda h, i: F.struct(i.alias("i"), h.alias("hit"))), lambda x: check(kind, x["hit"]))
        return _let(running(steps, lambda a, x: a + x), lambda ends: F.transform(good, lambda x: _let(
            F.get(ends, x["i"]) + F.length(F.get(gaps, x["i"])), lambda s: F.struct(
                s.alias("s"), (s + F.length(x["hit"])).alias("e"), x["hit"].alias("hit"), around(x["i"], x["hit"]).alias("near")))))

    found = _let(F.struct(F.regexp_extract_all(text, p, F.lit(group)).alias("hits"), F.split(text, p, -1).alias("gaps")), place)
    none = F.expr(f"CAST(array() AS {_HIT})")
    if kind in NEEDS:
        return F.when(F.contains(text, F.lit(NEEDS[kind])), found).otherwise(none)
    return F.when(text.rlike(PATTERNS[kind]), found).otherwise(none)


def luhn(digits: Column) -> Column:
    """True if the check digit of a text of digits is right."""
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = F.when(d < 5, d * 2).otherwise(d * 2 - 9)
        return acc + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """True if an account number (no spaces) leaves 1 modulo 97, country and check digits last."""
    turned = F.concat(F.substr(account, F.lit(5)), F.substr(account, F.lit(1), F.lit(4)))

    def add(acc: Column, i: Column) -> Column:
        c = F.ascii(F.substr(turned, i, F.lit(1)))
        return F.when(c < 58, (acc * 10 + c - 48) % 97).otherwise((acc * 100 + c - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def valid(kind: str, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "ip":
        return hit.rlike(rf"^{_OCTET}(\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "iban":
        account = F.regexp_replace(hit, " ", "")
        return F.when(F.length(account).between(15, 34), mod97(account)).otherwise(False)
    if kind == "secret":  # not a word that only stands after such a name
        value = F.regexp_extract(hit, r"([A-Za-z0-9+/_.-]{16,}=*)[\"']?$", 1)
        return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(value, ""))) >= 8)
    return F.lit(True)


def confirmed(account: Column) -> Column:
    """True if an account number (checked, without spaces) has its country's length."""
    of = F.create_map(*[F.lit(x) for n, codes in IBAN_LENGTHS.items() for c in codes.split() for x in (c, n)])
    return F.coalesce(F.length(account) == F.try_element_at(of, F.substr(account, F.lit(1), F.lit(2))), F.lit(False))


def score(kind: str, x: Column) -> Column:
    """Prior of a candidate, plus or minus what the words near by say."""
    gain = F.when(x["near"].rlike(CONTEXT[kind]), CONTEXT_GAIN).otherwise(0.0)
    loss = F.when(x["near"].rlike(AGAINST), CONTEXT_GAIN).otherwise(0.0)
    least = F.lit(0.0)
    if kind == "iban":
        least = F.when(confirmed(F.regexp_replace(x["hit"], " ", "")), MIN_SCORE).otherwise(0.0)
    if kind == "secret":
        loss = F.lit(0.0)
    return F.round(F.least(F.lit(1.0), F.greatest(least, F.lit(PRIOR[kind]) + gain - loss)), 2)


def spans(text: Column) -> Column:
    """All kept spans in order of start and kind: struct(start, rank, end, kind, score)."""
    def of(rank: int, kind: str) -> Column:
        rows = F.transform(candidates(text, kind, valid), lambda x: F.struct(
            x["s"].alias("start"), F.lit(rank).alias("rank"), x["e"].alias("end"), F.lit(kind).alias("kind"),
            score(kind, x).alias("score")))
        return rows if kind in BASE_KINDS else F.filter(rows, lambda x: x["score"] >= MIN_SCORE)

    return F.array_sort(F.concat(*[of(rank, kind) for rank, kind in enumerate(KINDS)]))


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and its spans; one row per input row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(id_col).alias("doc_id"), text.alias("text")).select(
        "doc_id", spans(F.col("text")).alias("found"))


def summary(found: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans, and all spans as text."""
    def joined(xs: Column) -> Column:
        return F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("found", lambda x: x["rank"] < len(BASE_KINDS))
    return found.select(
        "doc_id", *[count(k) for k in BASE_KINDS], F.size("found").cast("long").alias("n_spans"), count("secret"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"),
        F.array_join(F.transform("found", lambda x: F.format_string("%.2f", x["score"])), ",").alias("scores"))


def redact(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows with every span replaced by ``[KIND]``; overlapping spans become one."""
    text = F.col(text_col)

    def cut(pieces: Column, a: Column, b: Column) -> Column:
        """Code points a to b, from pieces of ``PIECE``: only the pieces concerned are looked at."""
        first, last = F.floor(a / PIECE).cast("int"), F.floor((b - 1) / PIECE).cast("int")
        near = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
        return F.when(b > a, F.substr(near, a - first * PIECE + 1, b - a)).otherwise("")

    def clean(z: Column) -> Column:
        def joined(reach: Column) -> Column:
            # reach[i] is where the spans before the i-th end
            kept = F.filter(F.transform(z["found"], lambda x, i: F.struct(
                F.get(reach, i).alias("from"), x["start"].alias("start"), x["kind"].alias("kind"))), lambda x: x["start"] >= x["from"])
            parts = F.transform(kept, lambda x: F.concat(
                cut(z["pieces"], x["from"], x["start"]), F.lit("["), F.upper(x["kind"]), F.lit("]")))
            return F.concat(F.array_join(parts, ""), cut(z["pieces"], F.element_at(reach, -1), z["n"]))

        return _let(running(F.transform(z["found"], lambda x: x["end"]), lambda a, x: F.greatest(a, x)), joined)

    name = "_spans"
    while name in df.columns:
        name = "_" + name
    whole = F.struct(F.col(name).alias("found"), F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)).alias("pieces"),
                     F.length(text).alias("n"))
    return (df.withColumn(name, spans(F.coalesce(text, F.lit(""))))
            .withColumn(text_col, F.when(F.size(name) > 0, _let(whole, clean)).otherwise(text)).drop(name))
