"""Language identification with error-correcting output codes.

Every language gets a codeword. For each bit a binary n-gram classifier tells
the languages with a 1 from those with a 0: the mean log odds of the text's
byte n-grams (2 to 4 bytes, hashed), scaled so that the two sides' expected
values are +1 and -1. Decoding compares the margins with every codeword by a
logistic loss, each bit weighted by how well its sides are separated; the
least total loss wins. A small lead over the runner-up is flagged ambiguous.

Training reads the text and language of rows that are not held out. It uses a
hash-chosen sample of about ``SAMPLE_PER_LANG`` rows of each language (all rows
of a language that has fewer), so the model's size and cost are bounded. A row
without a doc_id counts as held out; repeated rows are learned from and told
alike. Languages whose losses tie go to the first by name. Very long texts are
read whole, by one task. The model holds some 50,000 numbers a language, on the
driver and on every executor. Text that is null or has no letter gives
``und`` and score 0, as does everything if there is nothing to learn from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chargeline.llm import text as tx

SAMPLE_PER_LANG = 5000
ORDERS = (2, 3, 4)
BUCKETS = 1 << 14
SMOOTHING = 0.5
SHARPNESS = 4.0
AMBIGUOUS_LEAD = 0.2
UNDETERMINED = "und"

_FOLD = np.full(256, 0x20, np.uint8)
for _b in [*range(65, 91), *range(97, 123)]:
    _FOLD[_b] = _b | 0x20
_FOLD[0x80:] = np.arange(0x80, 0x100)
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def features(data: np.ndarray, off: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of one order, those of each document together, and each one's document."""
    folded = _FOLD[data]
    n = len(folded) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = folded[:n].astype(np.uint32)
    letters = folded[:n] != 0x20
    for i in range(1, order):
        code = (code << np.uint32(8)) | folded[i:i + n]
        letters |= folded[i:i + n] != 0x20
    docs = np.repeat(np.arange(len(off) - 1, dtype=np.int32), np.diff(off))
    ok = letters & (docs[:n] == docs[order - 1:])
    h = (code * np.uint32(0x9E3779B1)) >> np.uint32(18)
    return h[ok].astype(np.int64) + (order - ORDERS[0]) * BUCKETS, docs[:n][ok]


def codewords(k: int) -> np.ndarray:
    """One codeword of +1 and -1 for each of k classes.

    Up to 5 classes the exhaustive code: a bit for every split into two sides.
    Beyond, columns drawn by a fixed rule, 15 for each doubling of k.
    """
    if k <= 1:
        return np.ones((k, 1), np.int8)
    if k <= 5:
        cols = [[1] + [1 if (m >> i) & 1 else -1 for i in range(k - 1)] for m in range(2 ** (k - 1) - 1)]
        return np.array(cols, np.int8).T
    bits = 15 * int(np.ceil(np.log2(k)))
    draws = tx.mix(np.arange(k * bits * 4, dtype=np.uint64) + np.uint64(1)) & np.uint64(1)
    cols = (draws.astype(np.int8) * 2 - 1).reshape(-1, k)
    mixed = cols[np.abs(cols.sum(1)) < k]
    return mixed[:bits].T


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray       # classes x bits
    weights: np.ndarray    # features x bits
    middle: np.ndarray     # per bit
    scale: np.ndarray      # per bit
    strength: np.ndarray   # per bit, sums to 1

    def margins(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        n = len(off) - 1
        total, count = np.zeros((n, self.code.shape[1])), np.zeros(n)
        for order in ORDERS:
            h, docs = features(data, off, order)
            if not len(h):
                continue
            first = np.flatnonzero(np.r_[True, docs[1:] != docs[:-1]])
            total[docs[first]] += np.add.reduceat(self.weights[h], first, axis=0)
            count += np.bincount(docs, minlength=n)
        mean = total / np.maximum(count, 1)[:, None]
        return np.clip((mean - self.middle) / self.scale, -3, 3)

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best class, its share of the evidence (0 to 1), and its lead over the next."""
        loss = np.log1p(np.exp(-SHARPNESS * margins[:, None, :] * self.code[None])) @ self.strength
        like = np.exp(-SHARPNESS * (loss - loss.min(1, keepdims=True)))
        share = like / like.sum(1, keepdims=True)
        best = share.argmax(1)
        top = share[np.arange(len(best)), best]
        rest = share.copy()
        rest[np.arange(len(best)), best] = 0
        return best, top, top - rest.max(1) if share.shape[1] > 1 else top


def fit(counts: dict[str, np.ndarray]) -> Model | None:
    """The bit classifiers from each language's n-gram counts."""
    langs = sorted(k for k, v in counts.items() if v.sum())
    if not langs:
        return None
    code = codewords(len(langs))
    p = np.array([counts[k] + SMOOTHING for k in langs], float)
    p /= p.sum(1, keepdims=True)
    if len(langs) == 1:
        return Model(langs, code, np.zeros((p.shape[1], 1), np.float32), np.zeros(1), np.ones(1), np.ones(1))
    weights, middle, scale, strength = [], [], [], []
    for bit in code.T:
        one, zero = p[bit > 0].mean(0), p[bit < 0].mean(0)
        w = np.log(one / zero)
        each = p @ w
        hi, lo = each[bit > 0].min(), each[bit < 0].max()
        weights.append(w)
        middle.append((hi + lo) / 2)
        scale.append(max((hi - lo) / 2, 1e-3))
        strength.append(max(hi - lo, 1e-3))
    s = np.array(strength)
    return Model(langs, code, np.array(weights, np.float32).T.copy(), np.array(middle), np.array(scale), s / s.sum())


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_per_lang: int = SAMPLE_PER_LANG) -> Model | None:
    """Fit on rows that are not held out; see the module's docstring."""
    rows = (df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
            .where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()))
    have = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not have:
        return None
    share = F.create_map(*[x for k, n in have.items() for x in (F.lit(k), F.lit(min(1.0, sample_per_lang / n)))])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = rows.where(draw < share[F.col("lang")]).select("lang", "text").repartition(8)
    size = len(ORDERS) * BUCKETS

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for a, b, data, off in tx.slices(batch.column(1)):
                names, which = np.unique(langs[a:b].astype(str), return_inverse=True)
                for order in ORDERS:
                    h, docs = features(data, off, order)
                    for i, name in enumerate(names):
                        total.setdefault(name, np.zeros(size, np.int64))
                        total[name] += np.bincount(h[which[docs] == i], minlength=size)
        for name, c in total.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                              pa.array(c[at])], names=["lang", "feature", "n"])

    summed = (sample.mapInArrow(count, "lang string, feature int, n long")
              .groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow())
    counts = {k: np.zeros(size) for k in have}
    langs, at, n = (summed.column(i).to_numpy(zero_copy_only=False) for i in range(3))
    for k in have:
        mine = langs == k
        counts[k][at[mine]] = n[mine]
    return fit(counts)


def predict(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score and ambiguous of every row, from its text alone."""
    rows = df.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                     F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("held_out", T.BooleanType()),
                           T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                           T.StructField("ambiguous", T.BooleanType())])
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            for a, b, data, off in tx.slices(batch.column(2)):
                n = b - a
                lettered = tx.per_doc(_ASCII_LETTER[data], off) > 0
                for i in np.flatnonzero(~lettered & (np.diff(off) > 0)):
                    lettered[i] = any(c.isalpha() for c in data[off[i]:off[i + 1]].tobytes().decode())
                if m is None:
                    lettered[:] = False
                    best, top, lead = np.zeros(n, int), np.zeros(n), np.zeros(n)
                else:
                    best, top, lead = m.decode(m.margins(data, off))
                names = [m.langs[k] if ok else UNDETERMINED for k, ok in zip(best, lettered)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, n), batch.column(1).slice(a, n), pa.array(names, pa.string()),
                     pa.array(np.where(lettered, top, 0.0)), pa.array(~lettered | (lead < AMBIGUOUS_LEAD))],
                    names=schema.names)

    return rows.mapInArrow(run, schema)
