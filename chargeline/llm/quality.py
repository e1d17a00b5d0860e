"""Quality rules: compression bands.

A document is kept if the zstandard ratio (compressed to raw bytes) of the whole
text lies within the band for its length, and no more than ``MAX_ODD_CHUNKS`` of
its fixed chunks lie outside the chunk band. Low ratios mean repetition, high
ones text without structure (encoded or random data); short texts compress
badly whatever they say, so the bands depend on the length.

Null and empty texts fail the base rules (no words). Words are maximal runs
of bytes other than space and tab to carriage return. Every row gives one row,
repeated ones alike. Very long texts are read whole, by one task; nothing is
ranked, so there are no ties.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from chargeline.llm import text as tx

SYMBOLS = np.zeros(256, np.int64)
SYMBOLS[list(b"#*$%&|<>")] = 1
NOT_LEAD = np.zeros(256, bool)
NOT_LEAD[0x80:0xC0] = True


@dataclass(frozen=True)
class Bands:
    """(bytes from, lowest ratio, highest ratio), by ascending length."""

    whole: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 99.0), (64, 0.35, 1.30), (128, 0.30, 1.10), (256, 0.25, 0.98), (512, 0.22, 0.90),
        (1024, 0.20, 0.82), (4096, 0.18, 0.76), (16384, 0.15, 0.72))
    chunk_bytes: int = 2048
    chunk: tuple[float, float] = (0.15, 0.80)
    max_odd_chunks: float = 0.34
    level: int = 3

    def limits(self, n: int) -> tuple[float, float]:
        at = 0
        for i, (start, _, _) in enumerate(self.whole):
            if n >= start:
                at = i
        return self.whole[at][1:]


DEFAULT_BANDS = Bands()


@dataclass(frozen=True)
class Base:
    """Base limits: fewest words, and the highest share of repeated words in per cent."""

    min_words: int = 50
    max_repeat: int = 50


DEFAULT_BASE = Base()

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
    T.StructField("word_chars", T.LongType()), T.StructField("n_symbols", T.LongType()),
    T.StructField("n_dup_lines", T.LongType()), T.StructField("n_repeat_words", T.LongType()),
    T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
    T.StructField("ratio", T.DoubleType()), T.StructField("odd_chunks", T.DoubleType())])


def _distinct(docs: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per document the number of distinct hashes; per item whether its hash is found again there."""
    key = tx.mix(hashes ^ tx.mix(docs.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    k = key[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    last = np.ones(len(k), bool)
    last[:-1] = new[1:]
    again = np.empty(len(k), bool)
    again[order] = ~(new & last)
    return np.bincount(docs[order][new], minlength=n), again


def base_counts(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each document of a slice."""
    n = len(off) - 1
    is_word = tx.SPACE_WORDS[data]
    s, e, d = tx.runs(is_word, off)
    out = {"n_words": np.bincount(d, minlength=n), "word_chars": tx.per_doc(is_word & ~NOT_LEAD[data], off),
           "n_symbols": tx.per_doc(SYMBOLS[data], off)}
    ls, le, ld = tx.runs(data != 10, off)
    worded = np.zeros(len(data) + 1, np.int64)
    np.cumsum(is_word, out=worded[1:])
    full = worded[le] > worded[ls]
    ls, le, ld = ls[full], le[full], ld[full]
    lines, _ = _distinct(ld, tx.span_hashes(data, ls, le), n)
    out["n_dup_lines"] = np.bincount(ld, minlength=n) - lines
    h, first = tx.windows(tx.span_hashes(data, s, e), d, 3)
    _, again = _distinct(d[first], h, n)
    cover = np.zeros(len(s), bool)
    at = first[again]
    for i in range(3):
        cover[at + i] = True
    out["n_repeat_words"] = np.bincount(d[cover], minlength=n)
    return out


def ratios(text: bytes, packer: zstandard.ZstdCompressor, bands: Bands) -> tuple[float, float]:
    """Ratio of the whole text, and the share of chunks outside the chunk band.

    The last chunk is the last ``chunk_bytes`` of the text, so no byte is left
    out; a text shorter than a chunk has the band of its length alone.
    """
    if not text:
        return 0.0, 0.0
    whole = len(packer.compress(text)) / len(text)
    size, (low, high) = bands.chunk_bytes, bands.chunk
    if len(text) < size:
        return whole, 0.0
    starts = [*range(0, len(text) - size, size), len(text) - size]
    odd = sum(not low <= len(packer.compress(text[i:i + size])) / size <= high for i in starts)
    return whole, odd / len(starts)


def _verdicts(column: pa.Array, bands: Bands, base: Base) -> Iterator[tuple[int, int, dict[str, np.ndarray]]]:
    packer = zstandard.ZstdCompressor(level=bands.level)
    for a, b, data, off in tx.slices(column):
        out = base_counts(data, off)
        out["base_failed"] = (out["n_words"] < base.min_words) | (
            100 * out["n_repeat_words"] > base.max_repeat * out["n_words"])
        whole, odd, good = np.empty(b - a), np.empty(b - a), np.empty(b - a, bool)
        for i in range(b - a):
            raw = data[off[i]:off[i + 1]].tobytes()
            whole[i], odd[i] = ratios(raw, packer, bands)
            low, high = bands.limits(len(raw))
            good[i] = low <= whole[i] <= high and odd[i] <= bands.max_odd_chunks
        out |= {"ratio": whole, "odd_chunks": odd, "kept": good & ~out["base_failed"]}
        yield a, b, out


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: Bands = DEFAULT_BANDS,
          base: Base = DEFAULT_BASE) -> DataFrame:
    """Base counts, ratios and verdict of every document."""
    def run(batches):
        for batch in batches:
            for a, b, v in _verdicts(batch.column(1), bands, base):
                ids = batch.column(0).slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [ids, *[pa.array(v[f.name].astype(np.int64)) for f in SCHEMA.fields[1:6]],
                     pa.array(v["base_failed"]), pa.array(v["kept"]), pa.array(v["ratio"]),
                     pa.array(v["odd_chunks"])], names=SCHEMA.names)

    schema = T.StructType([T.StructField("doc_id", df.schema[id_col].dataType), *SCHEMA.fields[1:]])
    return df.select(id_col, text_col).mapInArrow(run, schema)


def keep(df: DataFrame, text_col: str = "text", bands: Bands = DEFAULT_BANDS,
         base: Base = DEFAULT_BASE) -> DataFrame:
    """The rows whose text passes, with all their columns."""
    at = df.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for a, b, v in _verdicts(batch.column(at), bands, base):
                yield batch.slice(a, b - a).filter(pa.array(v["kept"]))

    return df.mapInArrow(run, df.schema)
