"""Substring dedup by content-defined chunking with a gear rolling hash.

A chunk ends where the gear hash of the last 16 bytes falls below a limit, so
cut points depend on the bytes around them alone and an insertion moves none
but its own. Chunks are deduplicated by a 128-bit digest and length. The
document with the smallest id keeps a chunk (its first place there); every
other place is a duplicate. Adjoining duplicates form a run. ``EVERY_RUN``
reports all of them, whole texts of a few bytes included, for the caller to
filter by length (``end_byte - first_byte``); ``DEFAULT_CHUNKING`` leaves out runs
under ``min_run_bytes``, mostly lines and phrases that ordinary texts share.

Counting goes through map-side aggregates per digest, so a chunk held by a
third of all documents is no large group. Marking joins the digests found in
two documents or more back to the places; those with more than one in
``HOT_SHARE`` of these places, so that many at most, are broadcast, and their
places are spread over all tasks.

Null and empty texts have no chunks. Rows that share a doc_id count as one
document (their copies of each other are not reported). A row without an id is a
document of its own, before all others; ``remove`` leaves such rows alone. Very
long texts are chunked whole, by one task. Of equal chunks in one text the first
is kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from chargeline.llm import text as tx
from chargeline.llm.frames import stored

GEAR32 = (tx.GEAR >> np.uint64(32)).astype(np.uint32)


@dataclass(frozen=True)
class Chunking:
    mean_bytes: int = 32
    #: A cut is dropped if another candidate lies within so many bytes before it.
    min_bytes: int = 8
    #: Stretches without a cut are cut every so many bytes.
    max_bytes: int = 1024
    min_run_bytes: int = 96


DEFAULT_CHUNKING = Chunking()
EVERY_RUN = Chunking(min_run_bytes=1)
WINDOW = 16
#: Digests of fewer places than this are never broadcast.
HOT_FROM = 1000
#: A digest with more than one in so many of the shared places is joined by broadcast.
HOT_SHARE = 2000
#: Rows without an id are numbered from here on; ids lie above the next bound.
_NO_ID, _IDS = -(1 << 63), -(1 << 63) + (1 << 61)
#: Bytes inside a character: no chunk begins with one.
_CONTINUES = np.zeros(256, bool)
_CONTINUES[0x80:0xC0] = True


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash of the 16 bytes that end at each byte (fewer at the start)."""
    h = GEAR32[data]
    step = 1
    while step < WINDOW:
        h[step:] += h[:-step] << np.uint32(step)
        step *= 2
    return h


def chunks(data: np.ndarray, off: np.ndarray, how: Chunking = DEFAULT_CHUNKING):
    """Start, end and document of every chunk of a slice."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    at = np.flatnonzero(gear(data) < np.uint32((1 << 32) // how.mean_bytes)) + 1
    docs = np.searchsorted(off, at - 1, "right") - 1
    whole = at - off[docs] >= WINDOW
    whole &= ~_CONTINUES[data[np.minimum(at, n - 1)]]
    at = at[whole]
    lone = np.ones(len(at), bool)
    lone[1:] = np.diff(at) >= how.min_bytes
    edges = np.unique(np.concatenate([at[lone], off]))
    start, size = edges[:-1], np.diff(edges)
    pieces = -(-size // how.max_bytes)
    k = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    s = np.repeat(start, pieces) + k * how.max_bytes
    for _ in range(3):  # a character is at most 4 bytes
        s += (k > 0) & _CONTINUES[data[s]]
    e = np.append(s[1:], n)
    return s, e, np.searchsorted(off, s, "right") - 1


_OTHER = np.argsort(tx.mix(np.arange(1000, 1256, dtype=np.uint64))).astype(np.uint8)


def digests(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of every chunk."""
    return tx.span_hashes(data, s, e), tx.span_hashes(_OTHER[data], s, e)


CHUNK = "doc long, start long, length int, h1 long, h2 long, again boolean"


def places(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           how: Chunking = DEFAULT_CHUNKING) -> DataFrame:
    """Every chunk of every text; ``again`` marks one that occurs earlier in the same text."""
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for a, b, data, off in tx.slices(batch.column(1)):
                s, e, d = chunks(data, off, how)
                h1, h2 = digests(data, s, e)
                key = tx.mix(h1 ^ tx.mix(d.astype(np.uint64) + np.uint64(1)))
                order = np.argsort(key, kind="stable")
                again = np.zeros(len(s), bool)
                again[order[1:]] = key[order[1:]] == key[order[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a).take(pa.array(d)), pa.array(s - off[d]), pa.array((e - s).astype(np.int32)),
                     pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(again)],
                    names=["doc", "start", "length", "h1", "h2", "again"])

    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID) + F.monotonically_increasing_id())
    return df.select(doc.alias("doc"), F.col(text_col).alias("text")).mapInArrow(run, CHUNK)


def duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               how: Chunking = DEFAULT_CHUNKING) -> DataFrame:
    """doc_id, first and end byte, chunks and keeping document of every run of duplicate chunks."""
    known = places(df, id_col, text_col, how)
    shared = stored(known.groupBy("h1", "h2").agg(F.min("doc").alias("kept"), F.max("doc").alias("_last"),
                                                  F.max("again").alias("_again"), F.count(F.lit(1)).alias("n"))
                    .where((F.col("kept") < F.col("_last")) | F.col("_again")).select("h1", "h2", "kept", "n"), "shared")
    often = (shared.agg(F.sum("n")).first()[0] or 0) // HOT_SHARE
    hot = F.broadcast(shared.where(F.col("n") > often).where(f"n > {HOT_FROM}")  # HOT_SHARE rows at most
                      .select("h1", "h2", F.col("kept").alias("_hot")))
    rest = shared.where((F.col("n") <= often) | (F.col("n") <= HOT_FROM)).select(
        F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "kept")
    told = (known.join(hot, ["h1", "h2"], "left")
            .withColumn("_key", F.when(F.col("_hot").isNull(), F.col("h1")).otherwise(F.xxhash64("doc", "start"))))
    marked = (told.join(rest, (F.col("_key") == F.col("_h1")) & (F.col("h2") == F.col("_h2")), "left")
              .withColumn("kept", F.coalesce("_hot", "kept"))
              .where("kept is not null and (doc > kept or again)")
              .select("doc", "start", "length", "kept"))
    by_doc = Window.partitionBy("doc").orderBy("start")
    runs = (marked.withColumn("_new", (F.col("start") > F.coalesce(
                F.lag(F.col("start") + F.col("length")).over(by_doc), F.lit(-1))).cast("int"))
            .withColumn("_run", F.sum("_new").over(by_doc.rowsBetween(Window.unboundedPreceding, 0))))
    return (runs.groupBy("doc", "_run")
            .agg(F.min("start").alias("first_byte"), F.max(F.col("start") + F.col("length")).alias("end_byte"),
                 F.count(F.lit(1)).alias("n_chunks"), F.min("kept").alias("kept"))
            .where(F.col("end_byte") - F.col("first_byte") >= how.min_run_bytes)
            .select(F.when(F.col("doc") >= _IDS, F.col("doc")).alias("doc_id"), "first_byte", "end_byte", "n_chunks",
                    F.when(F.col("kept") >= _IDS, F.col("kept")).alias("kept_doc_id")))


def remove(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           how: Chunking = DEFAULT_CHUNKING) -> DataFrame:
    """The rows with the reported runs cut out of their texts."""
    cuts = (duplicates(df, id_col, text_col, how).where("doc_id is not null").groupBy("doc_id")
            .agg(F.array_sort(F.collect_list(F.struct("first_byte", "end_byte"))).alias("_cuts"))
            .withColumnRenamed("doc_id", "_cut_id"))
    raw = F.col(text_col).cast("binary")
    folded = F.aggregate(
        F.col("_cuts"), F.struct(F.lit(0).cast("long").alias("pos"), F.lit(b"").alias("out")),
        lambda acc, x: F.struct(x["end_byte"].alias("pos"), F.concat(
            acc["out"], F.substr(raw, (acc["pos"] + 1).cast("int"),
                                 (x["first_byte"] - acc["pos"]).cast("int"))).alias("out")))
    rest = F.concat(folded["out"], F.substr(raw, (folded["pos"] + 1).cast("int")))
    return (df.join(cuts, F.col(id_col).eqNullSafe(F.col("_cut_id")), "left")
            .withColumn(text_col, F.when(F.col("_cuts").isNull(), F.col(text_col)).otherwise(rest.cast("string")))
            .drop("_cuts", "_cut_id"))
