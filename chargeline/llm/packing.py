"""Mixture-controlled packing by deficit round-robin over source queues.

Documents are tokenised once and queue up by source, in input order. A window
takes from every queue its share of the window's tokens; what a queue is owed
beyond whole tokens is carried to its next window. In closed form, window ``w``
of ``K`` takes from a queue of ``n`` tokens those numbered from
``served(w)`` up to ``served(w + 1)`` with ``served(w) = round(w * n / K)``:
the running deficit ``w * n / K - served(w)`` never leaves half a token either
way, and every partition continues from the exact deficits without seeing the
windows before. Windows are laid end to end and cut into sequences, so only the
last sequence holds padding.

Without ``targets`` the mixture is the corpus's own token proportions and all
queues end together. With ``targets`` the queues are served in their
proportions until one is empty; from there on the others share what is left
in proportion (a new phase), until nothing remains. ``temper`` gives targets by
rule: each queue's token count to that power, so small sources come sooner.

Any number of sources is packed. The ``QUEUES`` with the most bytes of text, and
those that ``targets`` names, have a queue of their own; the documents of all
others share one more, in input order, whose share is theirs together.

Null text is packed as an empty document (its end id alone); a null source is a
source like any other; repeated rows are packed each; an empty table packs nothing.
Very long texts are encoded whole, by one task, and cut at windows and sequences.
Queues of equal size are ordered by name.
"""

from __future__ import annotations

import base64
import re
import zlib
from bisect import bisect_right
from dataclasses import dataclass
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chargeline.llm.frames import offsets, stored

SEQUENCE_TOKENS = 1024
WINDOW_SEQUENCES = 64
END_ID = 0
#: Sources with a queue of their own; a schedule holds a number per queue and phase.
QUEUES = 512

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType())])


@dataclass(frozen=True)
class Vocabulary:
    """A tokenizer file; where the same byte-level vocabulary is given as ranks with its pattern, they do the bulk.

    With ``added`` the content of an added token in a text is that token, as the
    tokenizer file has it; without, it is text like any other.
    """

    path: str
    ranks: str | None = None
    pattern: str | None = None
    added: bool = False


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit numbers.

    Both libraries give the same ids. The one for ranks is faster, but slow on
    very long stretches without a break or of nothing but white space, and has no
    added tokens, so texts with such a stretch or token go to the other.
    """

    LONG_STRETCH = re.compile(r"\S{2048}|\s{2048}")

    def __init__(self, vocabulary: Vocabulary):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary.path)
        self.tokenizer.encode_special_tokens = not vocabulary.added
        contents = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if vocabulary.added else []
        self.slow = re.compile("|".join([self.LONG_STRETCH.pattern, *map(re.escape, contents)]))
        self.fast = None
        if vocabulary.ranks:
            import tiktoken

            with open(vocabulary.ranks, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str | None) -> np.ndarray:
        text = text or ""
        if self.fast is None or self.slow.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)


@dataclass(frozen=True)
class Phase:
    """Queues served side by side: where each one starts, and how much of it the phase takes."""

    base: int
    windows: int
    starts: tuple[int, ...]
    takes: tuple[int, ...]


def schedule(tokens: list[int], targets: list[Fraction] | None, window: int) -> list[Phase]:
    """Phases that take every token of every queue."""
    left, starts, base, phases = list(tokens), [0] * len(tokens), 0, []
    while any(left):
        active = [i for i, n in enumerate(left) if n]
        weight = {i: Fraction(left[i]) if targets is None else targets[i] for i in active}
        if any(w <= 0 for w in weight.values()):
            rest = [i for i in active if weight[i] > 0]
            weight = {i: weight[i] for i in rest} if rest else {i: Fraction(left[i]) for i in active}
        rounds = min(Fraction(left[i]) / w for i, w in weight.items())
        takes = [0] * len(left)
        for i, w in weight.items():
            takes[i] = left[i] if w * rounds == left[i] else int(w * rounds)
        total = sum(takes)
        phases.append(Phase(base, -(-total // window), tuple(starts), tuple(takes)))
        base += total
        for i, n in enumerate(takes):
            starts[i] += n
            left[i] -= n
    return phases


def served(n: int, w: int, windows: int) -> int:
    """Tokens of a queue of n taken by the first w of so many windows (rounded half up)."""
    return (2 * n * w + windows) // (2 * windows)


def many_served(n: np.ndarray, w: int, windows: int) -> np.ndarray:
    """``served`` of many queues; products stay below 2 * windows^2."""
    whole, rest = np.divmod(n, windows)
    return whole * w + (2 * rest * w + windows) // (2 * windows)


class Planner:
    """Where each token of each queue goes."""

    def __init__(self, phases: list[Phase]):
        self.phases = phases

        takes = [np.array(p.takes, np.int64) for p in phases]

        @lru_cache(maxsize=256)
        def window(k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
            """First token of every queue in a window, and the window's place of that token."""
            p = phases[k]
            first, end = many_served(takes[k], w, p.windows), many_served(takes[k], w + 1, p.windows)
            part = end - first
            return first, p.base + int(first.sum()) + np.cumsum(part) - part

        self.window = window

    def runs(self, queue: int, start: int, length: int):
        """(tokens from start, place, length) of each stretch that stays together."""
        at, end = start, start + length
        k = bisect_right([p.starts[queue] for p in self.phases], at) - 1
        while at < end:
            p = self.phases[k]
            n, u = p.takes[queue], at - p.starts[queue]
            if u >= n:
                k += 1
                continue
            w = (2 * u + 1) * p.windows // (2 * n)
            while served(n, w + 1, p.windows) <= u:
                w += 1
            while served(n, w, p.windows) > u:
                w -= 1
            stop = min(end, p.starts[queue] + served(n, w + 1, p.windows))
            first, places = self.window(k, w)
            yield at - start, int(places[queue]) + u - int(first[queue]), stop - at
            at = stop


def queue_of(source) -> Column:
    """Name of a source's own queue."""
    return F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source.cast("string")))


#: The queue that all other sources share.
POOL = "p"


def own_queues(df: DataFrame, targets: dict | None, text_col: str, source_col: str, queues: int = QUEUES) -> list[str]:
    """The sources with a queue of their own: those in ``targets``, and the largest by bytes of text."""
    named = ["n" if x is None else f"s{x}" for x in targets or ()]
    size = (df.select(queue_of(F.col(source_col)).alias("queue"), F.octet_length(F.col(text_col)).alias("bytes"))
            .groupBy("queue").agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")))
    largest = size.orderBy(F.desc("bytes"), "queue").limit(queues).collect()
    return sorted({*named, *(r["queue"] for r in largest)})


def tokenise(df: DataFrame, vocabulary: Vocabulary, own: list[str], id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source") -> DataFrame:
    """One row per document: queue, source, block, its first token in the block's queue, and its ids."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                     F.col(source_col).cast("string").alias("source"), queue_of(F.col(source_col)).alias("queue"))
    known = frozenset(own)

    def run(batches):
        encoder = Encoder(vocabulary)
        end = np.array([END_ID], "<u4")
        block, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                texts = batch.column(1).slice(i, 512)
                queues = [q if q in known else POOL for q in batch.column(3).slice(i, 512).to_pylist()]
                ids = [np.concatenate([encoder.encode(t.as_py()), end]) for t in texts]
                starts = []
                for q, x in zip(queues, ids):
                    starts.append(seen.get(q, 0))
                    seen[q] = starts[-1] + len(x)
                wide = 2 if max(int(x.max()) for x in ids) < 65536 else 4
                n = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, n), batch.column(2).slice(i, n), pa.array(queues, pa.string()),
                     pa.array([block] * n, pa.int64()), pa.array(starts, pa.int64()),
                     pa.array([len(x) for x in ids], pa.int64()), pa.array([wide] * n, pa.int32()),
                     pa.array([x.astype(f"<u{wide}").tobytes() for x in ids], pa.binary())],
                    names=["doc_id", "source", "queue", "block", "first", "tokens", "wide", "ids"])

    return rows.mapInArrow(run, "doc_id long, source string, queue string, block long, first long, tokens long, "
                                "wide int, ids binary")


def pack(df: DataFrame, vocabulary: Vocabulary, targets: dict | None = None, id_col: str = "doc_id",
         text_col: str = "text", source_col: str = "source", sequence_tokens: int = SEQUENCE_TOKENS,
         window_sequences: int = WINDOW_SEQUENCES, temper: float | None = None, queues: int = QUEUES) -> DataFrame:
    """The pieces of every document, with their sequence and offset; ``source`` and ``ids`` come along.

    ``targets`` maps a source to its weight; sources it leaves out are served last.
    """
    own = own_queues(df, targets, text_col, source_col, queues)
    docs = stored(tokenise(df, vocabulary, own, id_col, text_col, source_col), "tokens")
    sums = docs.groupBy("queue", "block").agg(F.sum("tokens").alias("n"))
    totals = {r["queue"]: r["n"] for r in sums.groupBy("queue").agg(F.sum("n").alias("n")).collect()}  # queues + 1 at most
    names = sorted(totals)
    weights = None
    if targets is not None:
        weights = [Fraction(0) if q == POOL else Fraction(targets.get(None if q == "n" else q[1:], 0)) for q in names]
    elif temper is not None:
        weights = [Fraction(round(totals[q] ** temper * 1000), 1000) for q in names]
    phases = schedule([totals[q] for q in names], weights, sequence_tokens * window_sequences)
    number = {q: i for i, q in enumerate(names)}
    placed = docs.join(offsets(sums, ["queue"], "block", "n", "before"), ["queue", "block"]).select(
        "doc_id", "source", "queue", (F.col("before") + F.col("first")).alias("at"), "tokens", "wide", "ids")
    schema = T.StructType([*PIECES.fields, T.StructField("source", T.StringType()),
                           T.StructField("ids", T.BinaryType())])

    def run(batches):
        planner = Planner(phases)
        for batch in batches:
            rows = [c.to_pylist() for c in batch.columns]
            out: list[list] = [[] for _ in schema.names]
            for doc, source, queue, at, tokens, wide, ids in zip(*rows):
                ids = np.frombuffer(ids, f"<u{wide}").astype("<u4").tobytes()
                for start, place, length in planner.runs(number[queue], at, tokens):
                    while length:
                        offset = place % sequence_tokens
                        n = min(length, sequence_tokens - offset)
                        piece = ids[4 * start:4 * (start + n)]
                        for c, v in zip(out, (doc, start, n, zlib.crc32(piece), tokens, place // sequence_tokens,
                                              offset, source, piece)):
                            c.append(v)
                        start, place, length = start + n, place + n, length - n
                if len(out[0]) >= 4096:
                    yield _pieces(out, schema)
                    out = [[] for _ in schema.names]
            if out[0]:
                yield _pieces(out, schema)

    return placed.mapInArrow(run, schema)


def _pieces(columns: list[list], schema: T.StructType) -> pa.RecordBatch:
    kinds = {T.LongType: pa.int64(), T.StringType: pa.string(), T.BinaryType: pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[type(f.dataType)])
                                       for c, f in zip(columns, schema.fields)], names=schema.names)
