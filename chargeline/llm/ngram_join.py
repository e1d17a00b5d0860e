"""N-gram Jaccard self-join with vertical partitioning, and its groups.

Two documents link when their sets of 5-word shingles have a Jaccard similarity
of 0.8 or more; a group is a connected component of links. The result is exact.

* Documents with equal sets are one *node* (a hash of set and size).
* All n-grams are counted, and the most frequent ones (``FREQUENT`` at most) are
  put last in the *global order*: by frequency class, then by hash. Any order
  gives the same result; this one keeps n-grams that many documents share out
  of the prefixes.
* The order is cut into *fragments*, contiguous pieces of about as many
  occurrences each. Every set is cut along it, and its pieces meet by fragment.
* Candidates first are each node and the *leader* of its bucket: nodes whose sets
  have the same least n-gram by a hash share a bucket, near copies nearly always.
  The one with the fewest rare n-grams leads, which of near copies is the least
  edited; other ways to hash choose others. Within a fragment the n-grams that a
  node shares with its leader are counted, for ``HUBS`` ways to hash, and the
  partial counts are summed per pair over all fragments. This joins most near
  copies at a few counts each.
* Linked sets share an n-gram of their prefixes (the first n - ceil(0.8 n) + 1
  in the order). Pairs of nodes that do, that the links so far do not connect,
  and that pass filters on sizes and places, are counted in full: their sets are
  cut along the order again, overlaps are counted per piece in separate tasks,
  and the partial counts are summed per pair.

Texts with fewer than 5 words have their whole sequence as one shingle; texts
without words (or null) are empty and linked with nothing. Repeated rows are
documents with equal sets. A row without an id takes part; where a group has no
id at all its component is null. Very long texts are handled whole, by one task.
Ties cannot occur: a group's name is its smallest id.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargeline.llm import text as tx
from chargeline.llm.frames import release, settle, stored, tidy

SHINGLE = 5
#: Most frequent n-grams that are moved to the end of the order (a broadcast of 5 bytes each).
FREQUENT = 500_000
#: N-grams of fewer documents than this are never moved.
FREQUENT_FROM = 8
#: N-grams gathered by a task before it sends its blocks.
GATHER = 600_000
#: Occurrences of n-grams in a fragment of the order.
FRAGMENT = 1_500_000
#: Ways to hash nodes into buckets, each with its leaders.
HUBS = 3
#: Bits of the bitmap of documents whose n-grams are wanted: 32 for each, 2^31 (256 MB) at most.
MARKS = 1 << 31
#: Pieces of the order in which the overlaps of the remaining pairs are counted.
PIECES = 4
#: Nodes counted together with one of theirs in one task.
HUB_GROUP = 512


@dataclass(frozen=True)
class Threshold:
    """Jaccard similarity as a ratio of whole numbers."""

    num: int = 4
    den: int = 5

    def prefix(self, n):
        return n - (-(-n * self.num // self.den)) + 1

    def links(self, shared, a, b):
        return (self.den + self.num) * shared >= self.num * (a + b)


DEFAULT_THRESHOLD = Threshold()


def sets_of(data: np.ndarray, off: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a slice, ascending within each document, and the offsets of the documents."""
    low = tx.lower(data)
    s, e, d = tx.runs(tx.SPACE_WORDS[low], off)
    words = tx.span_hashes(low, s, e)
    h, first = tx.windows(words, d, k)
    docs = d[first]
    n = len(off) - 1
    counts = np.bincount(d, minlength=n)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        start = np.cumsum(counts) - counts
        extra = np.array([counts[i] for i in short], np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for j in range(k - 1):
            has = counts[short] > j
            extra[has] = tx.mix(extra[has] + words[start[short[has]] + j])
        h, docs = np.concatenate([h, extra]), np.concatenate([docs, short])
    order = np.lexsort((h, docs))
    h, docs = h[order], docs[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (docs[1:] != docs[:-1])
    h, docs = h[new], docs[new]
    return h, np.searchsorted(docs, np.arange(n + 1))


def signatures(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Order-free 64-bit hash of each set and its size."""
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(tx.mix(h ^ np.uint64(0xA0761D6478BD642F)), out=total[1:])
    size = np.diff(at).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return tx.mix(total[at[1:]] - total[at[:-1]] + size).view(np.int64)


def _squeezed(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers, compressed by byte planes: the high bytes of small numbers take no room."""
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(a.size, a.itemsize).T).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unsqueezed(raw: bytes, *kinds) -> list[np.ndarray]:
    """The arrays of ``_squeezed``, for (type, length) of each, or as one if a type alone is given."""
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    out, at = [], 0
    for kind in kinds:
        kind, m = kind if isinstance(kind, tuple) else (kind, len(data) // np.dtype(kind).itemsize)
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(data[at:at + m * width].reshape(width, m).T).view(kind).reshape(m))
        at += m * width
    return out


def _pack(values: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as compressed differences."""
    return _squeezed(np.diff(values, prepend=np.uint64(0)))


def _frag_of(h: np.ndarray, fragments: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)


class _Fresh:
    """Marks the sets that a task has not met before, so copies within it count once."""

    def __init__(self):
        self.done: set[int] = set()

    def __call__(self, node: np.ndarray, n: np.ndarray) -> np.ndarray:
        if len(self.done) > 200_000:
            self.done.clear()
        fresh = np.zeros(len(n), bool)
        for i, key in enumerate(node.tolist()):
            if n[i] and key not in self.done:
                self.done.add(key)
                fresh[i] = True
        return fresh


# ------------------------------------------------------------------ the global order


_GATHERED = "doc_id long, text_key long, node long, n long, part int, block binary, kind int"


def _gathered(docs: DataFrame, parts: int, k: int) -> DataFrame:
    """Kind 0: doc_id, text_key, node and n (set size) of every document. Kind 1: blocks (part, block) of the upper
    32 bits of all n-grams."""
    bounds = np.array([-(-f * (1 << 32) // parts) for f in range(parts + 1)], np.uint64)
    names = [x.split()[0] for x in _GATHERED.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.int32(), pa.binary(), pa.int32()]

    def batch_of(kind, m, **columns):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(m, kind, np.int32)) if x == "kind" else columns.get(x, pa.nulls(m, t))
             for x, t in zip(names, kinds)], names=names)

    def run(batches):
        held: list[np.ndarray] = []
        fresh = _Fresh()

        def blocks():
            top = np.sort(np.concatenate(held))
            held.clear()
            cut = np.searchsorted(top, bounds)
            rows = [(f, _squeezed(np.diff(top[cut[f]:cut[f + 1]], prepend=np.uint32(0))))
                    for f in range(parts) if cut[f] < cut[f + 1]]
            return batch_of(1, len(rows), part=pa.array([f for f, _ in rows], pa.int32()),
                            block=pa.array([b for _, b in rows], pa.binary()))

        for batch in batches:
            for a, b, data, off in tx.slices(batch.column(2)):
                h, at = sets_of(data, off, k)
                node, n = signatures(h, at), np.diff(at).astype(np.int64)
                yield batch_of(0, b - a, doc_id=batch.column(0).slice(a, b - a), text_key=batch.column(1).slice(a, b - a),
                               node=pa.array(node), n=pa.array(n))
                held.append((h[np.repeat(fresh(node, n), n)] >> np.uint64(32)).astype(np.uint32))
                if sum(map(len, held)) >= 2 * GATHER:
                    yield blocks()
        if held:
            yield blocks()

    return docs.select("doc_id", "text_key", "text").mapInArrow(tidy(run), _GATHERED)


def _frequent(blocks: DataFrame, least: int) -> DataFrame:
    """(top, df) of the 32-bit n-gram prefixes of at least ``least`` documents; parts arrive one after the other."""
    def counted(held):
        top, n = np.unique(np.concatenate(held), return_counts=True)
        keep = n >= least
        return pa.RecordBatch.from_arrays([pa.array(top[keep].astype(np.int64)), pa.array(n[keep].astype(np.int64))],
                                          names=["top", "df"])

    def run(batches):
        part, held = None, []
        for batch in batches:
            for f, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if f != part and held:
                    yield counted(held)
                    held = []
                part = f
                held.append(np.cumsum(_unsqueezed(b, np.uint32)[0], dtype=np.uint32))
        if held:
            yield counted(held)

    return blocks.repartition("part").sortWithinPartitions("part").mapInArrow(tidy(run), "top long, df long")


class Order:
    """The global n-gram order: frequent n-grams last, by their frequency class; else by hash. And its fragments.

    Class c is cut into ``pieces[c]`` contiguous ranges of hashes, so fragments are
    numbered along the order.
    """

    def __init__(self, top: np.ndarray, df: np.ndarray, occurrences: int, fragment: int):
        by = np.argsort(top)
        self.top = top[by].astype(np.uint32)
        self.rank = np.floor(np.log2(np.maximum(df[by], 1))).astype(np.uint8)
        held = np.bincount(self.rank, df[by], 64)[:64].astype(np.int64)
        held[0] += max(0, occurrences - int(held.sum()))
        self.pieces = -(-held // fragment)
        self.pieces[0] = max(1, self.pieces[0])
        self.first = np.cumsum(self.pieces) - self.pieces
        self.fragments = int(self.pieces.sum())

    def classes(self, h: np.ndarray) -> np.ndarray:
        if not len(self.top):
            return np.zeros(len(h), np.uint8)
        t = (h >> np.uint64(32)).astype(np.uint32)
        at = np.searchsorted(self.top, t)
        at[at == len(self.top)] = 0
        return np.where(self.top[at] == t, self.rank[at], 0).astype(np.uint8)

    def fragment(self, classes: np.ndarray, h: np.ndarray) -> np.ndarray:
        own = np.maximum(self.pieces[classes], 1).astype(np.uint64)
        return self.first[classes] + (((h >> np.uint64(32)) * own) >> np.uint64(32)).astype(np.int64)


_SALTS = [int(x) for x in tx.mix(np.arange(11, 19, dtype=np.uint64))]


def buckets(h: np.ndarray, at: np.ndarray, hubs: int = HUBS) -> np.ndarray:
    """For each set 32 bits of the least n-gram by so many hashes (0 for an empty set)."""
    out = np.zeros((hubs, len(at) - 1), np.uint32)
    full = np.flatnonzero(np.diff(at))
    for i, salt in enumerate(_SALTS[:hubs]):
        if len(full):
            out[i, full] = tx.mix(np.minimum.reduceat(tx.mix(h ^ np.uint64(salt)), at[:-1][full])) >> np.uint64(32)
    return out


def _segments(docs: DataFrame, order, k: int, limit: Threshold) -> DataFrame:
    """Blocks (frag, occurrences, sets, block): the parts of every set in each fragment, and the places of those in
    the prefix."""
    def run(batches):
        held: list[tuple[np.ndarray, ...]] = []
        size = nodes = 0
        new = _Fresh()

        def blocks():
            h, frag, which, place = (np.concatenate([x[c] for x in held]) for c in range(4))
            node, n = (np.concatenate([x[c] for x in held]) for c in (4, 5))
            bucket = np.concatenate([x[6] for x in held], axis=1)
            rare = np.concatenate([x[7] for x in held])
            held.clear()
            by = np.lexsort((h, frag))
            h, frag, which, place = h[by], frag[by], which[by], place[by]
            names = np.unique(frag)
            cut = np.r_[np.searchsorted(frag, names), len(frag)]
            rows = []
            for f, a, b in zip(names.tolist(), cut[:-1], cut[1:]):
                own, local = np.unique(which[a:b], return_inverse=True)
                rows.append((f, b - a, len(own), _squeezed(
                    np.diff(h[a:b], prepend=np.uint64(0)), node[own], n[own].astype(np.int32),
                    np.ascontiguousarray(bucket[:, own]).ravel(), rare[own], local.astype(np.int32), place[a:b])))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.binary()))], names=["frag", "m", "own", "block"])

        for batch in batches:
            for _, _, data, off in tx.slices(batch.column(0)):
                h, at = sets_of(data, off, k)
                node, n = signatures(h, at), np.diff(at).astype(np.int64)
                fresh = new(node, n)
                bucket = buckets(h, at)
                doc = np.repeat(np.arange(len(n)), n)
                ok = fresh[doc]
                h, doc = h[ok], doc[ok]
                cls = order.value.classes(h)
                by = np.lexsort((h, cls, doc))
                h, doc, cls = h[by], doc[by], cls[by]
                first = np.searchsorted(doc, np.arange(len(n)))
                place = (np.arange(len(doc)) - first[doc]).astype(np.int32)
                place[place >= limit.prefix(n[doc])] = -1
                rare = np.bincount(doc[cls == 0], minlength=len(n)).astype(np.int32)
                held.append((h, order.value.fragment(cls, h), doc + nodes, place, node, n, bucket, rare))
                size += len(h)
                nodes += len(n)
                if size >= GATHER:
                    yield blocks()
                    size = nodes = 0
        if size:
            yield blocks()

    return docs.select("text").mapInArrow(tidy(run), "frag int, m long, own long, block binary")


def _opened(blocks: list[tuple[int, int, bytes]]):
    """Of a fragment's occurrences, by n-gram and node, each once: n-gram, node's number, place (-1: not in the prefix);
    and of the numbered nodes: node, size, rare n-grams and buckets."""
    columns: list[list[np.ndarray]] = [[], [], [], [], [], [], []]
    nodes = 0
    for m, own, raw in blocks:
        d, node, n, bucket, rare, local, place = _unsqueezed(
            raw, (np.uint64, m), (np.int64, own), (np.int32, own), (np.uint32, HUBS * own), (np.int32, own), (np.int32, m),
            (np.int32, m))
        for c, v in zip(columns, (np.cumsum(d, dtype=np.uint64), local + nodes, place, node, n, rare, bucket.reshape(HUBS, -1))):
            c.append(v)
        nodes += own
    h, which, place, node, n, rare = (np.concatenate(c) for c in columns[:6])
    bucket = np.concatenate(columns[6], axis=1)
    # a set may come from several tasks
    node, first, number = np.unique(node, return_index=True, return_inverse=True)
    which = number[which]
    by = np.argsort(h, kind="stable")
    h, which, place = h[by], which[by], place[by]
    if len(first) < nodes:
        by = np.lexsort((which, h))
        h, which, place = h[by], which[by], place[by]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (which[1:] != which[:-1])
        h, which, place = h[new], which[new], place[new]
    return h, which, place, node, n[first], rare[first], bucket[:, first]


_FOUND = "kind int, gram long, a long, a_n int, b long, b_n int, c int"


def _in_fragment(h, which, place, node, n, rare, bucket, limit: Threshold):
    """Counts (kind 0: leader, its size, node, its size, shared n-grams) and prefix n-grams that nodes share
    (kind 1: n-gram, node, its size, place) of one fragment."""
    segment = np.bincount(which, minlength=len(node))
    edge = np.r_[True, h[1:] != h[:-1]]
    many = ~(edge & np.r_[edge[1:], True])  # n-grams of two nodes at least
    h, which, place = h[many], which[many], place[many]
    if not len(h):
        return
    pairs = []
    for i, (salt, own) in enumerate(zip(_SALTS, bucket)):
        # the rows of an n-gram and a bucket together; the first of its nodes leads, in every n-gram that it has
        key = tx.mix(h ^ (own[which].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        by = np.argsort(key)
        key = key[by]
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[start, len(key)])
        edited = rare // (1, 8, 1 << 30)[min(i, 2)]  # the least edited; one of them; any
        first = np.lexsort((tx.mix(node.view(np.uint64) ^ np.uint64(salt)), edited))
        rank = np.empty(len(node), np.int64)
        rank[first] = np.arange(len(node))
        lead = np.minimum.reduceat(rank[which[by]], start)
        leader, member = first[np.repeat(lead, size)], which[by]
        low, high = np.minimum(n[leader], n[member]).astype(np.int64), np.maximum(n[leader], n[member]).astype(np.int64)
        ok = (leader != member) & (low * limit.den >= high * limit.num)
        found, c = np.unique(leader[ok] * len(node) + member[ok], return_counts=True)
        pairs.append((found, c))
    # a pair that several ways to hash give is counted by each; the largest count holds all that the others have
    key, c = (np.concatenate(x) for x in zip(*pairs))
    by = np.lexsort((-c, key))
    key, c = key[by], c[by]
    new = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
    a, b, c = key[new] // len(node), key[new] % len(node), c[new]
    # a pair that shares little of its pieces here hardly links
    keep = 2 * c >= np.minimum(segment[a], segment[b])
    a, b, c = a[keep], b[keep], c[keep]
    if len(c):
        yield _found_batch(0, np.zeros(len(c), np.int64), node[a], n[a], node[b], n[b], c)
    front = np.flatnonzero(place >= 0)
    h, which, place = h[front], which[front], place[front]
    if len(h):
        edge = np.r_[True, h[1:] != h[:-1]]
        shared = np.flatnonzero(~(edge & np.r_[edge[1:], True]))
        zero = np.zeros(len(shared), np.int32)
        if len(shared):
            own = which[shared]
            yield _found_batch(1, h[shared].view(np.int64), zero.astype(np.int64), zero, node[own], n[own], place[shared])


def _found_batch(kind, gram, a, a_n, b, b_n, c):
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(c), kind, np.int32)), pa.array(gram), pa.array(a), pa.array(a_n.astype(np.int32)), pa.array(b),
         pa.array(b_n.astype(np.int32)), pa.array(c.astype(np.int32))], names=[x.split()[0] for x in _FOUND.split(", ")])


def _by_fragment(segments: DataFrame, limit: Threshold) -> DataFrame:
    """What ``_in_fragment`` finds; a task finishes one fragment before it takes the next."""
    def run(batches):
        frag, held = None, []
        for batch in batches:
            for f, *block in zip(*(c.to_pylist() for c in batch.columns)):
                if f != frag and held:
                    yield from _in_fragment(*_opened(held), limit)
                    held = []
                frag = f
                held.append(block)
        if held:
            yield from _in_fragment(*_opened(held), limit)

    return segments.repartition("frag").sortWithinPartitions("frag").mapInArrow(tidy(run), _FOUND)


# ------------------------------------------------------------------ counting given pairs in full


def _sets(docs: DataFrame, rows: DataFrame, wanted: DataFrame, order, k: int, pieces: int) -> DataFrame:
    """The n-grams, packed and cut along the order into so many pieces, of the wanted nodes (and of a few more).

    One document of each node is marked in a bitmap, which is all that is
    broadcast; documents that are not marked are passed over.
    """
    reps = (rows.join(wanted, "node").groupBy("node").agg(F.min("doc_id").alias("rep")))
    marked = 1 << int(np.clip(32 * max(1, wanted.count()), 1 << 16, MARKS)).bit_length() - 1
    words = (reps.select(F.pmod(F.xxhash64("rep"), F.lit(marked)).alias("bit"))
             .groupBy((F.col("bit") / 64).cast("long").alias("at"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits")).toArrow())
    marks = np.zeros(marked // 64, np.uint64)
    marks[words["at"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(marks)

    def run(batches):
        fresh = _Fresh()
        for batch in batches:
            bit = batch.column(0).to_numpy().astype(np.uint64)
            hit = (shared.value[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1)
            texts = batch.column(1).filter(pa.array(hit.astype(bool)))
            for _, _, data, off in tx.slices(texts):
                h, at = sets_of(data, off, k)
                node, n = signatures(h, at), np.diff(at).astype(np.int64)
                piece = order.value.fragment(order.value.classes(h), h) * pieces // order.value.fragments
                own = np.flatnonzero(fresh(node, n))
                for f in range(pieces):
                    packed = []
                    for i in own:
                        one = slice(at[i], at[i + 1])
                        packed.append(_pack(h[one][piece[one] == f]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(node[own]), pa.array([f] * len(own), pa.int32()), pa.array(packed, pa.binary())],
                        names=["node", "piece", "grams"])

    return (docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(marked)).alias("bit"), "text")
            .mapInArrow(tidy(run), "node long, piece int, grams binary"))


def _unpack(b: bytes) -> np.ndarray:
    return np.cumsum(_unsqueezed(b, np.uint64)[0], dtype=np.uint64)


def _overlaps(one: np.ndarray, others: np.ndarray, owner: np.ndarray, n_others: int) -> np.ndarray:
    """Shared n-grams of a set with each of several, whose n-grams lie one after the other."""
    if not len(one):
        return np.zeros(n_others, np.int64)
    at = np.searchsorted(one, others)
    at[at == len(one)] = 0
    return np.bincount(owner[one[at] == others], minlength=n_others)


def _partial_overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Shared n-grams of each pair (a, b), counted within a piece of the order; a's many partners are dealt over tasks."""
    size = pairs.groupBy("a").agg((F.floor(F.count(F.lit(1)) / HUB_GROUP) + 1).cast("int").alias("salts"))
    members = (pairs.join(size, "a").join(sets.withColumnRenamed("node", "b"), "b")
               .select("a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), F.lit(False).alias("lead"),
                       "piece", F.col("b").alias("node"), "grams"))
    leads = (size.join(sets, size.a == sets.node)
             .select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(True).alias("lead"),
                     "piece", "node", "grams"))
    group = HUB_GROUP

    def run(batches):
        lead, members, current, out = None, [], None, []

        def solve():
            sets = [_unpack(m[1]) for m in members]
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            shared = _overlaps(lead, np.concatenate(sets), owner, len(sets))
            out.extend((current[0], members[i][0], current[2], int(shared[i])) for i in np.flatnonzero(shared))

        for batch in batches:
            for a, salt, piece, first, node, grams in zip(*(c.to_pylist() for c in batch.columns)):
                if (a, salt, piece) != current:
                    if members:
                        solve()
                    current, lead, members = (a, salt, piece), None, []
                if first:
                    lead = _unpack(grams)
                else:
                    members.append((node, grams))
                if len(members) >= group:
                    solve()
                    members = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b", "piece", "shared"])
                out = []
        if members:
            solve()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["a", "b", "piece", "shared"])

    return (members.unionByName(leads).select("a", "salt", "piece", "lead", "node", "grams")
            .repartition("a", "salt", "piece").sortWithinPartitions("a", "salt", "piece", F.desc("lead"), "node")
            .mapInArrow(tidy(run), "a long, b long, piece long, shared long"))


def _cross_pairs(members: DataFrame, limit: Threshold) -> DataFrame:
    """Pairs of nodes of different labels that share a prefix n-gram and could link from there on."""
    names = ["a", "a_n", "b", "b_n"]

    def batch_of(a, b, node, n):
        a, b = np.where(node[a] < node[b], a, b), np.where(node[a] < node[b], b, a)
        by = np.lexsort((node[b], node[a]))
        a, b = a[by], b[by]
        new = np.r_[True, (node[a[1:]] != node[a[:-1]]) | (node[b[1:]] != node[b[:-1]])]
        a, b = a[new], b[new]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (node[a], n[a], node[b], n[b])], names=names)

    def pairs(gram, node, n, place, label):
        """Every row outside its n-gram's largest label against all rows of the n-gram."""
        by = np.lexsort((label, gram))
        gram, node, n, place, label = gram[by], node[by], n[by], place[by], label[by]
        edge = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
        end = np.r_[edge[1:], len(gram)]
        mixed = label[edge] != label[end - 1]
        got, size = [], 0
        for s, e in zip(edge[mixed], end[mixed]):
            run = np.flatnonzero(np.r_[True, label[s + 1:e] != label[s:e - 1]]) + s
            length = np.diff(np.r_[run, e])
            big = int(length.argmax())
            for i in np.r_[s:run[big], run[big] + length[big]:e]:
                # against the largest label and, of the others, the rows after this one
                them = np.r_[run[big]:run[big] + length[big], max(i + 1, s):run[big], max(i + 1, run[big] + length[big]):e]
                low, high = np.minimum(n[i], n[them]), np.maximum(n[i], n[them])
                rest = np.minimum(n[i] - place[i], n[them] - place[them])
                # as the first n-gram that a pair shares: could what comes after it suffice in both sets?
                ok = (label[them] != label[i]) & (low * limit.den >= high * limit.num) & limit.links(rest, n[i], n[them])
                if ok.any():
                    got.append(np.stack([np.full(int(ok.sum()), i), them[ok]]))
                    size += got[-1].shape[1]
                    if size > 500_000:
                        yield batch_of(*np.concatenate(got, 1), node, n)
                        got, size = [], 0
        if got:
            yield batch_of(*np.concatenate(got, 1), node, n)

    def run(batches):
        tail = None
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if tail is not None:
                cols = [np.concatenate([t, c]) for t, c in zip(tail, cols)]
            if not len(cols[0]):
                continue
            cut = int(np.searchsorted(cols[0], cols[0][-1]))  # the last n-gram may go on in the next batch
            tail = [c[cut:] for c in cols]
            if cut:
                yield from pairs(*[c[:cut] for c in cols])
        if tail is not None and len(tail[0]):
            yield from pairs(*tail)

    return (members.select("gram", "node", "n", "place", "label").repartition("gram").sortWithinPartitions("gram")
            .mapInArrow(tidy(run), "a long, a_n long, b long, b_n long").distinct())


# ------------------------------------------------------------------ groups


def _components(edges: DataFrame) -> DataFrame:
    """(node, group) of the nodes that occur in edges (u, v): the smallest node reachable.

    Alternates large-star and small-star steps, each a grouped minimum, until no
    edge changes; the number of rounds grows with the logarithm of the size.
    """
    e, before = settle(edges.select("u", "v").where("u <> v").distinct()), None
    while True:
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        after = settle(small)
        now = after.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        e, before = after, now
    return e.select(F.col("u").alias("node"), F.col("v").alias("group")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("group")).distinct())


def _labels(links: DataFrame, rounds: int = 2) -> DataFrame:
    """(node, label) of linked nodes: the smallest node within a few links. Equal labels mean one group."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
    label = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label"))
    for _ in range(rounds):
        seen = both.join(label.withColumnRenamed("u", "v"), "v").groupBy("u").agg(F.min("label").alias("near"))
        label = label.join(seen, "u").select("u", F.least("label", "near").alias("label"))
    return label.withColumnRenamed("u", "node")


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
           limit: Threshold = DEFAULT_THRESHOLD) -> DataFrame:
    """doc_id, text_key, n_shingles and component_id (the group's smallest doc_id) of every row."""
    spark = df.sparkSession
    parts = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                     F.xxhash64(text_col).alias("text_key"))
    gathered = stored(_gathered(docs, parts, k), "gathered", by="kind")
    rows = gathered.where("kind = 0").select("doc_id", "text_key", "node", "n")
    top = (_frequent(gathered.where("kind = 1").select("part", "block"), FREQUENT_FROM)
           .orderBy(F.desc("df"), "top").limit(FREQUENT).toArrow())
    release(gathered.where("kind = 1"))
    occurrences = rows.agg(F.sum("n")).first()[0] or 0
    order = spark.sparkContext.broadcast(Order(
        top["top"].to_numpy(), top["df"].to_numpy(), occurrences, min(FRAGMENT, max(1, 2 * occurrences // parts))))

    # overlaps with leaders, and the prefix n-grams that nodes share
    found = stored(_by_fragment(_segments(docs, order, k, limit), limit), "fragments")
    links = settle(found.where("kind = 0").groupBy("a", "a_n", "b", "b_n").agg(F.sum("c").alias("shared"))
                   .where(limit.links(F.col("shared"), F.col("a_n"), F.col("b_n"))).select("a", "b"))
    near = settle(_labels(links))

    # what shares a prefix n-gram and has another label
    members = (found.where("kind = 1").select("gram", F.col("b").alias("node"), F.col("b_n").cast("long").alias("n"),
                                              F.col("c").cast("long").alias("place"))
               .join(near, "node", "left").withColumn("label", F.coalesce("label", "node")))
    pairs = settle(_cross_pairs(members, limit))
    wanted = settle(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
    sets = stored(_sets(docs, rows, wanted, order, k, PIECES), "sets")
    # two tasks may have packed the same set, so a piece's count can come twice
    late = (_partial_overlaps(pairs.select("a", "b"), sets)
            .groupBy("a", "b", "piece").agg(F.max("shared").alias("shared"))
            .groupBy("a", "b").agg(F.sum("shared").alias("shared"))
            .join(pairs, ["a", "b"]).where(limit.links(F.col("shared"), F.col("a_n"), F.col("b_n"))).select("a", "b"))

    # components of what is linked but has two labels
    a, b = near.toDF("a", "la"), near.toDF("b", "lb")
    apart = (links.unionByName(late).join(a, "a", "left").join(b, "b", "left")
             .select(F.coalesce("la", "a").alias("u"), F.coalesce("lb", "b").alias("v")).where("u <> v"))
    joined = _components(apart).withColumnsRenamed({"node": "label", "group": "whole"})
    nodes = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("low")).join(near, "node", "left")
    named = (nodes.withColumn("label", F.coalesce("label", "node")).join(joined, "label", "left")
             .select("node", "low", F.coalesce("whole", "label").alias("group")))
    firsts = named.groupBy("group").agg(F.min("low").alias("first"))
    tags = stored(named.join(firsts, "group").select("node", "first"), "tags")
    release(found, sets)
    return rows.join(tags, "node", "left").select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.coalesce("first", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                limit: Threshold = DEFAULT_THRESHOLD) -> DataFrame:
    """The rows without those in a group whose smallest id is another's; all columns stay.

    Rows with one id and one text count as one document; rows without words, or
    without an id, stay.
    """
    found = groups(df, id_col, text_col, k, limit)
    gone = (found.where("n_shingles > 0 and component_id <> doc_id")
            .select(F.col("doc_id").alias("_gone"), F.col("text_key").alias("_gone_key")).distinct())
    return df.join(gone, (F.col(id_col) == F.col("_gone")) & (F.xxhash64(text_col) == F.col("_gone_key")), "left_anti")
