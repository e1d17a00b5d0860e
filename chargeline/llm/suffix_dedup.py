"""Exact substring dedup by sorting suffixes, deep and shallow.

Removed is each byte covered by a string of ``MIN_BYTES`` bytes that starts
anywhere else as well. Not every suffix is sorted: each window of that length
has an *anchor*, the place in it whose ``GRAM``-byte hash is smallest, and equal
windows have equal anchors at equal distances. So

1. every text lists its anchors with the window starts each stands for (equal
   surroundings within a text once);
2. anchors whose gram occurs at one place only are dropped;
3. the bytes around the remaining anchors meet by gram hash, and within a gram
   the suffixes that begin at the anchors, and the reversed prefixes that end
   there, are sorted: multikey quicksort over 8-byte words down to
   ``SHALLOW`` bytes, blind tries for groups that are equal that far;
4. longest common prefixes between neighbours split the anchors into classes
   of equal right and equal left contexts of every length, and a window occurs
   twice where two anchors share both classes;
5. the windows found are joined to their texts, and covered bytes removed.

Passages shorter than that are told, not removed: ``n_shared`` counts the places
that a text shares with another one by a rule of the same kind. Of every
``PASSAGE_WORDS`` words in a row the ``PASSAGE_GRAM`` words with the smallest hash
are an anchor, so texts that share so many words share an anchor; an anchor
counts if another text (or a copy of this one) has its words too.

Texts are keyed by two 64-bit hashes. Copies of a text are handled as one text
with a count: each is removed whole if it has at least ``MIN_BYTES`` bytes.
Grams at more than ``GROUP`` places do not meet in one task: their windows are
counted by digest in map-side aggregates instead, so no group is unbounded.

Null text is empty; texts shorter than ``MIN_BYTES`` keep everything; repeated
rows are copies; an empty table gives an empty result. Very long texts are
handled whole, by one task, in overlapping blocks; ties of hashes go to the first
place, alike in equal surroundings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargeline.llm import text as tx
from chargeline.llm.frames import settle, stored, text_bytes

MIN_BYTES = 400
GRAM = 64
SHALLOW = 96
GROUP = 1 << 15
#: Words in a row of which any other text with the same is told, and of an anchor among them.
PASSAGE_WORDS, PASSAGE_GRAM = 51, 10
#: Bytes of contexts sorted at a time.
BATCH_BYTES = 24 << 20
_BLOCK = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes (a power of two) from each place on."""
    h = tx.GEAR[data]
    step, power = 1, 0x9E3779B97F4A7C15
    while step < gram:
        h = h[:-step] * np.uint64(power) + h[step:]
        power = power * power & ((1 << 64) - 1)
        step *= 2
    return tx.mix(h)


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while step * 2 <= width:
        v = np.minimum(v[:-step], v[step:])
        step *= 2
    rest = width - step
    return np.minimum(v[:len(v) - rest], v[rest:]) if rest else v


def anchors(data: np.ndarray, off: np.ndarray, least: int = MIN_BYTES, gram: int = GRAM):
    """Per anchor: gram hash, document, place, first and last window start (places within the document)."""
    out: list[list[np.ndarray]] = [[] for _ in range(5)]
    docs = np.flatnonzero(np.diff(off) >= least)
    i = 0
    while i < len(docs):
        # neighbouring long documents together, a very long one in overlapping blocks
        base = int(off[docs[i]])
        j = max(i + 1, int(np.searchsorted(off[docs + 1], base + _BLOCK, "right")))
        last = int(off[docs[j - 1] + 1])
        valid = np.zeros(last - base, bool)
        for d in docs[i:j]:
            valid[off[d] - base:off[d + 1] - base - least + 1] = True
        for a in range(0, last - base - least + 1, 4 * _BLOCK):
            b = min(a + 4 * _BLOCK, last - base - least + 1)
            h = gram_hashes(data[base + a:base + b + least - 1], gram)
            place = np.arange(len(h), dtype=np.uint64)
            low = _sliding_min((h & ~_PLACE) | place, least - gram + 1)
            start = np.flatnonzero(valid[a:b])
            at = (low[start] & _PLACE).astype(np.int64)
            doc = np.searchsorted(off, start + base + a, "right") - 1
            if not len(at):
                continue
            new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])])
            end = np.r_[new[1:], len(at)] - 1
            d = doc[new]
            shift = base + a - off[d]
            for column, v in zip(out, (h[at[new]].view(np.int64), d, at[new] + shift, start[new] + shift,
                                       start[end] + shift)):
                column.append(v)
        i = j
    return [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]


def word_anchors(data: np.ndarray, off: np.ndarray, words: int = PASSAGE_WORDS, gram: int = PASSAGE_GRAM):
    """Hash and document of the anchors among every ``words`` words in a row, each once a document."""
    s, e, doc = tx.runs(tx.SPACE_WORDS[data], off)
    h = tx.span_hashes(data, s, e)
    keys, docs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    width = words - gram + 1
    for a in range(0, max(len(h) - words + 1, 0), _BLOCK):  # overlapping blocks
        b = min(a + _BLOCK + words - 1, len(h))
        one, own = h[a:b].copy(), doc[a:b]
        value = one[:len(one) - gram + 1].copy()
        for i in range(1, gram):
            value = tx.mix(value + one[i:i + len(value)])
        low = _sliding_min((value & ~_PLACE) | np.arange(len(value), dtype=np.uint64), width)
        whole = np.flatnonzero(own[:len(low)] == own[words - 1:words - 1 + len(low)])  # windows inside a document
        at = (low[whole] & _PLACE).astype(np.int64)
        new = np.r_[True, at[1:] != at[:-1]] if len(at) else np.zeros(0, bool)
        keys.append(value[at[new]].view(np.int64))
        docs.append(own[at[new]])
    both = np.unique(np.stack([np.concatenate(docs), np.concatenate(keys)]), axis=1)
    return both[1], both[0]


# ------------------------------------------------------------------ sorting


def _common(a: bytes, b: bytes, low: int) -> int:
    """Length of the common prefix of two byte strings known to agree on ``low`` bytes."""
    high = min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class BlindTrie:
    """Order of strings with long common prefixes.

    An inner node is [depth, children by byte]; a leaf is a position in
    ``strings``. A string is first followed down by the bytes at the nodes'
    depths alone, then compared once with the leaf found.
    """

    def __init__(self, strings: list[bytes], depth: int):
        self.strings = strings
        self.depth = depth
        self.root: list | int = 0
        for i in range(1, len(strings)):
            self._insert(i)

    def _insert(self, i: int) -> None:
        s = self.strings[i]
        node = self.root
        while not isinstance(node, int):
            d, children = node
            node = children.get(s[d] if d < len(s) else -1) if d <= len(s) else None
            if node is None:
                node = next(iter(children.values()))
        near = self.strings[node]
        common = _common(s, near, self.depth)
        parent, edge, node = None, None, self.root
        while not isinstance(node, int) and node[0] < common:
            parent, edge = node, s[node[0]]
            node = node[1][edge]
        mine = s[common] if common < len(s) else -1
        if not isinstance(node, int) and node[0] == common:
            node[1][mine] = i
            return
        other = near[common] if common < len(near) else -1
        inner = [common, {other: node, mine: i}]
        if parent is None:
            self.root = inner
        else:
            parent[1][edge] = inner

    def ordered(self) -> Iterator[tuple[int, int]]:
        """(string, common prefix with the string before) in order."""
        stack, common = [(self.root, self.depth)], self.depth
        while stack:
            node, common = stack.pop()
            if isinstance(node, int):
                yield node, common
                continue
            d, children = node
            keys = sorted(children)
            for k in reversed(keys[1:]):
                stack.append((children[k], d))
            stack.append((children[keys[0]], common))


def _words(data: np.ndarray, at: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The next 8 bytes of each string as a number (zeros beyond its end) and how many are its own."""
    own = np.clip(left, 0, 8)
    w = np.zeros(len(at), np.uint64)
    for i in range(8):
        byte = data[np.minimum(at + i, len(data) - 1)].astype(np.uint64)
        w = (w << np.uint64(8)) | np.where(own > i, byte, np.uint64(0))
    return w, own


def sort_strings(data: np.ndarray, start: np.ndarray, size: np.ndarray, group: np.ndarray,
                 shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings within each group, and each one's common prefix with the one before (-1 at a group's first).

    ``group`` is ascending. Multikey quicksort on 8-byte words splits all groups
    at once; those still together at the shallow depth go to blind tries.
    """
    n = len(start)
    order, common = np.arange(n), np.full(n, -1, np.int64)
    if not n:
        return order, common
    part = np.cumsum(np.r_[0, group[1:] != group[:-1]])
    open_ = np.arange(n)  # places in the order that are not settled
    count = np.bincount(part)
    open_ = open_[count[part] > 1]
    depth = 0
    while len(open_) and depth < shallow:
        item = order[open_]
        w, own = _words(data, start[item] + depth, size[item] - depth)
        by = np.lexsort((own, w, part[open_]))
        order[open_] = item[by]
        w, own, p = w[by], own[by], part[open_]
        same = p[1:] == p[:-1]
        differ = (w[1:] ^ w[:-1])
        bytes_same = np.full(len(differ), 8, np.int64)
        for i in range(8):
            bytes_same = np.where((bytes_same == 8) & ((differ >> np.uint64(56 - 8 * i)) & np.uint64(255) != 0),
                                  i, bytes_same)
        reach = np.minimum(bytes_same, np.minimum(own[1:], own[:-1]))
        split = same & ((differ != 0) | (own[1:] != own[:-1]))
        ended = same & ~split & (own[1:] < 8)
        common[open_[1:][split]] = depth + reach[split]
        common[open_[1:][ended]] = depth + own[1:][ended]
        # those that stay together and have not ended form the next parts
        fresh = np.r_[True, ~same | split]
        new_part = np.cumsum(fresh) - 1
        alive = (np.bincount(new_part)[new_part] > 1) & (own == 8)
        part[open_] = new_part
        open_ = open_[alive]
        depth += 8
    if len(open_):
        p = part[open_]
        edges = np.flatnonzero(np.r_[True, p[1:] != p[:-1], True])
        raw = data.tobytes()
        for a, b in zip(edges[:-1], edges[1:]):
            places = open_[a:b]
            items: dict[bytes, list[int]] = {}
            for i in order[places].tolist():
                items.setdefault(raw[start[i]:start[i] + size[i]], []).append(i)
            strings = list(items)
            out, with_before = [], []
            for k, c in BlindTrie(strings, depth).ordered():
                for i in items[strings[k]]:
                    out.append(i)
                    with_before.append(c)
                    c = len(strings[k])
            order[places] = out
            common[places[1:]] = with_before[1:]
    return order, common


# ------------------------------------------------------------------ windows


def repeated_windows(key: np.ndarray, blocks: list[bytes], left: np.ndarray, wins: np.ndarray,
                     least: int = MIN_BYTES, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that occur twice: (anchor, first window, last window), windows counted from the block's start.

    ``key`` is ascending; block i holds ``wins[i]`` windows of ``least`` bytes, and its anchor is at ``left[i]``.
    """
    m = len(blocks)
    size = np.array([len(b) for b in blocks], np.int64)
    data = np.frombuffer(b"".join(blocks), np.uint8)
    start = np.cumsum(size) - size
    back = np.frombuffer(b"".join(b[:k][::-1] for b, k in zip(blocks, left.tolist())) or b"\0", np.uint8)
    r_order, r_common = sort_strings(data, start + left, size - left, key, shallow)
    l_order, l_common = sort_strings(back, np.cumsum(left) - left, left, key, shallow)

    def longest(order, common):
        best = np.zeros(m, np.int64)
        c = np.r_[common, -1]
        best[order] = np.maximum(c[:-1], c[1:])
        return best

    right_most, left_most = longest(r_order, r_common), longest(l_order, l_common)
    # the anchor lies delta bytes into a window
    low = np.maximum(left - wins + 1, least - right_most)
    high = np.minimum(left, left_most)
    hits = np.zeros((m, int(max(high.max(), 0)) + 2), bool)
    for delta in range(int(max(low.min(), 0)), int(high.max()) + 1):
        live = np.flatnonzero((low <= delta) & (delta <= high))
        if len(live) < 2:
            continue
        cls = np.empty(m, np.int64)
        cls[r_order] = np.cumsum(r_common < least - delta)
        both = cls[live] * (m + 1)
        cls[l_order] = np.cumsum(l_common < delta)
        both += cls[live]
        by = np.argsort(both, kind="stable")
        same = both[by][1:] == both[by][:-1]
        twice = np.zeros(len(live), bool)
        twice[by[1:][same]] = True
        twice[by[:-1][same]] = True
        hits[live[twice], delta + 1] = True
    edge = np.diff(hits.astype(np.int8), axis=1, append=0)
    who, first = np.nonzero(edge == 1)      # first delta of each run
    _, end = np.nonzero(edge == -1)
    return who, left[who] - end + 1, left[who] - first


# ------------------------------------------------------------------ Spark


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    raw = text_bytes(F.col(text_col))
    return (df.select(F.col(id_col).alias("doc_id"), raw.alias("raw"))
            .select("doc_id", "raw", F.xxhash64("raw").alias("t1"), F.xxhash64(F.lit(1), "raw").alias("t2")))


def _inner_copies(data: np.ndarray, off: np.ndarray, found, least: int):
    """Anchors without those whose surroundings came before in their document, and the spans that occur twice so.

    A periodic text has an anchor in every period; all but one of each kind go here.
    """
    key, doc, at, first, last = found
    block = tx.span_hashes(data, off[doc] + first, off[doc] + last + least)
    same = tx.mix(block ^ tx.mix(key.view(np.uint64) + doc.astype(np.uint64))) + (at - first).astype(np.uint64)
    order = np.argsort(same, kind="stable")
    equal = same[order][1:] == same[order][:-1]
    later, twice = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:][equal]] = True
    twice[order[1:][equal]] = twice[order[:-1][equal]] = True
    d, s, e = doc[twice], first[twice], last[twice] + least
    if len(d):
        new = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (s[1:] > e[:-1])])
        d, s, e = d[new], s[new], e[np.r_[new[1:], len(e)] - 1]
    return [x[~later] for x in found], (d, s, e)


_LISTED = "key long, t1 long, t2 long, at long, first long, last long"


def _list_anchors(texts: DataFrame, least: int, gram: int) -> DataFrame:
    """Anchors of every text; rows without a key are spans (``first`` to ``last``) that their own text repeats."""
    def run(batches):
        done: set[tuple[int, int]] = set()
        for batch in batches:
            t1, t2 = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for a, b, data, off in tx.slices(batch.column(0)):
                found = anchors(data, off, least, gram)
                fresh = np.ones(b - a, bool)
                for i in np.unique(found[1]).tolist():  # copies within the task are listed once
                    t = (int(t1[a + i]), int(t2[a + i]))
                    fresh[i] = t not in done
                    done.add(t)
                (key, doc, at, first, last), (d, s, e) = _inner_copies(
                    data, off, [x[fresh[found[1]]] for x in found], least)
                n = len(d)
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([pa.array(key), pa.nulls(n, pa.int64())]),
                     *[pa.array(np.concatenate(x)) for x in (
                         (t1[a + doc], t1[a + d]), (t2[a + doc], t2[a + d]), (at, s), (first, s), (last, e))]],
                    names=["key", "t1", "t2", "at", "first", "last"])
            if len(done) > 200_000:
                done.clear()

    return (texts.where(F.length("raw") >= least).select("raw", "t1", "t2").mapInArrow(run, _LISTED))


_CONTEXT = "key long, places long, t1 long, t2 long, first long, lead int, wins int, block binary"


def _contexts(rows: DataFrame, least: int) -> DataFrame:
    """The bytes around each listed anchor; ``rows`` has t1, t2, raw and the anchor list."""
    def run(batches):
        names = ["key", "places", "t1", "t2", "first", "lead", "wins", "block"]
        kinds = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.binary()]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            held = 0
            for t1, t2, raw, listed in zip(*(c.to_pylist() for c in batch.columns)):
                for x in listed:
                    block = raw[x["first"]:x["last"] + least]
                    held += len(block)
                    for c, v in zip(out, (x["key"], x["places"], t1, t2, x["first"], x["at"] - x["first"],
                                          x["last"] - x["first"] + 1, block)):
                        c.append(v)
                if held > (8 << 20):
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)
                    out, held = [[] for _ in names], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    return rows.select("t1", "t2", "raw", "listed").mapInArrow(run, _CONTEXT)


_SPAN = "t1 long, t2 long, s long, e long"


def _sorted_spans(contexts: DataFrame, least: int, shallow: int) -> DataFrame:
    """Spans from grams that meet in one task; rows arrive ordered by key."""
    def solve(table: pa.Table):
        key, t1, t2, first = (table.column(c).to_numpy() for c in ("key", "t1", "t2", "first"))
        lead, wins = (table.column(c).to_numpy().astype(np.int64) for c in ("lead", "wins"))
        who, a, b = repeated_windows(key, table.column("block").to_pylist(), lead, wins, least, shallow)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (t1[who], t2[who], first[who] + a,
                                                                 first[who] + b + least)], names=["t1", "t2", "s", "e"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            batch = batch.select(["key", "t1", "t2", "first", "lead", "wins", "block"])
            held.append(batch)
            size += batch.nbytes
            if size < BATCH_BYTES:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            key = table.column("key").to_numpy()
            cut = int(np.searchsorted(key, key[-1]))  # the last gram may go on in the next batch
            if cut:
                yield solve(table.slice(0, cut))
            rest = table.slice(cut).combine_chunks()
            held, size = rest.to_batches(), rest.nbytes if cut else 0
        if held:
            table = pa.Table.from_batches(held)
            if table.num_rows:
                yield solve(table.combine_chunks())

    return contexts.repartition("key").sortWithinPartitions("key").mapInArrow(run, _SPAN)


def _counted_spans(contexts: DataFrame, least: int) -> DataFrame:
    """Spans from grams at very many places: every window's digest is counted."""
    def windows(batches):
        for batch in batches:
            t1, t2, first, wins, blocks = (batch.column(c) for c in ("t1", "t2", "first", "wins", "block"))
            for i in range(0, batch.num_rows, 256):
                part = blocks.slice(i, 256).to_pylist()
                size = np.array([len(b) for b in part], np.int64)
                n = wins.slice(i, 256).to_numpy().astype(np.int64)
                start = np.cumsum(size) - size
                who = np.repeat(np.arange(len(part)), n)
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                data = np.frombuffer(b"".join(part), np.uint8)
                s = start[who] + at
                other = data[::-1].copy()
                h1 = tx.span_hashes(data, s, s + least)
                h2 = tx.span_hashes(other, (len(data) - s - least)[::-1], (len(data) - s)[::-1])[::-1]
                rows = i + who
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1.view(np.int64)), pa.array(h2.copy().view(np.int64)), t1.take(pa.array(rows)),
                     t2.take(pa.array(rows)), pa.array(first.to_numpy()[rows] + at)],
                    names=["h1", "h2", "t1", "t2", "s"])

    rows = contexts.mapInArrow(windows, "h1 long, h2 long, t1 long, t2 long, s long")
    place = ("t1", "t2", "s")
    twice = (rows.groupBy("h1", "h2").agg(*[f(c).alias(f"{n}_{c}") for c in place
                                            for f, n in ((F.min, "lo"), (F.max, "hi"))])
             .where(" or ".join(f"lo_{c} <> hi_{c}" for c in place)).select("h1", "h2"))
    return rows.join(twice, ["h1", "h2"]).select("t1", "t2", "s", (F.col("s") + least).alias("e"))


def _shared(texts: DataFrame) -> DataFrame:
    """t1 and ``n_shared``: a text's anchors that another text has too."""
    def run(batches):
        done: set[int] = set()
        for batch in batches:
            t1 = batch.column(1).to_numpy()
            for a, b, data, off in tx.slices(batch.column(0)):
                key, doc = word_anchors(data, off)
                own = t1[a + doc]
                fresh = np.array([t not in done for t in own.tolist()], bool)
                done.update(own.tolist())
                if fresh.any():
                    yield pa.RecordBatch.from_arrays([pa.array(key[fresh]), pa.array(own[fresh])], names=["key", "t1"])
            if len(done) > 200_000:
                done.clear()

    listed = texts.select("raw", "t1").mapInArrow(run, "key long, t1 long")
    half = F.shiftright("t1", 32).cast("int")  # tells two texts apart but for one pair in 2^32
    twice = (listed.select("key", half.alias("t")).groupBy("key").agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
             .where("lo <> hi").select("key"))
    return (listed.join(twice, "key", "left_semi").groupBy("t1", "key").agg(F.lit(1).alias("one"))
            .groupBy("t1").agg(F.count(F.lit(1)).alias("n_shared")))


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_BYTES,
          gram: int = GRAM, group: int = GROUP, shallow: int = SHALLOW) -> DataFrame:
    """doc_id, raw (bytes), copies, n_shared and the byte spans ``[s, e)`` to remove, not merged, of every row."""
    texts = _texts(df, id_col, text_col)
    rows = stored(_list_anchors(texts, least, gram), "anchors")
    listed = rows.where("key is not null")
    inner = rows.where("key is null").select("t1", "t2", F.col("first").alias("s"), F.col("last").alias("e"))
    copies = texts.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("rep"))
    keys = settle(listed.withColumn("place", F.xxhash64("t1", "t2", "at")).groupBy("key")
                  .agg(F.count(F.lit(1)).alias("places"), F.min("place").alias("lo"), F.max("place").alias("hi"))
                  .where("lo <> hi").select("key", "places"))

    def contexts(of: DataFrame) -> DataFrame:
        wanted = (listed.join(of, "key").groupBy("t1", "t2")
                  .agg(F.collect_set(F.struct("key", "places", "at", "first", "last")).alias("listed"))
                  .join(copies.select("t1", "t2", "rep"), ["t1", "t2"]))
        # one copy of each text gives the bytes
        one = (texts.alias("x").join(wanted.alias("w"), [
            F.col("x.t1") == F.col("w.t1"), F.col("x.t2") == F.col("w.t2"),
            F.col("x.doc_id").eqNullSafe(F.col("w.rep"))])
            .select("x.t1", "x.t2", "x.raw", "w.listed"))
        return _contexts(one, least)

    found = inner.unionByName(_sorted_spans(contexts(keys.where(F.col("places") <= group)), least, shallow))
    crowded = keys.where(F.col("places") > group)
    if not crowded.isEmpty():
        found = found.unionByName(_counted_spans(contexts(crowded), least))
    by_text = found.groupBy("t1", "t2").agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    fate = (copies.select("t1", "t2", "copies").join(by_text, ["t1", "t2"], "left").join(_shared(texts), "t1", "left")
            .withColumn("n_shared", F.coalesce("n_shared", F.lit(0))))
    return texts.join(fate, ["t1", "t2"]).select("doc_id", "raw", "copies", "n_shared", "spans")


RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_shared long"


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_BYTES,
          gram: int = GRAM, group: int = GROUP, shallow: int = SHALLOW) -> DataFrame:
    """n_bytes, n_removed, n_spans, kept_sha256, n_shared and the merged spans (``start:end``) of every row.

    A text that has copies shares all its anchors.
    """
    rows = spans(df, id_col, text_col, least, gram, group, shallow)
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out = []
            for raw, copies, shared, found in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3, 4))):
                if copies > 1:
                    shared = len(word_anchors(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0])
                if copies > 1 and len(raw) >= least:
                    cuts = [[0, len(raw)]]
                else:
                    cuts = _merged([(x["s"], x["e"]) for x in found or ()])
                kept, at = hashlib.sha256(), 0
                for s, e in cuts:
                    kept.update(raw[at:s])
                    at = e
                kept.update(raw[at:])
                out.append((len(raw), sum(e - s for s, e in cuts), len(cuts), kept.hexdigest(), shared,
                            ",".join(f"{s}:{e}" for s, e in cuts)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_shared", "spans"])

    return rows.mapInArrow(run, f"doc_id {id_type}, {RESULT}, spans string")
