"""Exact ranked lexical search with sparse ball trees.

Every item's terms are a sparse query of whole-number weights, every document a
sparse vector of whole-number term values; the score is their inner product.

* One pass over the documents finds the terms of the items' vocabulary and adds
  up, by task, how many documents hold a term, have any term, and all lengths;
  weights and values follow from these sums over the whole table.
* Documents are placed near their like: term vectors folded to a few dimensions,
  the nearest of some centres (fitted on a bounded sample), then the distance to
  it. Ranges of that order are the partitions, so a hot group of copies is cut
  like any other stretch; within one, ``BLOCK`` documents at a time form a tree.
* A node has the centroid of its documents, the radius of the ball around it
  that holds them, and its radius along each term. With q the weighted query, no
  document of a node scores above q.centroid + the smaller of |q| * radius and
  the sum of q * radius along each term of the query. Bounds are rounded up by
  more than the error of doubles, so no tie is lost.
* A query visits nodes best-first and stops at the first bound below its k-th
  score so far, which it carries from block to block of a task and which begins
  at the k-th score among the sampled documents. Leaves are scored in 64-bit
  whole numbers. Each task returns at most k documents a query; equal term sets
  are searched once.

A null or empty text, of a document or an item, has no term: such documents
count nowhere and are never returned, such items have no rows. Repeated document
rows count and are returned as rows of their own; documents without an id are
returned with a null one, after others of equal score. Items equal in id and
terms count once. Equal scores are ordered by ascending doc_id, then arbitrarily
among rows of one id, which are alike. Very long texts are handled whole, by one
task. 64-bit hashes with byte lengths stand for terms.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chargeline.llm import text as tx
from chargeline.llm.frames import stored

TOP = 50
#: Documents of a tree, and of a leaf.
BLOCK, LEAF = 4096, 48
#: A tree is closed early at so many entries (looked at after every ``STEP`` documents).
ENTRIES, STEP = 4_000_000, 256
#: Documents (those of the smallest hashes) that the centres are fitted on and the first k-th scores come from.
SAMPLE = 4096
CENTRES, FOLD = 48, 32
#: Terms of the items searched in one pass over the documents (16 bytes each are broadcast), and items searched at once.
VOCABULARY, ITEMS = 4_000_000, 20_000
#: Bounds are raised by this share; the rounding of their sums stays under 1e-11 of it.
ROUND_UP = 1e-7
_NO_ID = (1 << 63) - 1


def _terms(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, byte length and document of every term of a slice."""
    low = tx.lower(data)
    s, e, d = tx.runs(tx.ALNUM_WORDS[low], off)
    return tx.span_hashes(low, s, e), (e - s).astype(np.int64), d


def _queries(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, sig, terms, lens): the distinct terms of every item that has any, and a hash of them."""
    def run(batches):
        for batch in batches:
            for a, b, data, off in tx.slices(batch.column(1)):
                h, size, d = _terms(data, off)
                by = np.lexsort((size, h, d))
                h, size, d = h[by], size[by], d[by]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (size[1:] != size[:-1]) | (d[1:] != d[:-1])
                h, size, d = h[new], size[new], d[new]
                at = np.searchsorted(d, np.arange(b - a + 1)).astype(np.int32)
                total = np.zeros(len(h) + 1, np.uint64)
                np.cumsum(tx.mix(h), out=total[1:])
                sig = tx.mix(total[at[1:]] - total[at[:-1]] + np.diff(at).astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(sig.view(np.int64)),
                     pa.ListArray.from_arrays(at, pa.array(h.view(np.int64))), pa.ListArray.from_arrays(at, pa.array(size))],
                    names=["item_id", "sig", "terms", "lens"])

    return (items.select(F.col(id_col).cast("long"), text_col)
            .mapInArrow(run, "item_id long, sig long, terms array<long>, lens array<long>").where("size(terms) > 0")
            .dropDuplicates(["item_id", "sig"]))


class Vocabulary:
    """Distinct terms of some items; a term is its place in hash order."""

    def __init__(self, h: np.ndarray, size: np.ndarray):
        both = np.unique(np.stack([h.view(np.int64), size]), axis=1)
        by = np.argsort(both[0].view(np.uint64), kind="stable")
        self.h, self.size = both[0].view(np.uint64)[by], both[1][by]

    def __len__(self):
        return len(self.h)

    def find(self, h: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each term, and whether it is one of these."""
        at = np.searchsorted(self.h, h)
        at[at == len(self.h)] = 0
        return at, (self.h[at] == h) & (self.size[at] == size)


_POSTING = "kind int, doc_id long, n long, terms array<int>, counts array<int>"


def _postings(docs: DataFrame, shared, id_col: str, text_col: str) -> DataFrame:
    """Kind 0: a document with terms, its length, its vocabulary terms and their counts.

    Kind 1: a task's sums: documents with terms (doc_id), their lengths (n), and
    the documents that hold each term.
    """
    def batch_of(kind, ids, n, at, terms, counts):
        m = len(n)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(m, kind, np.int32)), ids, pa.array(n.astype(np.int64)),
             pa.ListArray.from_arrays(at.astype(np.int32), pa.array(terms.astype(np.int32))),
             pa.ListArray.from_arrays(at.astype(np.int32), pa.array(counts.astype(np.int32)))],
            names=["kind", "doc_id", "n", "terms", "counts"])

    def run(batches):
        words = shared.value
        v = len(words)
        held, docs_seen, length = np.zeros(v, np.int64), 0, 0
        for batch in batches:
            for a, b, data, off in tx.slices(batch.column(1)):
                h, size, d = _terms(data, off)
                n = np.bincount(d, minlength=b - a)
                place, ok = words.find(h, size)
                key, counts = np.unique(d[ok] * v + place[ok], return_counts=True)
                docs_seen += int((n > 0).sum())
                length += int(n.sum())
                held += np.bincount(key % v, minlength=v)
                own = np.flatnonzero(np.bincount(key // v, minlength=b - a))  # with a vocabulary term
                if len(own):
                    at = np.searchsorted(key, np.r_[own * v, [(b - a) * v]])
                    yield batch_of(0, batch.column(0).slice(a, b - a).take(pa.array(own)), n[own], at, key % v, counts)
        some = np.flatnonzero(held)
        yield batch_of(1, pa.array([docs_seen], pa.int64()), np.array([length]), np.array([0, len(some)]), some, held[some])

    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("doc_id"), text_col).mapInArrow(run, _POSTING)


class Ranking:
    """Weights of the vocabulary, values of a document's terms, and the fold that places documents."""

    def __init__(self, docs: int, length: int, held: np.ndarray):
        self.docs, self.length = docs, length
        self.weight = np.floor(1000 * np.log((2.0 * docs + 2) / (2.0 * held + 1))).astype(np.int64)
        self.root = np.sqrt(self.weight.astype(np.float64))
        mixed = tx.mix(np.arange(1, len(held) + 1, dtype=np.uint64))
        self.bucket = (mixed % np.uint64(FOLD)).astype(np.int64)
        self.sign = np.where((mixed >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)
        self.centres = np.zeros((1, FOLD))

    def values(self, n: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Value of a term that comes ``counts`` times in a document of n terms."""
        m = 50 + (50 * n * self.docs) // self.length
        return (1_000_000_000 * counts) // (1000 * counts + 20 * m)

    def fold(self, doc: np.ndarray, terms: np.ndarray, values: np.ndarray, docs: int) -> np.ndarray:
        x = values * self.root[terms] * self.sign[terms]
        return np.bincount(doc * FOLD + self.bucket[terms], x, docs * FOLD).reshape(docs, FOLD)

    def nearest(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d2 = (z ** 2).sum(1)[:, None] + (self.centres ** 2).sum(1)[None] - 2 * z @ self.centres.T
        cell = d2.argmin(1)
        return cell, d2[np.arange(len(z)), cell]

    def fit(self, z: np.ndarray, rounds: int = 5) -> None:
        self.centres = z[:CENTRES].copy()
        for _ in range(rounds):
            cell, _ = self.nearest(z)
            n = np.bincount(cell, minlength=len(self.centres))
            total = np.zeros_like(self.centres)
            np.add.at(total, cell, z)
            self.centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], self.centres)


class Docs:
    """Documents as flat arrays: ids, and (document, term, value) entries in the documents' order."""

    def __init__(self, ids, n, off, terms, counts, rank: Ranking):
        self.ids, self.terms = ids, terms
        self.doc = np.repeat(np.arange(len(ids)), np.diff(off))
        self.value = rank.values(n[self.doc], counts.astype(np.int64))

    @classmethod
    def of(cls, batches, rank: Ranking) -> Docs:
        ids, n, counts, terms, sizes = [], [], [], [], []
        for b in batches:
            ids.append(b.column("doc_id").to_numpy(zero_copy_only=False))
            n.append(b.column("n").to_numpy(zero_copy_only=False))
            t, c = b.column("terms"), b.column("counts")
            off = t.offsets.to_numpy()
            terms.append(t.values.to_numpy()[off[0]:off[-1]])
            sizes.append(np.diff(off))
            off = c.offsets.to_numpy()
            counts.append(c.values.to_numpy()[off[0]:off[-1]])
        return cls(np.concatenate(ids), np.concatenate(n), np.r_[0, np.cumsum(np.concatenate(sizes))],
                   np.concatenate(terms).astype(np.int64), np.concatenate(counts), rank)


def _segments(at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all ranges at[i]:end[i] one after the other, and the range of each."""
    size = end - at
    which = np.repeat(np.arange(len(size)), size)
    return np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + at[which], which


class Tree:
    """Ball tree of a block of documents. Node 0 is the root; leaves hold entries sorted by term."""

    def __init__(self, docs: Docs, rank: Ranking):
        self.ids = docs.ids
        z = rank.fold(docs.doc, docs.terms, docs.value, len(docs.ids))
        order, spans, self.child = self._split(z)
        self.spans, self.order = spans, order
        leaf_of = np.empty(len(order), np.int64)
        for i, (a, b) in enumerate(spans):
            if self.child[i] is None:
                leaf_of[order[a:b]] = i
        self._entries(docs, rank, leaf_of)

    @staticmethod
    def _split(z: np.ndarray):
        """Halves along the line between two far documents, down to ``LEAF`` documents."""
        order, spans, child, todo = np.arange(len(z)), [(0, len(z))], [None], [0]
        while todo:
            i = todo.pop()
            a, b = spans[i]
            if b - a <= LEAF:
                continue
            own = z[order[a:b]]
            one = own[((own - own.mean(0)) ** 2).sum(1).argmax()]
            other = own[((own - one) ** 2).sum(1).argmax()]
            mid = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(own @ (other - one), mid)]
            child[i] = (len(spans), len(spans) + 1)
            spans += [(a, a + mid), (a + mid, b)]
            child += [None, None]
            todo += child[i]
        return order, spans, child

    def _entries(self, docs: Docs, rank: Ranking, leaf_of: np.ndarray) -> None:
        nodes, v = len(self.spans), len(rank.weight)
        leaf = leaf_of[docs.doc]
        by = np.lexsort((docs.terms, leaf))
        key = leaf[by] * v + docs.terms[by]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        self.entry_doc, self.entry_value = docs.doc[by], docs.value[by]
        size = np.array([b - a for a, b in self.spans], np.float64)
        value = docs.value[by].astype(np.float64)
        term, node = docs.terms[by][first], leaf[by][first]
        mean = np.add.reduceat(value, first) / size[node]
        high = np.maximum.reduceat(value, first)
        # leaves: exact radii in the metric where a term counts by the root of its weight
        w = rank.weight.astype(np.float64)
        own2 = np.bincount(node, w[term] * mean ** 2, nodes)
        weight = w[docs.terms[by]]
        far2 = np.bincount(docs.doc[by], weight * value * (value - 2 * mean[group]), len(self.ids)) + own2[leaf_of]
        radius = np.zeros(nodes)
        # rounding: relative to the squared norms that cancel here
        norm2 = np.bincount(docs.doc[by], weight * value ** 2, len(self.ids)) + own2[leaf_of]
        np.maximum.at(radius, leaf_of, np.sqrt(np.maximum(far2, 0) + 1e-12 * norm2))
        self.leaf_at = {}
        cut = np.searchsorted(node, np.arange(nodes + 1))
        parts = [(term[cut[i]:cut[i + 1]], mean[cut[i]:cut[i + 1]], high[cut[i]:cut[i + 1]]) for i in range(nodes)]
        ends = np.r_[first[1:], len(key)]
        for i in range(nodes):
            if self.child[i] is None:
                self.leaf_at[i] = (parts[i][0], first[cut[i]:cut[i + 1]], ends[cut[i]:cut[i + 1]])
        for i in range(nodes - 1, -1, -1):  # children have larger numbers than their parent
            if self.child[i] is not None:
                l, r = self.child[i]
                t, at = np.unique(np.concatenate([parts[l][0], parts[r][0]]), return_inverse=True)
                nl = len(parts[l][0])
                c = np.zeros((2, len(t)))
                c[0, at[:nl]], c[1, at[nl:]] = parts[l][1], parts[r][1]
                top = np.zeros(len(t))
                top[at[:nl]] = parts[l][2]
                np.maximum.at(top, at[nl:], parts[r][2])
                both = (c[0] * size[l] + c[1] * size[r]) / size[i]
                # the ball around both children's balls
                gap = np.sqrt(np.maximum((w[t] * (c - both) ** 2).sum(1), 0)) * (1 + 1e-9)
                radius[i] = max(gap[0] + radius[l], gap[1] + radius[r])
                parts[i] = (t, both, top)
        self.radius = radius * (1 + ROUND_UP)
        term = np.concatenate([p[0] for p in parts])
        by = np.argsort(term, kind="stable")
        self.node_term = term[by]
        self.node = np.repeat(np.arange(nodes), [len(p[0]) for p in parts])[by]
        self.mean, self.high = (np.concatenate([p[c] for p in parts])[by] for c in (1, 2))

    def bounds(self, terms: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """No document of a node scores above its bound."""
        at, which = _segments(np.searchsorted(self.node_term, terms), np.searchsorted(self.node_term, terms, "right"))
        w, node, nodes = weight[which].astype(np.float64), self.node[at], len(self.radius)
        centre = np.bincount(node, w * self.mean[at], nodes)
        along = np.bincount(node, w * (self.high[at] - self.mean[at]), nodes)
        ball = np.sqrt(weight.sum(dtype=np.float64)) * self.radius
        return (centre + np.minimum(ball, along)) * (1 + ROUND_UP) + 1

    def scores(self, leaf: int, terms: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of a leaf's documents that hold a term."""
        a, b = self.spans[leaf]
        own, start, end = self.leaf_at[leaf]
        at = np.searchsorted(own, terms)
        at[at == len(own)] = 0
        hit = own[at] == terms if len(own) else np.zeros(len(terms), bool)
        pos, which = _segments(start[at[hit]], end[at[hit]])
        doc, where = np.unique(self.entry_doc[pos], return_inverse=True)
        total = np.zeros(len(doc), np.int64)
        np.add.at(total, where, weight[hit][which] * self.entry_value[pos])
        return self.ids[doc], total


class Best:
    """The k best (score, id) of every query so far, and the score that a document must reach."""

    def __init__(self, queries: int, k: int, reach: np.ndarray):
        self.k, self.reach = k, np.maximum(reach, 1)
        self.score = [np.zeros(0, np.int64)] * queries
        self.ids = [np.zeros(0, np.int64)] * queries

    def add(self, q: int, ids: np.ndarray, score: np.ndarray) -> None:
        ok = score >= self.reach[q]
        if not ok.any():
            return
        s, i = np.concatenate([self.score[q], score[ok]]), np.concatenate([self.ids[q], ids[ok]])
        by = np.lexsort((i, -s))[:self.k]
        self.score[q], self.ids[q] = s[by], i[by]
        if len(by) == self.k:
            self.reach[q] = max(self.reach[q], s[by[-1]])


def search_tree(tree: Tree, queries: list[tuple[np.ndarray, np.ndarray]], best: Best) -> int:
    """Adds a tree's documents to the best of all queries; gives the leaves scored."""
    seen = 0
    for q, (terms, weight) in enumerate(queries):
        bound = tree.bounds(terms, weight)
        heap = [(-bound[0], 0)]
        while heap and -heap[0][0] >= best.reach[q]:
            _, i = heapq.heappop(heap)
            if tree.child[i] is None:
                best.add(q, *tree.scores(i, terms, weight))
                seen += 1
            else:
                for c in tree.child[i]:
                    if bound[c] >= best.reach[q]:
                        heapq.heappush(heap, (-bound[c], c))
    return seen


def _sums(postings: DataFrame, terms: int) -> Ranking | None:
    """Weights from the sums of all tasks; None where no document has a term."""
    tasks = postings.where("kind = 1")
    n = tasks.agg(F.sum("doc_id"), F.sum("n")).first()
    if not n[0]:
        return None
    held = np.zeros(terms, np.int64)
    rows = (tasks.select(F.explode(F.arrays_zip("terms", "counts")).alias("x"))
            .groupBy(F.col("x.terms").alias("t")).agg(F.sum("x.counts").alias("c")).toArrow())  # a row a vocabulary term
    held[rows["t"].to_numpy()] = rows["c"].to_numpy()
    return Ranking(int(n[0]), int(n[1]), held)


def _found(postings: DataFrame, rank: Ranking, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> DataFrame:
    """(q, doc_id, score) of the documents that some task has among the k best of a query."""
    spark = postings.sparkSession
    docs = postings.where("kind = 0").select("doc_id", "n", "terms", "counts")
    sample = docs.orderBy(F.xxhash64("doc_id"), "doc_id", "n").limit(SAMPLE).toArrow().combine_chunks()
    reach = np.zeros(len(queries), np.int64)
    if sample.num_rows:
        some = Docs.of(sample.to_batches(), rank)
        rank.fit(rank.fold(some.doc, some.terms, some.value, len(some.ids)))
        start = Best(len(queries), k, reach)
        search_tree(Tree(some, rank), queries, start)
        reach = np.where(np.array([len(s) == k for s in start.score]), start.reach, 0)
    told = spark.sparkContext.broadcast((rank, queries, reach))

    def place(batches):
        rank = told.value[0]
        for batch in batches:
            if batch.num_rows:
                d = Docs.of([batch], rank)
                cell, far = rank.nearest(rank.fold(d.doc, d.terms, d.value, len(d.ids)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(far)],
                                                 names=[*batch.schema.names, "cell", "far"])

    def run(batches):
        rank, queries, reach = told.value
        best = Best(len(queries), k, reach.copy())
        held, size, entries = [], 0, 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, min(STEP, BLOCK - size))
                held.append(part)
                at += part.num_rows
                size += part.num_rows
                entries += len(part.column("terms").flatten())
                if size >= BLOCK or entries >= ENTRIES:
                    search_tree(Tree(Docs.of(held, rank), rank), queries, best)
                    held, size, entries = [], 0, 0
        if held:
            search_tree(Tree(Docs.of(held, rank), rank), queries, best)
        for q in range(len(queries)):
            if len(best.ids[q]):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(best.ids[q]), q, np.int32)), pa.array(best.ids[q]),
                                                  pa.array(best.score[q])], names=["q", "doc_id", "score"])

    schema = "doc_id long, n long, terms array<int>, counts array<int>"
    placed = docs.mapInArrow(place, schema + ", cell int, far double").withColumn("row", F.monotonically_increasing_id())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the row number only cuts stretches of equal rows
    ranges = (placed.repartitionByRange(parts, "cell", "far", "doc_id", "row")
              .sortWithinPartitions("cell", "far", "doc_id").select("doc_id", "n", "terms", "counts"))
    return ranges.mapInArrow(run, "q int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id",
           item_text: str = "text", k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score: the k best documents of every item."""
    spark = docs.sparkSession
    asked = stored(_queries(items, item_id, item_text), "items")
    size = asked.agg(F.sum(F.size("terms")).alias("terms"), F.count_distinct("sig").alias("sets")).first()
    out = None
    groups = -(-(size.terms or 0) // VOCABULARY)
    for g in range(groups):  # one, unless the items hold more terms than one vocabulary
        mine = asked.where(F.pmod(F.xxhash64("sig"), F.lit(groups)) == g)
        v = mine.select(F.explode(F.arrays_zip("terms", "lens")).alias("x")).select("x.terms", "x.lens").distinct().toArrow()
        words = Vocabulary(v["terms"].to_numpy().view(np.uint64), v["lens"].to_numpy())
        shared = spark.sparkContext.broadcast(words)
        postings = stored(_postings(docs, shared, doc_id, doc_text), "postings")
        rank = _sums(postings, len(words)) if len(words) else None
        if rank is None:
            continue
        turns = -(-size.sets // (ITEMS * groups))
        for t in range(turns):
            sets = (mine.where(F.pmod(F.xxhash64("sig", F.lit(1)), F.lit(turns)) == t).groupBy("sig")
                    .agg(F.first("terms").alias("terms"), F.first("lens").alias("lens")).orderBy("sig").collect())
            queries = []
            for r in sets:
                at, _ = words.find(np.array(r.terms, np.int64).view(np.uint64), np.array(r.lens, np.int64))
                at = np.sort(at)
                queries.append((at, rank.weight[at]))
            order = Window.partitionBy("q").orderBy(F.desc("score"), "doc_id")
            top = (_found(postings, rank, queries, k).withColumn("rank", F.row_number().over(order))
                   .where(F.col("rank") <= k))
            names = spark.createDataFrame([(q, r.sig) for q, r in enumerate(sets)], "q int, sig long")
            got = (top.join(F.broadcast(names), "q").join(mine.select("sig", "item_id"), "sig")  # at most ITEMS rows
                   .select("item_id", F.col("rank").cast("int"),
                           F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")).alias("doc_id"), "score"))
            out = got if out is None else out.unionByName(got)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
