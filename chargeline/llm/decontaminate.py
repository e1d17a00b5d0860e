"""Benchmark decontamination: a BM25 index of test items, searched with block-max WAND.

Test items are the indexed side and training passages the queries. A posting's
impact is the BM25 weight of the term in the item, divided by the item's score
against itself, so a passage scores an item between 0 and 1: the weighted share
of the item's terms that it holds. Every passage retrieves all items that score
``MIN_SCORE`` or more, and each is verified: enough of the question's word
trigrams and of the answer's words must occur in the passage. Passages are
overlapping windows twice as long as the item's *span*, 32 words or the least
doubling of it that holds the item, so an item is found or not by its own
length, whatever other items there are.

Postings lie in blocks of ``BLOCK_ITEMS`` items with the block's largest impact.
A vectorised pass adds block maxima over each window, with the most frequent
terms replaced by what they can add at most; blocks that stay below the
threshold are skipped. An item's frequent terms are replaced only up to half the
threshold, the others keep their postings, so every item that reaches the
threshold has a posting hit. What is left is searched by WAND within its block: terms
ordered by their next item, a pivot where their upper bounds reach the
threshold, and full scoring only at pivots.

The index is sharded by span and item: a shard holds at most ``SHARD_ITEMS`` items
and, but for a single longer item, ``SHARD_WORDS`` words. One pass over the
documents takes shards of up to ``PASS_WORDS`` words, which are broadcast.
Document frequencies and lengths are of the whole benchmark, so the result does
not depend on the number of shards. Items of equal words are indexed once a
shard. Null and empty items match nothing; null and empty texts hold nothing; a
repeated item or document gives a row each. Very long texts are searched whole,
by one task. Of windows that score alike the first is told.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chargeline.llm import text as tx
from chargeline.llm.frames import settle

K1, B = 1.2, 0.75
BLOCK_ITEMS = 8
SHARD_ITEMS = 10_000
#: Words of a shard's items, and of all shards of a pass.
SHARD_WORDS, PASS_WORDS = 500_000, 2_000_000
#: Words of the shortest span.
SPAN = 32
COMMON_SHARE = 0.05
#: Postings expanded at a time.
EXPANDED = 4_000_000


@dataclass(frozen=True)
class Limits:
    """Least score, least share of the question's trigrams, least share of the answer's words."""

    min_score: float = 0.6
    min_question: float = 0.6
    min_answer: float = 0.6
    #: Share of an item's words, from its end, taken as the answer where no answer column is given.
    answer_share: float = 0.25


DEFAULT_LIMITS = Limits()


def words_of(text: str | None) -> list[bytes]:
    data = tx.fold_case(np.frombuffer((text or "").encode(), np.uint8))
    s, e, _ = tx.runs(tx.ALNUM_WORDS[data], np.array([0, len(data)]))
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(s, e)]


def hash_words(words: list[bytes]) -> np.ndarray:
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    data = np.frombuffer(b"".join(words), np.uint8)
    return tx.span_hashes(data, ends - np.array([len(w) for w in words], np.int64), ends)


@dataclass
class Item:
    numbers: tuple[int, ...]
    question: list[int]
    answer: list[int]
    size: int


class Index:
    """One shard: ``items`` are (numbers, question words, answer words), ``df`` the corpus frequency of a term hash.

    Searches are for scores of ``least`` or more.
    """

    def __init__(self, items: list[tuple[tuple[int, ...], np.ndarray, np.ndarray]], df: dict[int, int], n_items: int,
                 mean_size: float, span: int, least: float = 0.5):
        self.span = span
        self.most_slack = least / 2
        terms = np.unique(np.concatenate([np.concatenate([q, a]) for _, q, a in items]))
        self.terms = terms
        self.items: list[Item] = []
        postings: dict[int, list[tuple[int, float]]] = defaultdict(list)
        idf = np.array([math.log(1 + (n_items - df[int(t)] + 0.5) / (df[int(t)] + 0.5)) for t in terms])
        for i, (numbers, q, a) in enumerate(items):
            q, a = np.searchsorted(terms, q), np.searchsorted(terms, a)
            both = np.concatenate([q, a])
            ids, tf = np.unique(both, return_counts=True)
            w = idf[ids] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(both) / mean_size))
            for t, x in zip(ids.tolist(), w / w.sum()):
                postings[t].append((i, float(x)))
            self.items.append(Item(numbers, q.tolist(), a.tolist(), len(both)))
        n_terms = len(terms)
        self.n_blocks = -(-len(items) // BLOCK_ITEMS)
        self.postings = [postings[t] for t in range(n_terms)]
        common = np.array([len(p) > max(BLOCK_ITEMS, COMMON_SHARE * len(items)) for p in self.postings])
        # what an item's frequent terms can add at most, the largest per block: the most frequent terms first
        slack = np.zeros(len(items))
        block_of, best = [[] for _ in range(n_terms)], [[] for _ in range(n_terms)]
        for t in sorted(range(n_terms), key=lambda t: -len(self.postings[t])):
            top: dict[int, float] = {}
            for i, x in self.postings[t]:
                if common[t] and slack[i] + x < self.most_slack:
                    slack[i] += x
                else:
                    top[i // BLOCK_ITEMS] = max(top.get(i // BLOCK_ITEMS, 0.0), x)
            block_of[t], best[t] = list(top), list(top.values())
        pad = np.zeros(self.n_blocks * BLOCK_ITEMS)
        pad[:len(items)] = slack
        self.slack = pad.reshape(-1, BLOCK_ITEMS).max(1)
        self.count = np.array([len(x) for x in block_of])
        self.first = np.cumsum(self.count) - self.count
        self.block = np.array([b for x in block_of for b in x], np.int64)
        self.best = np.array([b for x in best for b in x])

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.terms, hashes)
        at[at == len(self.terms)] = 0
        return np.where(self.terms[at] == hashes, at, -1)

    def survivors(self, ids: np.ndarray, chunk: np.ndarray, new_doc: np.ndarray, least: float):
        """(window, block) pairs whose bound reaches the threshold; window c is chunks c and c + 1."""
        if least - 1e-9 < self.most_slack:
            raise ValueError("the index is built for higher scores")
        n_terms = len(self.terms)
        known = np.flatnonzero(ids >= 0)
        pairs = np.unique(chunk[known] * n_terms + ids[known])
        t, c = pairs % n_terms, pairs // n_terms
        total = np.r_[0, np.cumsum(self.count[t])]
        found = []
        low = 0
        while low < len(new_doc):
            # windows from low up to high, with the chunk after them
            a = int(np.searchsorted(c, low))
            b = int(np.searchsorted(total, total[a] + EXPANDED, "right")) - 1
            high = len(new_doc) if b >= len(c) else max(low + 1, int(c[b]) - 1)
            b = int(np.searchsorted(c, high, "right"))
            found.append(self._survivors(t[a:b], c[a:b], new_doc, least, low, high))
            low = high
        window, block = zip(*found) if found else ((np.zeros(0, np.int64),), (np.zeros(0, np.int64),))
        return np.concatenate(window), np.concatenate(block)

    def _survivors(self, t, c, new_doc, least, low, high):
        n = self.count[t]
        reps = np.repeat(np.arange(len(t)), n)
        within = np.arange(len(reps)) - np.repeat(np.cumsum(n) - n, n)
        at = self.first[t[reps]] + within
        key = c[reps] * self.n_blocks + self.block[at]
        keys, inverse = np.unique(key, return_inverse=True)
        total = np.bincount(inverse, self.best[at], minlength=len(keys))
        # a window starts at any chunk that has a sum, or whose next chunk of the same document has one
        starts = np.union1d(keys, keys[~new_doc[keys // self.n_blocks]] - self.n_blocks)
        starts = starts[(starts >= low * self.n_blocks) & (starts < high * self.n_blocks)]
        window, block = starts // self.n_blocks, starts % self.n_blocks

        def sums(k):
            i = np.searchsorted(keys, k)
            i[i == len(keys)] = 0
            return np.where(keys[i] == k, total[i], 0.0) if len(keys) else np.zeros(len(k))

        after = np.zeros(len(new_doc) + 1, bool)
        after[:len(new_doc)] = ~new_doc
        bound = sums(starts) + np.where(after[window + 1], sums(starts + self.n_blocks), 0.0) + self.slack[block]
        ok = bound >= least - 1e-9
        return window[ok], block[ok]

    def wand(self, terms: list[int], block: int, least: float) -> list[tuple[int, float]]:
        """All items of a block that score ``least`` or more against distinct terms."""
        low, high = block * BLOCK_ITEMS, (block + 1) * BLOCK_ITEMS
        lists = []
        for t in terms:
            p = self.postings[t]
            p = p[bisect_left(p, (low,)):bisect_left(p, (high,))]
            if p:
                lists.append([0, max(w for _, w in p), p])
        out = []
        while lists:
            lists.sort(key=lambda x: x[2][x[0]][0])
            bound, pivot = 0.0, None
            for x in lists:
                bound += x[1]
                if bound >= least - 1e-9:
                    pivot = x[2][x[0]][0]
                    break
            if pivot is None:
                break
            total, rest = 0.0, []
            for x in lists:
                while x[0] < len(x[2]) and x[2][x[0]][0] < pivot:
                    x[0] += 1
                if x[0] < len(x[2]) and x[2][x[0]][0] == pivot:
                    total += x[2][x[0]][1]
                    x[0] += 1
                if x[0] < len(x[2]):
                    rest.append(x)
            lists = rest
            if total >= least - 1e-9:
                out.append((pivot, total))
        return out


def overlap(item: Item, ids: list[int]) -> tuple[float, float]:
    """Share of the question's trigrams (words if it has fewer than 3) and of the answer's words in a passage."""
    def share(parts: set, there: set) -> float:
        return len(parts & there) / len(parts) if parts else 1.0

    k = 3 if len(item.question) >= 3 else 1
    grams = {tuple(item.question[i:i + k]) for i in range(len(item.question) - k + 1)}
    there = {tuple(ids[i:i + k]) for i in range(len(ids) - k + 1)}
    return share(grams, there), share(set(item.answer), set(ids))


def _search_slice(indexes: list[Index], data: np.ndarray, off: np.ndarray, limits: Limits):
    """(document, item numbers, score, question share, answer share, first word) of each verified pair."""
    low = tx.fold_case(data)
    s, e, d = tx.runs(tx.ALNUM_WORDS[low], off)
    if not len(s):
        return []
    hashes = tx.span_hashes(low, s, e)
    first_word = np.searchsorted(d, np.arange(len(off)))
    return [row for index in indexes for row in _search_words(index, hashes, d, first_word, limits)]


def _search_words(index: Index, hashes: np.ndarray, d: np.ndarray, first_word: np.ndarray, limits: Limits):
    ids = index.lookup(hashes)
    at = np.arange(len(ids)) - first_word[d]
    # chunks of span words, numbered through the slice
    n_chunks = -(-np.diff(first_word) // index.span)
    chunk_base = np.r_[0, np.cumsum(n_chunks)]
    chunk = chunk_base[d] + at // index.span
    new_doc = np.zeros(chunk_base[-1] + 1, bool)
    new_doc[chunk_base] = True
    found: dict[tuple[int, int], tuple] = {}
    passages: dict[int, tuple[int, int, int, list[int], list[int]]] = {}
    for w, block in zip(*index.survivors(ids, chunk, new_doc, limits.min_score)):
        w = int(w)
        if w not in passages:
            doc = int(np.searchsorted(chunk_base, w, "right")) - 1
            a = int(first_word[doc] + (w - chunk_base[doc]) * index.span)
            words = ids[a:min(a + 2 * index.span, int(first_word[doc + 1]))].tolist()
            passages[w] = doc, a - int(first_word[doc]), a, words, sorted({x for x in words if x >= 0})
        doc, at_word, _, words, terms = passages[w]
        for i, score in index.wand(terms, int(block), limits.min_score):
            q, a = overlap(index.items[i], words)
            if q >= limits.min_question and a >= limits.min_answer:
                best = found.get((doc, i))
                if best is None or score > best[2] + 1e-12:
                    found[doc, i] = (doc, index.items[i].numbers, score, q, a, at_word)
    return [found[k] for k in sorted(found)]



def read_items(items: DataFrame, id_col: str, question_col: str, answer_col: str | None,
               limits: Limits) -> DataFrame:
    """item_id and the 64-bit hashes of its question and answer words; empty items go."""
    cols = [F.col(id_col).cast("long").alias("item_id"), F.col(question_col).alias("question")]
    cols.append((F.col(answer_col) if answer_col else F.lit(None).cast("string")).alias("answer"))

    def run(batches):
        for batch in batches:
            out = []
            for number, q, a in zip(*(c.to_pylist() for c in batch.columns)):
                q, a = words_of(q), words_of(a)
                if answer_col is None and len(q) >= 4:
                    n = max(1, round(len(q) * limits.answer_share))
                    q, a = q[:-n], q[-n:]
                if q or a:
                    h = hash_words(q + a).view(np.int64)
                    out.append((number, h[:len(q)].tolist(), h[len(q):].tolist()))
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)],
                                             names=["item_id", "question", "answer"])

    return items.select(*cols).mapInArrow(run, "item_id long, question array<long>, answer array<long>")


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_id_col: str = "item_id", question_col: str = "text", answer_col: str | None = None,
           limits: Limits = DEFAULT_LIMITS, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """One row per document and test item found in it."""
    spark = docs.sparkSession
    fields = [docs.select(F.col(id_col).alias("doc_id")).schema["doc_id"]]
    schema = T.StructType([*fields, T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType()),
                           T.StructField("question_overlap", T.DoubleType()),
                           T.StructField("answer_overlap", T.DoubleType()),
                           T.StructField("first_word", T.LongType())])
    out = spark.createDataFrame([], schema)
    for run in _passes(spark, items, item_id_col, question_col, answer_col, limits, shard_items):
        def found(batches, search=run):
            for batch in batches:
                for a, b, data, off in tx.slices(batch.column(1)):
                    rows = [(d, k, *more) for d, numbers, *more in search(data, off) for k in numbers]
                    if rows:
                        d, number, score, q, ans, at = zip(*rows)
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).slice(a, b - a).take(pa.array(d)),
                             pa.array(number, pa.int64()), pa.array(score, pa.float64()),
                             pa.array(q, pa.float64()), pa.array(ans, pa.float64()), pa.array(at, pa.int64())],
                            names=schema.names)

        out = out.unionByName(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
                              .mapInArrow(found, schema))
    return out


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
          question_col: str = "text", answer_col: str | None = None, limits: Limits = DEFAULT_LIMITS,
          shard_items: int = SHARD_ITEMS) -> DataFrame:
    """The documents that hold no test item, with all their columns."""
    at = docs.columns.index(text_col)
    for run in _passes(docs.sparkSession, items, item_id_col, question_col, answer_col, limits, shard_items):
        def kept(batches, search=run):
            for batch in batches:
                for a, b, data, off in tx.slices(batch.column(at)):
                    ok = np.ones(b - a, bool)
                    ok[[r[0] for r in search(data, off)]] = False
                    yield batch.slice(a, b - a).filter(pa.array(ok))

        docs = docs.mapInArrow(kept, docs.schema)
    return docs


def _passes(spark, items: DataFrame, item_id_col, question_col, answer_col, limits, shard_items):
    """A search function per pass over the documents."""
    size = F.size("question") + F.size("answer")
    doublings = F.greatest(F.lit(0), F.ceil(F.log2(size / SPAN))).cast("int")
    words = settle(read_items(items, item_id_col, question_col, answer_col, limits)
                   .withColumn("size", size).withColumn("span", (F.lit(SPAN) * F.pow(F.lit(2), doublings)).cast("long")))
    stat = words.agg(F.count(F.lit(1)).alias("n"), F.avg("size").alias("mean")).first()
    if not stat["n"]:
        return
    df = (words.select(F.explode(F.array_distinct(F.concat("question", "answer"))).alias("term"))
          .groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    plan: list[list[tuple[int, int, int]]] = []  # shards (span, number of them, which) of each pass
    held = 0
    for r in words.groupBy("span").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")).orderBy("span").collect():
        shards = max(-(-r["n"] // shard_items), -(-r["words"] // SHARD_WORDS))
        for k in range(shards):
            if not plan or held + r["words"] // shards > PASS_WORDS:
                plan.append([])
                held = 0
            held += r["words"] // shards
            plan[-1].append((r["span"], shards, k))
    for one in plan:
        indexes = [x for span, shards, k in one if (x := _index(words, df, span, shards, k, stat, limits))]
        shared = spark.sparkContext.broadcast(indexes)

        def run(data, off, shared=shared):
            return _search_slice(shared.value, data, off, limits)

        yield run


def _index(words: DataFrame, df: DataFrame, span: int, shards: int, k: int, stat, limits: Limits) -> Index | None:
    """One shard of the items of a span."""
    mine = words.where((F.col("span") == span) & (F.pmod(F.xxhash64("item_id", "question", "answer"), F.lit(shards)) == k))
    rows = mine.select("item_id", "question", "answer").toArrow().to_pylist()
    if not rows:
        return None
    own = mine.select(F.explode(F.array_distinct(F.concat("question", "answer"))).alias("term")).distinct()
    freq = df.join(own, "term").toArrow()
    freq = dict(zip(np.array(freq["term"].to_numpy()).view(np.uint64).tolist(), freq["df"].to_pylist()))
    equal: dict[tuple, list] = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["question"], r["answer"])):
        equal[tuple(r["question"]), tuple(r["answer"])].append(r["item_id"])
    parsed = [(tuple(numbers), np.array(q, np.int64).view(np.uint64), np.array(a, np.int64).view(np.uint64))
              for (q, a), numbers in equal.items()]
    return Index(parsed, freq, stat["n"], stat["mean"], span, limits.min_score)
