"""Exact top-k by integer inner product: a Voronoi kNN join.

Components become floor(256 * x). With M the largest norm, a vector v is lifted
to (v, sqrt(M^2 - |v|^2)) and a query q to (q, 0); then |q - v|^2 = |q|^2 + M^2
- 2 q.v, so the largest inner products are the nearest neighbours and distance
bounds hold for them.

* Equal vectors are one *point*, with its k + 1 smallest ids: no more of them
  can be among the k best of any query, so a vector that a third of all rows
  hold is one point.
* ``PIVOTS`` pivots, fitted on a bounded sample of points, cut all points into
  Voronoi groups; a group is stored as blocks of at most about ``BLOCK_BYTES``
  (a large group has many). Queries belong to the group of their nearest pivot.
* A summary of each group (largest distance to its pivot, the k + 1 smallest
  distances) gives a first bound on a query's k-th distance. Each query is then
  solved in its own group, which tightens it.
* A query goes on to another group only where neither the group's ring nor the
  hyperplane between the two pivots is beyond its bound: queries are the fewer,
  so they are what is replicated, and points stay where they lie. Each block
  is solved by itself; scores are exact whole numbers; bounds in doubles have a
  slack far above their rounding, so no tie is lost.

Rows whose vector is null or holds null or non-finite entries, or without an id,
take no part. A shorter vector counts as filled up with zeros. Rows equal in id
and vector count once; all rows with the query's id are its own. Ties go to the
smaller id. An empty table, or one without queries, gives no rows; with fewer
candidates than k, all are returned. Components beyond 2^62 and scores beyond 64
bits are held at these limits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chargeline.llm import vectors
from chargeline.llm.frames import stored

SCALE = 256
PIVOTS = 64
#: Points that the pivots are fitted on (those of the smallest hashes), and their bytes at most.
SAMPLE = 4096
SAMPLE_BYTES = 32 << 20
#: Whole numbers of a block of points.
BLOCK_BYTES = 16 << 20
#: Queries scored at once against a block.
QUERIES = 256
#: Slack of distance bounds, as a share of the largest norm; rounding stays under 1e-6 of it.
SLACK = 1e-5
#: Salts of the grouping of equal vectors.
SALTS = 32


def _points(rows: DataFrame, keep: int) -> DataFrame:
    """(v, ids, norm2, dim): distinct whole-number vectors, packed without zeros at the end, and their smallest ids."""
    def run(batches):
        for batch in batches:
            values, off = vectors.lists(batch.column(1))
            whole = vectors.floors(values, SCALE)
            packed = []
            for a, b in zip(off[:-1], off[1:]):
                one = whole[a:b]
                used = np.flatnonzero(one)
                packed.append(one[:used[-1] + 1].tobytes() if len(used) else b"")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["id", "v"])

    def smallest(ids: str) -> Column:
        return F.slice(F.sort_array(ids), 1, keep)

    packed = rows.where("id is not null").mapInArrow(run, "id long, v binary")
    return (packed.groupBy("v", "id").agg(F.lit(1).alias("one"))
            .groupBy("v", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt")).agg(F.collect_list("id").alias("ids"))
            .select("v", smallest("ids").alias("ids"))
            .groupBy("v").agg(F.flatten(F.collect_list("ids")).alias("ids"))
            .select("v", smallest("ids").alias("ids"), (F.octet_length("v") / 8).cast("int").alias("dim")))


def _matrix(packed: list[bytes], dim: int) -> np.ndarray:
    out = np.zeros((len(packed), dim), np.int64)
    for i, b in enumerate(packed):
        out[i, :len(b) // 8] = np.frombuffer(b, np.int64)
    return out


def _norm2(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return np.einsum("ij,ij->i", x, x)


class Cells:
    """Pivots in the lifted space, and distances to them."""

    def __init__(self, pivots: np.ndarray, top2: float, dim: int):
        self.pivots, self.top2, self.dim = pivots, top2, dim
        self.own2 = np.einsum("ij,ij->i", pivots, pivots)
        apart2 = self.own2[:, None] + self.own2[None] - 2 * pivots @ pivots.T
        self.apart = np.sqrt(np.maximum(apart2, 0))

    def lifted(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        x = x.astype(np.float64)
        last = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.top2 - np.einsum("ij,ij->i", x, x), 0))
        return np.concatenate([x, last[:, None]], 1)

    def distances(self, y: np.ndarray) -> np.ndarray:
        d2 = np.einsum("ij,ij->i", y, y)[:, None] + self.own2[None] - 2 * y @ self.pivots.T
        return np.sqrt(np.maximum(d2, 0))

    @classmethod
    def fit(cls, sample: np.ndarray, top2: float, count: int, rounds: int = 6) -> Cells:
        """k-means on the sample, begun at its first points (their order is by hash)."""
        dim = sample.shape[1]
        y = cls(np.zeros((1, dim + 1)), top2, dim).lifted(sample)
        cells = cls(y[:count].copy(), top2, dim)
        for _ in range(rounds):
            own = cells.distances(y).argmin(1)
            total = np.zeros_like(cells.pivots)
            np.add.at(total, own, y)
            n = np.bincount(own, minlength=len(total))
            moved = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], cells.pivots)
            cells = cls(moved, top2, dim)
        return cells


def _grouped(points: DataFrame, shared) -> DataFrame:
    """(v, ids, cell, dist) with the nearest pivot in the lifted space."""
    def run(batches):
        cells = shared.value
        for batch in batches:
            d = cells.distances(cells.lifted(_matrix(batch.column(0).to_pylist(), cells.dim)))
            cell = d.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cell.astype(np.int32)),
                 pa.array(d[np.arange(len(d)), cell])], names=["v", "ids", "cell", "dist"])

    return points.select("v", "ids").mapInArrow(run, "v binary, ids array<long>, cell int, dist double")


def _summaries(grouped: DataFrame, pivots: int, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Points, largest distance and the ``keep`` smallest distances of each group (keep * pivots numbers)."""
    sizes = grouped.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("dist").alias("far")).collect()
    n, far, near = np.zeros(pivots, np.int64), np.zeros(pivots), np.full((pivots, keep), np.inf)
    for r in sizes:
        n[r.cell], far[r.cell] = r.n, r.far
    first = Window.partitionBy("cell").orderBy("dist")
    for r in grouped.select("cell", "dist").withColumn("i", F.row_number().over(first)).where(F.col("i") <= keep).collect():
        near[r.cell, r.i - 1] = r.dist
    return n, far, near


def _visits(queries: DataFrame, shared, info, first: bool, keep: int) -> DataFrame:
    """(v, cell) to solve: a query's own group first, then the groups that its bound does not exclude.

    ``queries`` has v and ``theta2``, the square of a bound on its last wanted distance so far (null: none).
    """
    def run(batches):
        cells = shared.value
        n, far, near = info.value
        slack = SLACK * np.sqrt(cells.top2) + 1e-9
        for batch in batches:
            packed = batch.column(0).to_pylist()
            d = cells.distances(cells.lifted(_matrix(packed, cells.dim), query=True))
            own = np.where(n > 0, d, np.inf).argmin(1)
            if first:
                go = np.zeros(d.shape, bool)
                go[np.arange(len(d)), own] = True
            else:
                # the group's nearest members are no farther than by way of the pivot
                reach = (d[:, :, None] + near[None]).reshape(len(d), -1)
                theta = np.partition(reach, keep - 1, 1)[:, keep - 1] if reach.shape[1] >= keep else np.full(len(d), np.inf)
                found = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
                theta = np.fmin(theta, np.sqrt(np.maximum(found, 0))) + slack
                mine = d[np.arange(len(d)), own][:, None]
                gap = np.maximum(cells.apart[own], 1e-300)
                ring = d - far[None]
                plane = (d ** 2 - mine ** 2) / (2 * gap) - slack * (1 + (d + mine) / gap)
                go = (np.maximum(ring, np.where(cells.apart[own] > slack, plane, -np.inf)) <= theta[:, None]) & (n > 0)[None]
                go[np.arange(len(d)), own] = False
            at, cell = np.nonzero(go)
            yield pa.RecordBatch.from_arrays([pa.array([packed[i] for i in at], pa.binary()),
                                              pa.array(cell.astype(np.int32))], names=["v", "cell"])

    return queries.mapInArrow(run, "v binary, cell int")


def _solve(visits: DataFrame, blocks: DataFrame, per_cell: DataFrame, dim: int, norm2: float, keep: int) -> DataFrame:
    """(v, score, id): the ``keep`` best ids of each visit to a block."""
    sent = (visits.join(per_cell, "cell").select("v", "cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                                                 F.lit(None).cast("array<long>").alias("ids"), F.lit(1).alias("kind")))
    rows = blocks.select("v", "cell", "part", "ids", F.lit(0).alias("kind")).unionByName(sent)

    def best(packed: list[bytes], held: np.ndarray, ids: np.ndarray, at: np.ndarray):
        for a in range(0, len(packed), QUERIES):
            some = packed[a:a + QUERIES]
            score = vectors.products(_matrix(some, dim), held, norm2)
            m = score.shape[1]
            last = np.partition(score, m - keep, 1)[:, m - keep] if m > keep else np.full(len(some), np.iinfo(np.int64).min)
            out: tuple[list, list, list] = ([], [], [])
            for i, v in enumerate(some):
                own = np.flatnonzero(score[i] >= last[i])
                count = at[own + 1] - at[own]
                s = np.repeat(score[i][own], count)
                who = np.concatenate([ids[at[j]:at[j + 1]] for j in own])
                order = np.lexsort((who, -s.astype(np.float64) if norm2 < 2.0 ** 52 else ~s))[:keep]
                out[0].extend([v] * len(order))
                out[1].append(s[order])
                out[2].append(who[order])
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(np.concatenate(out[1])),
                                              pa.array(np.concatenate(out[2]))], names=["v", "score", "id"])

    def run(batches):
        key, points, waiting = None, [], []

        def flush():
            if points and waiting:
                ids = [np.array(i, np.int64) for _, i in points]
                at = np.r_[0, np.cumsum([len(i) for i in ids])]
                yield from best(waiting, _matrix([v for v, _ in points], dim), np.concatenate(ids), at)

        for batch in batches:
            for v, cell, part, kind, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (cell, part) != key:
                    yield from flush()
                    key, points, waiting = (cell, part), [], []
                if kind:
                    waiting.append(v)
                    if len(waiting) >= 8 * QUERIES:
                        yield from flush()
                        waiting = []
                else:
                    points.append((v, ids))
        yield from flush()

    got = (rows.select("v", "cell", "part", "kind", "ids").repartition("cell", "part")
           .sortWithinPartitions("cell", "part", "kind").mapInArrow(run, "v binary, score long, id long"))
    return _best(got, ["v"], "id", keep)


def _best(rows: DataFrame, by: list[str], tie: str, keep: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc(tie))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def search(df: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5,
           pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id and score: the k best other rows of every row for which ``is_query`` holds.

    ``is_query`` is a condition on ``id_col``.
    """
    spark, keep = df.sparkSession, k + 1
    base = df.withColumn("_query", is_query)
    named = (base.where("_query").select(F.col(id_col), F.col(vec_col)))
    points = stored(_points(vectors.rows_of(df, id_col, vec_col), keep), "points")
    asked = stored(_points(vectors.rows_of(named, id_col, vec_col), 1 << 30), "queries")
    size = points.agg(F.max("dim").alias("dim"), F.count(F.lit(1)).alias("n")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not size.n:
        return empty
    dim = max(1, size.dim)

    def norms(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_norm2(_matrix(batch.column(0).to_pylist(), dim)))], names=["norm2"])

    top2 = points.select("v").mapInArrow(norms, "norm2 double").agg(F.max("norm2")).first()[0]
    some = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * dim)))
    sample = [bytes(r.v) for r in points.select("v").orderBy(F.xxhash64("v"), "v").limit(some).collect()]
    cells = Cells.fit(_matrix(sample, dim), top2, pivots)
    shared = spark.sparkContext.broadcast(cells)
    grouped = stored(_grouped(points, shared), "grouped")
    info = _summaries(grouped, len(cells.pivots), keep)
    block = max(64, BLOCK_BYTES // (8 * dim))
    parts = [int(-(-n // block)) for n in info[0]]
    per_cell = spark.createDataFrame([(i, p) for i, p in enumerate(parts) if p], "cell int, parts int")
    blocks = (grouped.join(F.broadcast(per_cell), "cell")  # one row a pivot
              .withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int")))
    told = spark.sparkContext.broadcast(info)

    unbounded = asked.select("v", F.lit(None).cast("double").alias("theta2"))
    first = stored(_solve(_visits(unbounded, shared, told, True, keep), blocks, F.broadcast(per_cell), dim, top2, keep), "first")

    def squares(batches):
        for batch in batches:
            own = _norm2(_matrix(batch.column(0).to_pylist(), dim))
            score = batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own + top2 - 2 * score)], names=["v", "theta2"])

    reached = first.where(F.col("rank") == keep).select("v", "score").mapInArrow(squares, "v binary, theta2 double")
    bounded = asked.select("v").join(reached, "v", "left")
    rest = _solve(_visits(bounded, shared, told, False, keep), blocks, F.broadcast(per_cell), dim, top2, keep)
    merged = _best(first.drop("rank").unionByName(rest.drop("rank")), ["v"], "id", keep).drop("rank")
    whose = asked.select("v", F.explode("ids").alias("query_id"))
    own = merged.join(whose, "v").where("id <> query_id")
    order = Window.partitionBy("query_id", "v").orderBy(F.desc("score"), "id")
    return (own.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int"), F.col("id").alias("vec_id"), "score"))
