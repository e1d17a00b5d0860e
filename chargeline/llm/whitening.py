"""Embedding whitening from an exact, bit-sliced scatter matrix.

Entries c become x = floor(64 * c) + 1000000. The covariance of x is computed
in whole numbers:

* One pass finds each dimension's smallest x; entries are shifted by it, so they
  are small and not negative.
* A second pass packs, for every dimension and bit, that bit of all rows of a
  batch into 64-bit words (a *plane*). The cross-product of two dimensions is
  the sum over their bits i, j of 2^(i+j) * popcount(plane_i AND plane_j); a
  plane of ones gives the sums. Tasks add their counts up and send one row per
  pair of dimensions, as 32-bit limbs that Spark sums exactly.
* The driver holds one number per pair of dimensions: n * cross - sum * sum is
  n^2 times the covariance, still in whole numbers; only then does it become
  doubles for the eigenvectors.

Rows whose vector is null or holds null or non-finite entries are dropped. Vectors
of another length than the commonest (of equally common ones the longest), and
empty ones, are dropped too. A null id and repeated rows count like any other.
Components whose eigenvalue is zero to double precision have a null ``whitened``
and are left out of ``identity_error``. A sum of squares beyond 64 bits gives a
null ``deviation``. Without remaining rows the result is empty. Entries beyond
2^62 are held there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chargeline.llm import vectors

SCALE, PLUS = 64, 1_000_000
COMPONENTS = 32
#: Rows whose planes are packed together; a multiple of 64.
ROWS = 8192
#: 32-bit limbs of a cross-product: two entries of 64 bits each, and 63 bits of rows.
LIMBS = 6


def _kept(df: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    """(id, v) of the vectors of the commonest length, and that length (0: none)."""
    rows = vectors.rows_of(df, id_col, vec_col).where("size(v) > 0")
    common = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if common is None:
        return rows, 0
    return rows.where(F.size("v") == common.dim), common.dim


def _entries(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    values, _ = vectors.lists(batch.column(batch.num_columns - 1))
    return vectors.floors(values, SCALE, PLUS).reshape(-1, dim)


def _ranges(rows: DataFrame, dim: int) -> tuple[int, np.ndarray, int]:
    """Rows, smallest entry of each dimension, and the bits of the largest shifted entry."""
    def run(batches):
        n, low, high = 0, None, None
        for batch in batches:
            x = _entries(batch, dim)
            if len(x):
                n += len(x)
                low = x.min(0) if low is None else np.minimum(low, x.min(0))
                high = x.max(0) if high is None else np.maximum(high, x.max(0))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(np.full(dim, n)),
                                              pa.array(low), pa.array(high)], names=["d", "n", "low", "high"])

    found = (rows.select("v").mapInArrow(run, "d int, n long, low long, high long")
             .groupBy("d").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
             .orderBy("d").collect())
    low = np.array([r.low for r in found], np.int64)
    return found[0].n, low, max(1, max((r.high - r.low).bit_length() for r in found))


def planes(y: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes (bit, dimension, word) of shifted entries, after a last dimension of ones in plane 0."""
    n, dim = y.shape
    out = np.zeros((bits, dim + 1, -(-n // 64) * 8), np.uint8)
    for i in range(bits):
        packed = np.packbits(((y >> np.uint64(i)) & np.uint64(1)).astype(bool), axis=0).T
        out[i, :dim, :packed.shape[1]] = packed
    ones = np.packbits(np.ones(n, bool))
    out[0, dim, :len(ones)] = ones
    return out.view(np.uint64)


def add_counts(into: np.ndarray, p: np.ndarray) -> None:
    """Adds popcount(plane_i[a] AND plane_j[b]) to into[i + j, a, b] for a <= b."""
    bits, dims, _ = p.shape
    for a in range(dims):
        for i in range(bits):
            if p[i, a].any():
                into[i:i + bits, a, a:] += np.bitwise_count(p[:, a:] & p[i, a]).sum(-1, dtype=np.int64)


def _scatter(rows: DataFrame, dim: int, low: np.ndarray, bits: int) -> list[list[int]]:
    """Exact sums of y_a * y_b (a <= b); b = dim stands for ones, so those are the sums of y_a."""
    def run(batches):
        counts = np.zeros((2 * bits - 1, dim + 1, dim + 1), np.int64)
        some = False
        for batch in batches:
            y = (_entries(batch, dim) - low).astype(np.uint64)
            for at in range(0, len(y), ROWS):
                add_counts(counts, planes(y[at:at + ROWS], bits))
                some = True
        if some:
            a, b = np.triu_indices(dim + 1)
            limbs = np.zeros((LIMBS, len(a)), np.int64)
            for w in range(2 * bits - 1):
                # 2^w * count, laid over the limbs in pieces of 32 bits
                at, shift = divmod(w, 32)
                c = counts[w][a, b]
                for piece in range(2):  # a count has up to 63 bits: low and high half
                    half = (c >> (32 * piece)) & 0xFFFFFFFF
                    limbs[at + piece] += (half & ((1 << (32 - shift)) - 1)) << shift
                    limbs[at + piece + 1] += half >> (32 - shift)
            yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)),
                                              *(pa.array(v) for v in limbs)],
                                             names=["a", "b", *(f"l{i}" for i in range(LIMBS))])

    schema = "a int, b int, " + ", ".join(f"l{i} long" for i in range(LIMBS))
    sums = (rows.select("v").mapInArrow(run, schema).groupBy("a", "b")
            .agg(*(F.sum(f"l{i}").alias(f"l{i}") for i in range(LIMBS))).collect())
    total = [[0] * (dim + 1) for _ in range(dim + 1)]
    for r in sums:
        total[r.a][r.b] = total[r.b][r.a] = sum(r[2 + i] << (32 * i) for i in range(LIMBS))
    return total


@dataclass(frozen=True)
class Whitener:
    """What the fit list gives: shifts, sums, and the projection on the whitened components."""

    n: int
    low: np.ndarray
    bits: int
    sums: np.ndarray  # of shifted entries; Python ints
    project: np.ndarray  # dimension x component, unit eigenvectors over sqrt(eigenvalue)
    real: np.ndarray  # components with an eigenvalue above zero
    explained: np.ndarray
    identity_error: float | None

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        y = x - self.low
        if self.n.bit_length() + self.bits < 62:
            return self.n * y - self.sums.astype(np.int64)
        return self.n * y.astype(np.uint64).astype(object) - self.sums

    def deviations(self, centred: np.ndarray) -> list[int | None]:
        if 2 * (self.n.bit_length() + self.bits) + len(self.low).bit_length() < 63:
            return (centred.astype(np.int64) ** 2).sum(1).tolist()
        return [v if v < 1 << 63 else None for v in (centred.astype(object) ** 2).sum(1)]

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(np.float64) @ self.project


def fit(rows: DataFrame, dim: int, components: int = COMPONENTS) -> Whitener:
    """Whitener of rows (id, v) that all have ``dim`` entries; there is at least one."""
    n, low, bits = _ranges(rows, dim)
    total = _scatter(rows, dim, low, bits)
    sums = [total[a][dim] for a in range(dim)]
    # n^2 times the covariance, in whole numbers; the division rounds once
    v = np.array([[(n * total[a][b] - sums[a] * sums[b]) / (n * n) for b in range(dim)] for a in range(dim)])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    real = e > max(e[0], 0) * dim * 2.0 ** -52
    project = np.where(real, u / np.sqrt(np.where(real, e, 1.0)), 0.0)
    trace = sum(n * total[a][a] - sums[a] ** 2 for a in range(dim)) / (n * n)
    error = None
    if real.any():
        w = project[:, real]
        error = float(np.abs(w.T @ v @ w - np.eye(w.shape[1])).max())
    explained = np.maximum(e, 0) / trace if trace else np.full(len(e), np.nan)
    return Whitener(n, low, bits, np.array(sums, object), project, real, explained, error)


_OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error, a row for each component."""
    spark = df.sparkSession
    rows, dim = _kept(df, id_col, vec_col)
    if not dim:
        return spark.createDataFrame([], _OUT)
    model = spark.sparkContext.broadcast(fit(rows, dim, components))

    def run(batches):
        w = model.value
        c = len(w.real)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                some = batch.slice(at, 2048)
                m = w.centred(_entries(some, dim))
                ids = some.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([
                    pa.array([i for i in ids for _ in range(c)], pa.int64()),
                    pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), len(ids))),
                    pa.array(np.full(c * len(ids), w.n, np.int64)),
                    pa.array([d for d in w.deviations(m) for _ in range(c)], pa.int64()),
                    pa.array(w.whitened(m).ravel(), mask=~np.tile(w.real, len(ids))),
                    pa.array(np.tile(w.explained, len(ids)), mask=np.tile(np.isnan(w.explained), len(ids))),
                    pa.array([w.identity_error] * (c * len(ids)), pa.float64())],
                    names=[x.split()[0] for x in _OUT.split(", ")])

    return rows.mapInArrow(run, _OUT)
