"""Embedding columns as whole-number matrices, shared by the vector operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Whole numbers beyond this (of vectors far outside any embedding) are held at it.
LIMIT = 1 << 62


def usable(vector: str) -> Column:
    """True for a vector that is not null and holds no null, NaN or infinite entry."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                     & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & F.coalesce(whole, F.lit(False))


def rows_of(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id long, v array<double>) of the rows with a usable vector."""
    return (df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
            .where(usable("v")).select("id", F.col("v").cast("array<double>").alias("v")))


def floors(values: np.ndarray, scale: int, plus: int = 0) -> np.ndarray:
    """floor(scale * value) + plus of doubles, as 64-bit whole numbers."""
    whole = np.floor(values * float(scale))
    return np.clip(whole, -float(LIMIT), float(LIMIT)).astype(np.int64) + plus


def lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All entries of a list column one after the other, and the offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    off = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]], off - off[0]


def exact_in_doubles(norm2: float) -> bool:
    """Whether inner products of whole-number vectors with |v|^2 up to norm2 are exact as doubles, in any order of sums."""
    return norm2 < 2.0 ** 52


def products(a: np.ndarray, b: np.ndarray, norm2: float) -> np.ndarray:
    """Exact inner products of the rows of a with those of b, as 64-bit whole numbers (held at their limits)."""
    if exact_in_doubles(norm2):
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    out = a.astype(object) @ b.astype(object).T
    return np.clip(out, -(1 << 63), (1 << 63) - 1).astype(np.int64)
