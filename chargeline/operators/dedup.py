"""Deterministic, skew-safe de-duplication.

``dedupe`` keeps, per key, the row that is smallest under a total order of its
columns. It is an aggregate (``min`` of a struct), so each map task first
collapses its own copies (partial aggregation) and a key that holds a third of
all rows never lands in one task as raw rows. A window ``row_number`` would
ship every copy of a hot key to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (),
           keep: str = "min") -> DataFrame:
    """One row per ``keys``; survivor = smallest (``keep="min"``) or largest
    (``keep="max"``) by ``order`` then the remaining columns in table order
    (NULLs sort first, as in Spark's struct ordering)."""
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    order = [c for c in order if c in others]
    rest = [c for c in others if c not in order]
    pick = F.min if keep == "min" else F.max
    packed = df.groupBy(*keys).agg(pick(F.struct(*order, *rest)).alias("_survivor"))
    return packed.select(*keys, *[F.col(f"_survivor.{c}").alias(c) for c in others]) \
        .select(*df.columns)
