"""Join helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 8 << 20


def broadcast_if_small(dim: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a dimension whose planned size is at most ``max_bytes``.

    The size is the optimised plan's own statistic, so no job runs. A larger
    dimension is left to the planner (and to AQE's byte threshold at run time).
    """
    size = int(str(dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(dim) if size <= max_bytes else dim


def heavy_keys(facts: DataFrame, key: str, share: float = 0.01, tracked: int = 10_000) -> list:
    """The keys that hold at least ``share`` of the rows: at most 1 / share of them.

    One pass over the key column with a frequent-items sketch, which keeps
    ``tracked`` items a task. The sketch may be off by a small part of ``share``;
    that changes which branch of ``left_join_split`` a key takes, not the result.
    """
    most = int(1 / share)
    top = facts.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k({key}, {most}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return sorted(x["item"] for x in top["top"] or [] if x["count"] >= share * top["n"])


def left_join_split(facts: DataFrame, dim: DataFrame, key: str, hot: Sequence) -> DataFrame:
    """Left join on a unique ``key``; the rows of the ``hot`` keys are joined where they lie.

    Their dimension rows (one a key, so as many as ``hot`` at most) are broadcast;
    the other rows meet the dimension as planned, e.g. in its buckets. So a key
    that holds a third of all facts is never shuffled into one task.
    """
    if not hot:
        return facts.join(dim, key, "left")
    is_hot = F.coalesce(F.col(key).isin(*hot), F.lit(False))
    few = F.broadcast(dim.where(is_hot))
    return (facts.where(is_hot).join(few, key, "left")
            .unionByName(facts.where(~is_hot).join(dim, key, "left")))


def new_keys_only(batch: DataFrame, existing: DataFrame | None, key: str) -> DataFrame:
    """Rows of ``batch`` whose ``key`` is not in ``existing`` (left anti join).

    The key alone decides: a record that comes again with another event time,
    or with none, is still the same record. Only the key column is read.
    """
    if existing is None:
        return batch
    return batch.join(existing.select(key), key, "left_anti")
