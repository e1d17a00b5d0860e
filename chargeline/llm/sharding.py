"""Sharding by a hierarchical weighted hash tree (native).

A row descends region, rack and shard levels. At each level every candidate
draws ``-ln(u) / weight`` with ``u`` hashed from the row's key and the
candidate's name, and the smallest draw wins, so a candidate wins in proportion
to its weight and a draw depends on no other candidate. Capacity added later is
a new *wave*: it takes part at the region level under its own name, as a
further draw of its region, so rows move only into the new wave, and a changed
weight moves rows only into or out of the subtree that changed.

Null keys hash as the text ``null``; repeated keys go to the same shard; an
empty table gives an empty result. Of equal draws (52 bits) the candidate that
comes first in the tree wins. A text's length does not matter to the work but
for its checksum. Only the named columns are read, so further
columns (also ones called ``shard`` or ``slot``) do no harm.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chargeline.llm.frames import offsets, settle, text_bytes

#: Rows of one shard numbered together: consecutive rows of one input split.
BLOCK_BITS = 14
ROW_OVERHEAD = 16


@dataclass(frozen=True)
class Shard:
    shard: int
    region: int
    rack: int
    weight: float = 1.0
    wave: int = 0

    def path(self) -> tuple[str, str, str]:
        top = f"{self.wave}/{self.region}"
        return top, f"{top}/{self.rack}", f"{top}/{self.rack}/{self.shard}"


def even_tree(shards: int, regions: int = 4, racks: int = 2) -> list[Shard]:
    """``shards`` equal shards dealt over ``regions`` times ``racks`` racks."""
    return [Shard(s, s % regions, s // regions % racks) for s in range(shards)]


def grow(tree: list[Shard], region: int = 0, rack: int = 0, weight: float = 1.0) -> list[Shard]:
    """The tree with one more shard, as a new wave of capacity."""
    return [*tree, Shard(1 + max(s.shard for s in tree), region, rack, weight, 1 + max(s.wave for s in tree))]


def tree_of(shards: int, base: int = 32, regions: int = 4, racks: int = 2) -> list[Shard]:
    """The one tree of so many shards: an even one of ``base``, and a wave for each shard beyond, dealt in turn.

    So key and number of shards alone decide a row's shard; from ``base`` shards
    on, one more takes rows only into itself.
    """
    tree = even_tree(min(shards, base), regions, racks)
    for s in range(base, shards):
        tree = grow(tree, s % regions, s // regions % racks)
    return tree


def _levels(tree: list[Shard]) -> tuple[dict, list[dict]]:
    """Weight of every node, and per level the children of every parent."""
    weight: dict[str, float] = defaultdict(float)
    children: list[dict[str, list[str]]] = [defaultdict(list) for _ in range(3)]
    for s in tree:
        parent = ""
        for level, node in enumerate(s.path()):
            weight[node] += s.weight
            if node not in children[level][parent]:
                children[level][parent].append(node)
            parent = node
    return weight, children


def _draw(key: Column, node: Column, weight: Column) -> Column:
    bits = F.conv(F.substring(F.md5(F.concat_ws("|", key, node)), 1, 13), 16, 10).cast("long")
    return -F.log((bits.cast("double") + 0.5) / F.lit(float(1 << 52))) / weight


def shard_of(key: Column, tree: list[Shard]) -> Column:
    """Shard number of a row with this key."""
    if not tree or any(s.weight <= 0 for s in tree):
        raise ValueError("a tree needs shards, all of positive weight")
    if len({s.shard for s in tree}) < len(tree):
        raise ValueError("shard numbers must be distinct")
    key = F.coalesce(key.cast("string"), F.lit("null"))
    weight, children = _levels(tree)
    numbers = {s.path()[2]: s.shard for s in tree}
    at: Column = F.lit(0)
    parents = [""]
    for level in range(3):
        below, options = [], []
        for parent in parents:
            nodes = children[level][parent]
            options.append(F.array(*[
                F.struct(F.lit(n).alias("node"), F.lit(float(weight[n])).alias("weight"),
                         F.lit(numbers[n] if level == 2 else len(below) + i).alias("at"))
                for i, n in enumerate(nodes)]))
            below += nodes
        here = F.element_at(F.array(*options), at + 1) if len(options) > 1 else options[0]
        draws = F.transform(here, lambda c: F.struct(_draw(key, c["node"], c["weight"]).alias("d"),
                                                     c["at"].alias("at")))
        at = F.array_min(draws)["at"]
        parents = below
    return at.cast("int")


def write_shards(df: DataFrame, path: str, tree: list[Shard], key_col: str = "doc_id",
                 shard_col: str = "shard") -> None:
    """Write the rows to one folder per shard; large shards become many files."""
    if shard_col in df.columns:
        raise ValueError(f"the input has a column {shard_col!r}; name another shard_col")
    (df.withColumn(shard_col, shard_of(F.col(key_col), tree)).hint("rebalance", shard_col)
     .write.partitionBy(shard_col).parquet(path))


def assign(df: DataFrame, tree: list[Shard], grown: list[Shard] | None = None,
           key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard and gapless slot of every row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Slots number a shard's rows from 0. Rows are numbered in blocks of at most
    2^14 consecutive rows of an input split, and a running sum of the block
    counts gives each block's first slot, so no task holds a shard. The thin
    rows are checkpointed first, which fixes their block and order.
    """
    rows = df.select(
        F.col(key_col).alias("doc_id"),
        (F.octet_length(text_bytes(F.col(text_col))) + ROW_OVERHEAD).cast("long").alias("size"),
        F.crc32(text_bytes(F.col(text_col))).alias("text_crc32"),
        F.monotonically_increasing_id().alias("_row"))
    rows = settle(rows.select(
        "*", shard_of(F.col("doc_id"), tree).alias("shard"),
        (shard_of(F.col("doc_id"), grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        F.shiftright("_row", BLOCK_BITS).alias("_block")))
    counts = rows.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"))
    first = offsets(counts, ["shard"], "_block", "_n", "_first")
    order = Window.partitionBy("shard", "_block").orderBy("_row")
    return (rows.withColumn("_at", F.row_number().over(order) - 1).join(first, ["shard", "_block"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("_first") + F.col("_at")).cast("long").alias("slot"), "grown_shard"))
