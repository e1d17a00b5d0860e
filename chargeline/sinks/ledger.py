"""Which record ids a snapshot table holds, without reading the table.

Next to each part of the table lie its ids, in folders by a hash of the id
(``bucket``), and a Bloom filter per bucket: rows (word, bits), where an id
sets four bits of one 64-bit word. A batch looks up

1. the filter words of the buckets its own ids fall in (a semi join on bucket
   and word): an id whose bits are not all set by some part is new;
2. for the few that are left, the exact ids of *their* buckets (an anti join).

So a batch reads the filters of its buckets, about two bytes a stored id where
the filter is filled, and the ids of the buckets that it may share an id with:
for new records nearly none. All of it is partition pruning and joins. The
bucket lists are collected, at most ``buckets`` numbers. A filter word only ever
sends an id to the exact check, so its size (``words`` a bucket) is a matter of
speed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from chargeline.sinks import writers
from chargeline.sinks.snapshots import Snapshot, SnapshotTable

IDS, BLOOMS = "_ledger/ids", "_ledger/blooms"
#: Rewritten and vacuumed with the parts of the table.
SIDES = ((IDS, "bucket"), (BLOOMS, "bucket"))


@dataclass(frozen=True)
class IdLedger:
    table: SnapshotTable
    key: str
    buckets: int = 32
    words: int = 1 << 20

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _word(self) -> Column:
        return F.pmod(F.shiftright(F.xxhash64(self.key), 8), F.lit(self.words)).cast("long")

    def _bits(self) -> Column:
        h = F.xxhash64(self.key, F.lit(1))
        bits = None
        for i in range(4):
            one = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
            bits = one if bits is None else bits.bitwiseOR(one)
        return bits

    def _schema(self, side: str) -> StructType:
        own = ([StructField(self.key, StringType())] if side == IDS
               else [StructField("word", LongType()), StructField("bits", LongType())])
        return StructType([*own, StructField("batch", StringType()), StructField("bucket", IntegerType())])

    def ids(self, snapshot: Snapshot, buckets: list[int]) -> DataFrame | None:
        """The stored ids of some buckets."""
        return self._side(IDS, snapshot, buckets)

    def _side(self, side: str, snapshot: Snapshot, buckets: list[int]) -> DataFrame | None:
        rows = self.table.read(snapshot, schema=self._schema(side), side=side) if buckets else None
        return None if rows is None else rows.where(F.col("bucket").isin(buckets))

    def _touched(self, rows: DataFrame) -> list[int]:
        return sorted(r[0] for r in rows.select(self._bucket().alias("b")).distinct().collect())

    def maybe_known(self, rows: DataFrame, snapshot: Snapshot) -> DataFrame | None:
        """Ids of ``rows`` that the filters do not rule out."""
        blooms = self._side(BLOOMS, snapshot, self._touched(rows))
        if blooms is None:
            return None
        asked = rows.select(self.key, self._bucket().alias("bucket"), self._word().alias("word"), self._bits().alias("mask"))
        b = blooms.select(F.col("bucket").alias("_b"), F.col("word").alias("_w"), "bits")
        hit = ((F.col("bucket") == F.col("_b")) & (F.col("word") == F.col("_w"))
               & (F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")))
        return asked.join(b, hit, "left_semi").select(self.key)

    def new_only(self, rows: DataFrame, snapshot: Snapshot) -> DataFrame:
        """Rows whose id is not stored yet."""
        maybe = self.maybe_known(rows, snapshot)
        known = None if maybe is None else self.ids(snapshot, self._touched(maybe))
        return rows if known is None else rows.join(known.select(self.key), self.key, "left_anti")

    def stored_among(self, rows: DataFrame, snapshot: Snapshot) -> DataFrame | None:
        """The stored ids (as often as they are stored) that ``rows`` hold too; None where there is none."""
        maybe = self.maybe_known(rows, snapshot)
        known = None if maybe is None else self.ids(snapshot, self._touched(maybe))
        return None if known is None else known.select(self.key).join(maybe.distinct(), self.key, "left_semi")

    def new_ids(self, snapshot: Snapshot, after: int) -> DataFrame | None:
        """The ids of the batches later than ``after``."""
        rows = self.table.read(snapshot, after=after, schema=self._schema(IDS), side=IDS)
        return None if rows is None else rows.select(self.key)

    def write(self, name: str, rows: DataFrame) -> None:
        """The ids and filters of a written part."""
        writers.append_partitioned(rows.select(self.key, self._bucket().alias("bucket")), f"{self.table.root}/{IDS}/{name}",
                                   "bucket")
        words = (rows.select(self._bucket().alias("bucket"), self._word().alias("word"), self._bits().alias("mask"))
                 .groupBy("bucket", "word").agg(F.bit_or("mask").alias("bits")))
        writers.append_partitioned(words, f"{self.table.root}/{BLOOMS}/{name}", "bucket")

    def compact(self, partition_col: str, **kwargs) -> Snapshot:
        return self.table.compact(partition_col, sides=SIDES, **kwargs)


def append_new(spark: SparkSession, batch: DataFrame, path: str, key: str, partition_col: str,
               writer: str | None = None, batch_id: int | None = None,
               consumed: dict[str, int] | None = None) -> Snapshot:
    """Commit the rows of a batch whose id is new, one per id: a replayed or redelivered record is stored once."""
    from chargeline.operators.dedup import dedupe

    table = SnapshotTable(spark, path)
    ledger = IdLedger(table, key)
    now = table.snapshot()
    if writer is not None and now.writers.get(writer, -1) >= batch_id:
        return now
    rows = dedupe(batch, [key]).persist()
    try:
        return table.append(ledger.new_only(rows, now), partition_col, writer=writer, batch_id=batch_id,
                            consumed=consumed, also=ledger.write)
    finally:
        rows.unpersist()
