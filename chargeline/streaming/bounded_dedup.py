"""Streaming de-duplication with bounded state that loses no late record.

A watermark bounds the ids that ``dropDuplicatesWithinWatermark`` keeps, but
Spark drops rows later than it. Here late rows never reach it:

1. *Split.* Each micro-batch of valid records is cut at a line known before it
   begins: the largest event time of the earlier micro-batches, less the delay.
   Rows at or after it go to ``on_time``, earlier ones (and those without an
   event time) to ``late``. The line is stored per batch, so a replayed batch is
   cut at the same place and rewrites its own partition.
2. *De-duplicate.* A second stream reads ``on_time`` with a watermark of the same
   delay. A trigger takes every file there is, hence whole batches of the split (a
   batch appears by one folder rename, so on object stores without atomic renames
   use the normalised store instead). So the watermark follows rows of earlier
   batches only, never passes the line and drops nothing; ids leave the state
   once it has passed them.
3. *Reconcile.* A batch job takes the late rows of the batches since its last
   run, keeps one per record id, leaves out ids that came on time or were
   reconciled before, and commits the rest.

``unique_records`` is the union of 2 and 3. A copy of a record is recognised if it
carries the same event time (a redelivered message does), or if both came within
the delay, or if one of them was late; the normalised store (``sinks.ledger``)
is unique whatever the times.

All tables lie under one folder together with the checkpoints, so they are kept
or lost together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from chargeline.functions.columns import month_start, ts_literal
from chargeline.operators import mediation
from chargeline.rules import DEFAULT_RULES, Rules
from chargeline.schemas import NORMALIZED
from chargeline.sinks import ledger, writers
from chargeline.sinks.snapshots import SnapshotTable, read_table
from chargeline.streaming.mediation_stream import mediated_stream

_SPLIT = StructType([*NORMALIZED.fields, StructField("batch_id", LongType())])


def _line_before(spark: SparkSession, root: str, batch_id: int):
    """Largest event time before a batch (None: no row had one)."""
    done = writers.read_table_or_none(spark, f"{root}/progress/batch_id={batch_id - 1}")
    return None if done is None else done.first()["newest"]


def split_batch(root: str, delay: str, rules: Rules = DEFAULT_RULES):
    """``foreachBatch`` callback of step 1, for mediated records."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = _line_before(spark, root, batch_id)
        valid = mediation.valid_records(batch).select(*NORMALIZED.fieldNames()).withColumn("batch_id", F.lit(batch_id).cast("long"))
        valid = valid.persist()
        try:
            line = F.lit(None).cast("timestamp_ntz") if newest is None else ts_literal(newest) - F.expr(f"INTERVAL {delay}")
            on_time = F.col("timestamp").isNotNull() & F.coalesce(F.col("timestamp") >= line, F.lit(True))
            writers.overwrite_partitions(valid.where(on_time), f"{root}/on_time", "batch_id", balance=False)
            writers.overwrite_partitions(valid.where(~on_time), f"{root}/late", "batch_id", balance=False)
            now = valid.agg(F.greatest(F.max("timestamp"), F.lit(newest).cast("timestamp_ntz")).alias("newest"))
            now.write.mode("overwrite").parquet(f"{root}/progress/batch_id={batch_id}")
        finally:
            valid.unpersist()
    return write


def start_split(messages: DataFrame, root: str, delay: str, trigger: dict | None = None,
                rules: Rules = DEFAULT_RULES) -> StreamingQuery:
    return (mediated_stream(messages, rules).writeStream.foreachBatch(split_batch(root, delay, rules))
            .queryName("mediation_split").option("checkpointLocation", f"{root}/_checkpoints/split")
            .trigger(**(trigger or {"availableNow": True})).start())


def start_dedup(spark: SparkSession, root: str, delay: str, trigger: dict | None = None) -> StreamingQuery:
    """Step 2. A replayed split may have replaced a file that was listed already; the new one holds the same rows."""
    rows = (spark.readStream.schema(_SPLIT).option("ignoreMissingFiles", "true").parquet(f"{root}/on_time").withColumn("_event_time", F.col("timestamp").cast("timestamp"))
            .withWatermark("_event_time", delay).dropDuplicatesWithinWatermark(["record_id"])
            .select(*NORMALIZED.fieldNames()))
    return (rows.writeStream.format("parquet").option("path", f"{root}/valid").queryName("mediation_dedup")
            .option("checkpointLocation", f"{root}/_checkpoints/dedup").outputMode("append")
            .trigger(**(trigger or {"availableNow": True})).start())


def reconcile_late(spark: SparkSession, root: str) -> int:
    """Step 3; returns the batches taken. A run that fails commits nothing and is repeated whole."""
    table = SnapshotTable(spark, f"{root}/valid_late")
    done = table.snapshot().consumed.get("late", -1)
    late = writers.read_table_or_none(spark, f"{root}/late", _SPLIT)
    # batches whose line is stored are split completely
    whole = writers.read_table_or_none(spark, f"{root}/progress")
    if late is None or whole is None:
        return 0
    last = whole.agg(F.max("batch_id")).first()[0]
    fresh = late.where(F.col("batch_id").between(done + 1, last)).drop("batch_id")
    came = writers.read_table_or_none(spark, f"{root}/on_time", _SPLIT)
    if came is not None:
        fresh = fresh.join(came.select("record_id"), "record_id", "left_anti")
    ledger.append_new(spark, fresh.withColumn("billing_month", month_start("timestamp")), table.root, "record_id",
                      "billing_month", consumed={"late": last})
    return last - done


def unique_records(spark: SparkSession, root: str) -> DataFrame:
    """Every valid record once: those on time and those reconciled."""
    out = spark.createDataFrame([], NORMALIZED)
    for df in (writers.read_table_or_none(spark, f"{root}/valid", NORMALIZED), read_table(spark, f"{root}/valid_late")):
        if df is not None:
            out = out.unionByName(df.select(*NORMALIZED.fieldNames()))
    return out
