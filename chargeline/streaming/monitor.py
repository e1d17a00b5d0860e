"""Stream monitoring (A08): per-batch progress counters from a listener."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def _counts(progress) -> dict[str, int]:
    return {"input_rows": progress.numInputRows,
            "late_rows": sum(op.numRowsDroppedByWatermark for op in progress.stateOperators),
            "state_rows": sum(op.numRowsTotal for op in progress.stateOperators)}


class ProgressCounter(StreamingQueryListener):
    """Keeps, per query name, rows in, rows dropped by the watermark and the
    number of batches. Register with ``spark.streams.addListener``."""

    def __init__(self):
        self.totals: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        t = self.totals.setdefault(p.name or str(p.id), {"batches": 0, "input_rows": 0, "late_rows": 0})
        now = _counts(p)
        t["batches"] += 1
        t["input_rows"] += now["input_rows"]
        t["late_rows"] += now["late_rows"]

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


class ProgressLog(StreamingQueryListener):
    """Appends every batch's counters to a table, one small file keyed by query and batch.

    A query's own progress history is bounded and ends with its process; this
    one does not. A batch that runs again after a restart replaces its file, so
    it counts once. Register with ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        name = p.name or str(p.id)
        row = {"query_name": name, "batch_id": p.batchId, "batch_time": p.timestamp, **_counts(p)}
        file = self._path(f"{self.root}/query={name}/batch-{p.batchId:012d}.json")
        if not p.numInputRows and self._fs.exists(file):  # a trigger that found nothing repeats the last batch's id
            return
        out = self._fs.create(file, True)
        try:
            out.write(bytearray(json.dumps(row) + "\n", "utf-8"))
        finally:
            out.close()

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def progress_rows(spark: SparkSession, root: str) -> DataFrame:
    """A row per query and batch of a ``ProgressLog``."""
    return spark.read.schema("query_name string, batch_id long, batch_time string, input_rows long, late_rows long, "
                             "state_rows long").json(root)


def progress_totals(spark: SparkSession, root: str) -> DataFrame:
    """Batches, rows in, rows dropped as late and the largest state, per query, over all runs."""
    return progress_rows(spark, root).groupBy("query_name").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("input_rows").alias("input_rows"),
        F.sum("late_rows").alias("late_rows"), F.max("state_rows").alias("state_rows"))


def drain(spark: SparkSession, seconds: int = 30) -> None:
    """Wait until the listeners have seen what happened so far."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(seconds * 1000)
