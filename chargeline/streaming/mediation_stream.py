"""Structured Streaming mediation and the normalised-record store.

Sources give one interface, a streaming DataFrame with a text column
``value``: Kafka in production, text files (one JSON message per line) in
tests and backfills. The same batch transforms (parse, normalise, validate)
run inside the streaming plan.

* valid records are de-duplicated by record_id. By default this is exact and
  loses nothing; its state (record ids, on local disk) grows with the stream.
  ``rules.dedup_watermark`` bounds the state and then drops rows later than
  it. ``streaming.bounded_dedup`` bounds it and drops nothing;
  ``start_mediation_store`` keeps no state and loses nothing;
* dead letters pass through unchanged (no state);
* the normalised store is a snapshot table that ``foreachBatch`` appends to,
  once per record_id (``sinks.ledger``): a replayed micro-batch writes nothing
  twice, and errors fail the query instead of being swallowed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chargeline.functions.columns import month_start
from chargeline.operators import mediation
from chargeline.rules import DEFAULT_RULES, Rules
from chargeline.schemas import NORMALIZED
from chargeline.sinks import ledger, writers


def usage_source(spark: SparkSession, kind: str = "kafka", *, path: str | None = None,
                 servers: str | None = None, topic: str | None = None,
                 starting_offsets: str = "latest", max_per_trigger: int | None = None) -> DataFrame:
    """``max_per_trigger`` bounds a micro-batch (messages, or files of a text
    source); a backlog is then worked off in several batches, none left out."""
    if kind == "kafka":
        reader = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", servers)
                  .option("subscribe", topic)
                  .option("startingOffsets", starting_offsets)
                  .option("failOnDataLoss", "false"))
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(max_per_trigger))
        return reader.load().selectExpr("CAST(value AS STRING) AS value")
    reader = spark.readStream.format("text")
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_per_trigger))
    return reader.load(path)


def mediated_stream(messages: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    return mediation.mediate(mediation.parse_messages(messages), rules)


def valid_stream(messages: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    valid = mediation.valid_records(mediated_stream(messages, rules))
    if rules.dedup_watermark is None:
        return valid.dropDuplicates(["record_id"])
    # watermarks need an instant-typed column; the wall-clock NTZ time is
    # read in the session zone (pinned to UTC) and dropped afterwards
    return (valid.withColumn("_event_time", F.col("timestamp").cast("timestamp"))
            .withWatermark("_event_time", rules.dedup_watermark)
            .dropDuplicatesWithinWatermark(["record_id"])
            .drop("_event_time"))


def dead_letter_stream(messages: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    return mediation.dead_letters(mediated_stream(messages, rules))


def _sink(df: DataFrame, name: str, checkpoint: str, *, fmt: str, path: str | None,
          servers: str | None, topic: str | None, trigger: dict) -> StreamingQuery:
    if fmt == "kafka":
        w = (mediation.serialize(df, key="record_id").writeStream.format("kafka")
             .option("kafka.bootstrap.servers", servers).option("topic", topic))
    elif fmt == "console":
        w = df.writeStream.format("console").option("truncate", False)
    else:
        w = df.writeStream.format(fmt).option("path", path)
    return (w.queryName(name).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(**trigger).start())


def start_mediation(messages: DataFrame, *, checkpoint_root: str, fmt: str = "parquet",
                    valid_path: str | None = None, dead_path: str | None = None,
                    servers: str | None = None, valid_topic: str | None = None,
                    dead_topic: str | None = None, trigger: dict | None = None,
                    console_trigger: dict | None = None,
                    rules: Rules = DEFAULT_RULES) -> list[StreamingQuery]:
    """Start the valid and dead-letter queries (each with its own checkpoint).

    ``trigger`` defaults to ``{"availableNow": True}``; production passes
    ``{"processingTime": "10 seconds"}``. ``console_trigger`` (e.g.
    ``{"processingTime": "30 seconds"}``) adds a debug query printing every
    mediated record, untruncated.
    """
    trigger = trigger or {"availableNow": True}
    debug = []
    if console_trigger:
        debug = [_sink(mediated_stream(messages, rules), "mediation_console", f"{checkpoint_root}/console",
                       fmt="console", path=None, servers=None, topic=None, trigger=console_trigger)]
    return debug + [
        _sink(valid_stream(messages, rules), "mediation_valid", f"{checkpoint_root}/valid",
              fmt=fmt, path=valid_path, servers=servers, topic=valid_topic, trigger=trigger),
        _sink(dead_letter_stream(messages, rules), "mediation_dead", f"{checkpoint_root}/dead",
              fmt=fmt, path=dead_path, servers=servers, topic=dead_topic, trigger=trigger),
    ]


def store_batch(table_path: str, writer: str | None = None):
    """``foreachBatch`` callback: commits a normalised micro-batch, each record once.

    ``writer`` names the stream (its checkpoint): a batch that it has committed
    before is left out without a look at its rows."""
    def write(batch: DataFrame, batch_id: int) -> None:
        keyed = batch.withColumn("billing_month", month_start("timestamp"))
        ledger.append_new(batch.sparkSession, keyed, table_path, "record_id", "billing_month", writer, batch_id)
    return write


def start_normalized_store(spark: SparkSession, source_path: str | None, table_path: str,
                           checkpoint: str, trigger: dict | None = None,
                           messages: DataFrame | None = None) -> StreamingQuery:
    """Consume normalised records into the ``normalized_records`` table,
    partitioned by month: from the Parquet file sink of ``start_mediation``
    (``source_path``), or from a message stream of serialised records
    (``messages``, e.g. the valid topic read with ``startingOffsets=earliest``)."""
    if messages is not None:
        stream = mediation.parse_normalized_messages(messages)
    else:
        stream = spark.readStream.schema(NORMALIZED).parquet(source_path)
    return (stream.writeStream.foreachBatch(store_batch(table_path, checkpoint))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def mediate_and_store_batch(normalized_path: str, dead_path: str, rules: Rules = DEFAULT_RULES,
                            writer: str | None = None):
    """``foreachBatch`` callback of the single-read mode: parse and validate the
    micro-batch once, then

    * dead letters -> overwrite of the partition ``batch_id`` (a replayed
      batch rewrites its own partition: exactly once);
    * valid records -> a batch of the normalised store, partitioned by month
      (duplicates within the batch and against the store are dropped, whatever
      their event times).
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mediated = mediation.mediate(mediation.parse_messages(batch), rules).persist()
        try:
            dead = mediation.dead_letters(mediated).withColumn("batch_id", F.lit(batch_id))
            writers.overwrite_partitions(dead, dead_path, "batch_id")
            valid = mediation.valid_records(mediated).drop("status")
            keyed = valid.withColumn("status", F.lit("valid")).withColumn("billing_month", month_start("timestamp"))
            ledger.append_new(spark, keyed, normalized_path, "record_id", "billing_month", writer, batch_id)
        finally:
            mediated.unpersist()
    return write


def start_mediation_store(messages: DataFrame, *, normalized_path: str, dead_path: str, checkpoint: str,
                          trigger: dict | None = None, rules: Rules = DEFAULT_RULES) -> StreamingQuery:
    """Single-read mediation: one query reads the source once and writes both
    outputs from ``foreachBatch``. De-duplication is against the stored table,
    so no streaming state is kept and late records are never dropped. Within a
    batch the survivor is the smallest copy (as in batch de-duplication);
    across batches the first stored copy stays."""
    return (messages.writeStream.foreachBatch(mediate_and_store_batch(normalized_path, dead_path, rules, checkpoint))
            .queryName("mediation_store").option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start())


def run_until_any_stops(spark: SparkSession) -> None:
    """Block until one of the session's streaming queries stops (or fails)."""
    spark.streams.awaitAnyTermination()


def await_all(queries: list[StreamingQuery], timeout_s: int | None = None) -> None:
    """Wait for all queries; with a timeout, a query still running by then is an error."""
    for q in queries:
        if timeout_s is None:
            q.awaitTermination()
        elif not q.awaitTermination(timeout_s):
            raise TimeoutError(f"streaming query {q.name or q.id} did not end within {timeout_s} s")
        if q.exception() is not None:
            raise q.exception()


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped by the watermark across the query's recent progress (``monitor.ProgressLog`` keeps all of it)."""
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else p.stateOperators:
            total += (op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict)
                      else op.numRowsDroppedByWatermark)
    return total
