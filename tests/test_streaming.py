"""Streaming mediation over text files with hand-written messages."""

import json
import os

from chargeline.schemas import NORMALIZED
from chargeline.session import scratch_path
from chargeline.streaming import mediation_stream as ms


def msg(rid, ts="2024-01-10 10:00:00", **kw):
    d = {"record_id": rid, "record_type": "voice", "timestamp": ts, "caller_id": "+212000000001",
         "callee_id": "+212000000002", "duration_sec": 120, "cell_id": "RABAT", "technology": "4G"}
    d.update(kw)
    return json.dumps({k: v for k, v in d.items() if v is not None})


def write_lines(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def run(spark, base, inbox):
    source = ms.usage_source(spark, "text", path=inbox)
    queries = ms.start_mediation(source, checkpoint_root=f"{base}/ckpt",
                                 valid_path=f"{base}/valid", dead_path=f"{base}/dead")
    ms.await_all(queries)
    return queries


def test_stream_routes_dedups_and_keeps_late_rows(spark):
    base = scratch_path(spark, "stream-test")
    inbox = f"{base}/inbox"
    write_lines(inbox, "a.json", [
        msg("r1"),
        msg("r1"),                                      # duplicate inside one file
        msg("r2", ts="2024-01-10 12:00:00"),
        "this is not json",                             # malformed -> dead letter
        msg(None),                                      # NULL record_id -> dead letter
        msg("r3", ts="10/01/2024 10:00"),               # unparsable time -> valid, NULL time
        msg("r4", duration_sec=-5),                     # negative duration -> dead letter
        msg("r5", record_type="fax"),                   # unknown type -> dead letter
        msg("r6", duration_sec="12.5"),                 # wrong type -> NULL duration, still valid
    ])
    run(spark, base, inbox)
    write_lines(inbox, "b.json", [
        msg("r2", ts="2024-01-10 12:00:00"),            # duplicate across files/restarts
        msg("r7", ts="2024-01-10 08:00:00"),            # hours late -> kept
        msg("r8", ts="2024-01-10 11:30:00"),
    ])
    queries = run(spark, base, inbox)

    valid = {r.record_id: r for r in spark.read.schema(NORMALIZED).parquet(f"{base}/valid").collect()}
    assert set(valid) == {"r1", "r2", "r3", "r6", "r7", "r8"}
    assert valid["r3"].timestamp is None
    assert valid["r6"].duration_sec is None
    dead = spark.read.schema(NORMALIZED).parquet(f"{base}/dead").collect()
    assert sorted(str(r.record_id) for r in dead) == ["None", "None", "r4", "r5"]
    assert ms.late_rows(queries[0]) == 0


def test_normalized_store_is_idempotent(spark):
    base = scratch_path(spark, "store-test")
    inbox = f"{base}/inbox"
    write_lines(inbox, "a.json", [msg(f"s{i}", ts=f"2024-01-{10 + i % 3:02d} 10:00:00") for i in range(20)])
    run(spark, base, inbox)
    table = f"{base}/normalized_records"
    for replay in range(3):
        ms.start_normalized_store(spark, f"{base}/valid", table, f"{base}/store-{replay}").awaitTermination(300)
    stored = spark.read.parquet(table)
    assert stored.count() == 20
    assert stored.select("record_id").distinct().count() == 20
    assert {r.billing_month.isoformat() for r in stored.select("billing_month").distinct().collect()} \
        == {"2024-01-01"}


def test_console_debug_query_runs_alongside(spark, capsys):
    base = scratch_path(spark, "console-test")
    inbox = f"{base}/inbox"
    write_lines(inbox, "a.json", [msg("c1"), "junk"])
    source = ms.usage_source(spark, "text", path=inbox)
    queries = ms.start_mediation(source, checkpoint_root=f"{base}/ckpt", valid_path=f"{base}/valid",
                                 dead_path=f"{base}/dead", console_trigger={"availableNow": True})
    ms.await_all(queries)
    assert [q.name for q in queries] == ["mediation_console", "mediation_valid", "mediation_dead"]


def test_many_batch_stream_equals_batch_result(spark):
    """One file per day, one file per micro-batch: with no row later than the
    watermark, the streamed valid records equal the batch de-duplication."""
    from pyspark.sql import functions as F

    from conftest import SF_SMALL
    from chargeline.operators import mediation
    from chargeline.plans import flows
    from chargeline.sources import fixtures

    base = scratch_path(spark, "many-batch")
    inbox = f"{base}/inbox"
    raw = fixtures.raw_usage(spark, SF_SMALL)
    days = [r.d for r in raw.select(F.substring("timestamp", 1, 10).alias("d")).distinct().orderBy("d").collect()]
    for d in days:  # written one after another, so file times follow the days
        mediation.to_messages(raw.filter(F.substring("timestamp", 1, 10) == d)).coalesce(1) \
            .write.mode("append").text(inbox)
    source = ms.usage_source(spark, "text", path=inbox, max_per_trigger=1)
    queries = ms.start_mediation(source, checkpoint_root=f"{base}/ckpt", valid_path=f"{base}/valid",
                                 dead_path=f"{base}/dead")
    ms.await_all(queries)
    assert len(queries[0].recentProgress) >= min(len(days), 10)
    streamed = spark.read.schema(NORMALIZED).parquet(f"{base}/valid")
    batch = mediation.dedupe_records(flows.valid_usage(spark, SF_SMALL))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    assert ms.late_rows(queries[0]) == 0


def test_serialize_round_trip_with_key(spark):
    from conftest import SF_SMALL
    from chargeline.operators import mediation
    from chargeline.plans import flows

    valid = mediation.dedupe_records(flows.valid_usage(spark, SF_SMALL))
    msgs = mediation.serialize(valid, key="record_id")
    assert msgs.columns == ["key", "value"]
    back = mediation.parse_messages(msgs.select("value"))
    assert back.count() == valid.count()
    assert msgs.filter("key IS NULL").count() == 0


def test_single_read_mode_stores_each_record_once(spark):
    from conftest import SF_SMALL
    from chargeline.operators import mediation
    from chargeline.plans import flows
    from chargeline.sources import fixtures

    base = scratch_path(spark, "single-read")
    inbox = f"{base}/inbox"
    messages = mediation.to_messages(fixtures.raw_usage(spark, SF_SMALL))
    for delivery in range(2):  # the whole stream delivered twice, with a restart between
        messages.write.mode("append").text(inbox)
        ms.start_mediation_store(ms.usage_source(spark, "text", path=inbox),
                                 normalized_path=f"{base}/normalized", dead_path=f"{base}/dead",
                                 checkpoint=f"{base}/ckpt").awaitTermination(300)
    stored = spark.read.parquet(f"{base}/normalized").select(*NORMALIZED.fieldNames())
    batch = mediation.dedupe_records(flows.valid_usage(spark, SF_SMALL))
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, batch.collect()))
    dead = spark.read.parquet(f"{base}/dead")
    assert dead.count() == 2 * mediation.dead_letters(flows.mediated(spark, SF_SMALL)).count()


def test_store_consumes_a_message_stream(spark):
    from conftest import SF_SMALL
    from chargeline.operators import mediation
    from chargeline.plans import flows

    base = scratch_path(spark, "store-messages")
    valid = mediation.dedupe_records(flows.valid_usage(spark, SF_SMALL))
    mediation.serialize(valid).write.text(f"{base}/topic")
    source = ms.usage_source(spark, "text", path=f"{base}/topic")
    ms.start_normalized_store(spark, None, f"{base}/table", f"{base}/ckpt",
                              messages=source).awaitTermination(300)
    stored = spark.read.parquet(f"{base}/table").select(*NORMALIZED.fieldNames())
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, valid.collect()))
