"""De-duplication with bounded state that loses no late record, and counters that outlive a query."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from chargeline.operators import mediation
from chargeline.plans import flows
from chargeline.schemas import NORMALIZED
from chargeline.session import scratch_path
from chargeline.sources import fixtures
from chargeline.streaming import bounded_dedup, mediation_stream as ms, monitor


def send(df, inbox):
    mediation.to_messages(df).coalesce(1).write.mode("append").text(inbox)


def run(spark, base, delay="2 days"):
    split = bounded_dedup.start_split(ms.usage_source(spark, "text", path=f"{base}/inbox", max_per_trigger=1), f"{base}/out", delay)
    ms.await_all([split])
    dedup = bounded_dedup.start_dedup(spark, f"{base}/out", delay)
    ms.await_all([dedup])
    return split, dedup


def expected(spark):
    return flows.valid_usage(spark, SF_SMALL).select(*NORMALIZED.fieldNames()).dropDuplicates(["record_id"])


def same(a, b):
    key = lambda df: sorted(map(str, df.select(*NORMALIZED.fieldNames()).collect()))
    return key(a) == key(b)


def test_state_is_bounded_and_nothing_is_lost(spark):
    """Three days a run, every message twice; then the first ten days come again, and some for the first time."""
    base = scratch_path(spark, "bounded")
    raw = fixtures.raw_usage(spark, SF_SMALL)
    day = F.substring("timestamp", 1, 10)
    days = sorted(r[0] for r in raw.select(day).where(day.isNotNull()).distinct().collect())
    held_back = F.coalesce(day < days[10], F.lit(True)) & (F.pmod(F.xxhash64("record_id"), F.lit(2)) == 0)
    state = []
    for i in range(0, len(days), 3):
        some = raw.where(~held_back & day.isin(days[i:i + 3]))
        send(some.unionByName(some), f"{base}/inbox")
        _, dedup = run(spark, base)
        assert ms.late_rows(dedup) == 0
        state += [p["stateOperators"][0]["numRowsTotal"] for p in dedup.recentProgress if p["stateOperators"]]
    ids = expected(spark).count()
    assert max(state) < ids * 0.4 and state[-1] < ids * 0.3
    send(raw.where(F.coalesce(day < days[10], F.lit(True))), f"{base}/inbox")
    _, dedup = run(spark, base)
    assert ms.late_rows(dedup) == 0
    late = spark.read.parquet(f"{base}/out/late")
    assert late.count() > 0
    assert bounded_dedup.unique_records(spark, f"{base}/out").count() < ids
    assert bounded_dedup.reconcile_late(spark, f"{base}/out") > 0
    assert same(bounded_dedup.unique_records(spark, f"{base}/out"), expected(spark))
    assert bounded_dedup.reconcile_late(spark, f"{base}/out") == 0
    send(raw, f"{base}/inbox")  # the whole month once more
    run(spark, base)
    bounded_dedup.reconcile_late(spark, f"{base}/out")
    assert same(bounded_dedup.unique_records(spark, f"{base}/out"), expected(spark))


def test_a_replayed_batch_is_cut_at_the_same_line(spark):
    base = scratch_path(spark, "replay")
    valid = flows.mediated(spark, SF_SMALL)
    write = bounded_dedup.split_batch(base, "1 day")
    write(valid.where("timestamp >= '2024-01-20'"), 0)
    count = lambda t: {r.batch_id: r["count"] for r in spark.read.parquet(f"{base}/{t}").groupBy("batch_id").count().collect()}
    for _ in range(3):
        write(valid, 1)
        assert set(count("on_time")) == {0, 1} and count("late")[1] > 0
        got = (count("on_time"), count("late"))
        assert got[0][1] + got[1][1] == mediation.valid_records(valid).count()
    bounded_dedup.split_batch(base, "400 days")(valid.limit(0), 2)  # an empty batch
    assert got == (count("on_time"), count("late"))


def test_counters_over_more_batches_than_a_query_remembers(spark):
    """The query's own history holds 100 batches at most; the log holds all, over restarts."""
    base = scratch_path(spark, "progress")
    inbox = f"{base}/inbox"
    raw = fixtures.raw_usage(spark, SF_SMALL).where("timestamp is not null")
    one = raw.limit(115).repartition(115)  # a file each
    mediation.to_messages(one).write.text(inbox)
    log = monitor.ProgressLog(spark, f"{base}/log")
    spark.streams.addListener(log)
    try:
        for turn in range(2):
            q = (ms.usage_source(spark, "text", path=inbox, max_per_trigger=1).writeStream.format("noop").queryName("many")
                 .option("checkpointLocation", f"{base}/ck").trigger(availableNow=True).start())
            ms.await_all([q])
            if turn == 0:
                assert len(q.recentProgress) <= 100
                files = spark.read.text(inbox).count()
                mediation.to_messages(raw.limit(3)).coalesce(1).write.mode("append").text(inbox)
        monitor.drain(spark)
    finally:
        spark.streams.removeListener(log)
    total = monitor.progress_totals(spark, f"{base}/log").collect()
    assert [(r.query_name, r.input_rows, r.late_rows) for r in total] == [("many", files + 3, 0)]
    assert total[0].batches > 100
    assert monitor.progress_rows(spark, f"{base}/log").select("batch_id").distinct().count() == total[0].batches


def test_late_rows_are_totalled(spark):
    """With a watermark alone rows are dropped; the log says how many."""
    from dataclasses import replace

    from chargeline.rules import DEFAULT_RULES

    base = scratch_path(spark, "late")
    raw = fixtures.raw_usage(spark, SF_SMALL)
    log = monitor.ProgressLog(spark, f"{base}/log")
    spark.streams.addListener(log)
    try:
        for part in ("timestamp >= '2024-01-25'", "timestamp < '2024-01-02'", "timestamp < '2024-01-03'"):
            send(raw.where(part), f"{base}/inbox")
            source = ms.usage_source(spark, "text", path=f"{base}/inbox")
            ms.await_all(ms.start_mediation(source, checkpoint_root=f"{base}/ck", valid_path=f"{base}/valid",
                                            dead_path=f"{base}/dead", rules=replace(DEFAULT_RULES, dedup_watermark="1 day")))
        monitor.drain(spark)
    finally:
        spark.streams.removeListener(log)
    dropped = {r.query_name: r.late_rows for r in monitor.progress_totals(spark, f"{base}/log").collect()}
    valid = flows.valid_usage(spark, SF_SMALL)
    assert dropped["mediation_valid"] == sum(valid.where(p).count() for p in ("timestamp < '2024-01-02'", "timestamp < '2024-01-03'"))
    assert dropped["mediation_dead"] == 0


def test_a_batch_is_split_by_all_tasks(spark):
    """Each task writes its own rows of a batch: none waits for a shuffle into a few."""
    base = scratch_path(spark, "bounded-tasks")
    messages = mediation.to_messages(fixtures.raw_usage(spark, SF_SMALL).repartition(6))
    write = bounded_dedup.split_batch(f"{base}/out", "2 days")
    for batch_id in range(2):
        write(mediation.mediate(mediation.parse_messages(messages)), batch_id)
    split = spark.read.parquet(f"{base}/out/on_time").unionByName(spark.read.parquet(f"{base}/out/late"))
    files = split.select("batch_id", F.input_file_name().alias("f")).where(F.col("f").contains("/late/")).distinct()
    assert files.where("batch_id = 1").count() == 6
    valid = expected(spark).count()
    assert [r["count"] for r in split.groupBy("batch_id").count().orderBy("batch_id").collect()] == [valid, valid]
