"""Snapshot tables, the id ledger next to them, and rating by new batches."""

import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from chargeline.operators import rating
from chargeline.plans import flows, jobs
from chargeline.schemas import NORMALIZED
from chargeline.session import scratch_path
from chargeline.sinks import ledger, snapshots
from chargeline.sinks.ledger import IdLedger
from chargeline.sinks.snapshots import ConcurrentCommit, SnapshotTable, read_table
from chargeline.sources import fixtures
from chargeline.streaming import mediation_stream as ms


def rows(spark, ids, month="2024-01-01"):
    return spark.createDataFrame([(str(i),) for i in ids], "record_id string").withColumn(
        "billing_month", F.lit(month).cast("date"))


def ids_of(df):
    return sorted(int(r.record_id) for r in df.collect())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_buckets(df):
    """Buckets of the files that a scan opens, which its partition filter has to name."""
    found = df.select(F.input_file_name().alias("f")).distinct().collect()
    buckets = {int(r.f.split("bucket=")[1].split("/")[0]) for r in found}
    assert pruned_to(plan(df)) == buckets
    return buckets


def pruned_to(text):
    """The buckets in a scan's PartitionFilters."""
    one = re.findall(r"PartitionFilters: \[[^\]]*?bucket#\d+ (?:IN \(([\d,]+)\)|= (\d+))", text)
    return {int(b) for a, c in one[:1] for b in (a or c).split(",")}


def test_a_reader_sees_whole_batches_only(spark, monkeypatch):
    table = SnapshotTable(spark, scratch_path(spark, "snap"))
    assert table.read() is None and read_table(spark, table.root) is None
    table.append(rows(spark, range(5)), "billing_month")
    before = table.read()

    def fails(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:  # the job dies after its files were written
        m.setattr(table, "publish", fails)
        with pytest.raises(RuntimeError):
            table.append(rows(spark, range(5, 9)), "billing_month")
    assert len([d for d in os.listdir(table.root) if d.startswith("batch=")]) == 2
    assert ids_of(before) == ids_of(table.read()) == list(range(5))
    table.append(rows(spark, range(5, 9)), "billing_month")  # and runs again
    assert ids_of(table.read()) == list(range(9)) and ids_of(table.read(table.snapshot(1))) == list(range(5))
    bad = spark.range(3).select(F.raise_error(F.lit("task lost")).cast("string").alias("record_id"),
                                F.lit("2024-01-01").cast("date").alias("billing_month"))
    with pytest.raises(Exception, match="task lost"):
        table.append(bad, "billing_month")
    assert ids_of(read_table(spark, table.root)) == list(range(9))


def test_second_writer_and_unfinished_manifest(spark):
    table = SnapshotTable(spark, scratch_path(spark, "snap"))
    base = table.snapshot()
    table.append(rows(spark, [1]), "billing_month")
    with pytest.raises(ConcurrentCommit):
        table.publish(base, next_batch=7)
    with open(f"{table.root}/{snapshots.MANIFESTS}/00000002.json", "w") as f:
        f.write('{"version": 2, "par')  # being written
    assert table.snapshot().version == 1 and ids_of(table.read()) == [1]
    plain = scratch_path(spark, "plain")
    rows(spark, [1]).write.parquet(plain)
    assert ids_of(read_table(spark, plain)) == [1]
    with pytest.raises(ValueError, match="no manifest"):
        SnapshotTable(spark, plain).append(rows(spark, [2]), "billing_month")


def test_replayed_batches_of_a_writer_write_nothing(spark):
    table = SnapshotTable(spark, scratch_path(spark, "snap"))
    for batch_id in (0, 1, 1, 0):
        table.append(rows(spark, [batch_id]), "billing_month", writer="stream", batch_id=batch_id)
    table.append(rows(spark, [9]), "billing_month", writer="other", batch_id=0)
    assert ids_of(table.read()) == [0, 1, 9] and table.snapshot().version == 3
    table.append(rows(spark, []), "billing_month", writer="stream", batch_id=2)  # an empty batch is a commit too
    assert ids_of(table.read()) == [0, 1, 9] and table.read(after=2) is None


def test_compaction_and_vacuum(spark):
    table = SnapshotTable(spark, scratch_path(spark, "snap"))
    book = IdLedger(table, "record_id", buckets=4, words=64)
    for i in range(6):
        month = f"2024-0{1 + i % 2}-01"
        table.append(rows(spark, range(10 * i, 10 * i + 10), month), "billing_month", also=book.write)
    reader, was = table.read(), table.snapshot()
    new = book.compact("billing_month", boundaries=[2])
    assert [(p.first, p.last) for p in new.parts] == [(0, 2), (3, 5)]
    assert ids_of(reader) == ids_of(table.read()) == ids_of(table.read(was)) == list(range(60))
    assert ids_of(table.read(after=2)) == list(range(30, 60))
    with pytest.raises(ValueError, match="compacted across"):
        table.read(after=4)
    assert sorted(int(r[0]) for r in book.ids(new, [0, 1, 2, 3]).select("record_id").collect()) == list(range(60))
    assert ids_of(book.new_only(rows(spark, range(55, 70)), new)) == list(range(60, 70))
    assert len(table.vacuum(keep_versions=2, sides=[s for s, _ in ledger.SIDES])) == 0
    gone = table.vacuum(keep_versions=1, sides=[s for s, _ in ledger.SIDES])
    assert sorted(gone) == sorted(p.name for p in was.parts)
    assert sorted(d for d in os.listdir(table.root) if d.startswith("batch=")) == sorted(p.name for p in new.parts)
    assert ids_of(table.read()) == list(range(60)) and table.snapshot() == new
    assert book.compact("billing_month", target_bytes=1).version == new.version  # nothing small enough to join


def test_a_batch_reads_only_its_buckets(spark):
    table = SnapshotTable(spark, scratch_path(spark, "snap"))
    book = IdLedger(table, "record_id", buckets=32)
    for i in range(2):
        table.append(rows(spark, range(2000 * i, 2000 * i + 2000)), "billing_month", also=book.write)
    now = table.snapshot()
    batch = rows(spark, [7, 3001, 100_000, 100_001])
    touched = book._touched(batch)
    assert 1 < len(touched) <= 4
    text = plan(book.maybe_known(batch, now))
    assert "PartitionFilters" in text and "_ledger/blooms" in text
    assert read_buckets(book._side(ledger.BLOOMS, now, touched)) == set(touched)
    maybe = ids_of(book.maybe_known(batch, now))
    assert {7, 3001} <= set(maybe)
    fresh = book.new_only(batch, now)
    assert ids_of(fresh) == [100_000, 100_001]
    assert pruned_to(plan(fresh)) == set(book._touched(rows(spark, maybe)))
    # new ids alone: hardly an id file is opened
    many = rows(spark, range(10_000, 10_200))
    assert book.maybe_known(many, now).count() < 10
    assert ids_of(book.new_only(many, now)) == list(range(10_000, 10_200))
    assert "_ledger/ids" not in plan(book.new_only(rows(spark, [100_000]), now))


def test_second_rating_run_scans_new_batches_only(spark):
    tables = jobs.TablePaths(scratch_path(spark, "incremental"))
    valid = flows.valid_usage(spark, SF_SMALL).select(*NORMALIZED.fieldNames())
    half = F.pmod(F.xxhash64("record_id"), F.lit(2)) == 0
    cust, plans = fixtures.customers(spark, SF_SMALL), fixtures.rate_plans(spark)
    write = ms.store_batch(tables.normalized, "s")
    write(valid.where(half), 0)
    one = jobs.run_rating_incremental(spark, cust, plans, tables)
    write(valid, 1)  # the first half again, and the second
    first, second = SnapshotTable(spark, tables.normalized).snapshot().parts
    assert jobs.unrated_paths(spark, tables) == [f"{tables.normalized}/{second.name}"]
    fresh = SnapshotTable(spark, tables.normalized).read(after=0)
    assert all(second.name in f and first.name not in f for f in fresh.inputFiles())
    two = jobs.run_rating_incremental(spark, cust, plans, tables)
    assert (one["batches"], two["batches"]) == (1, 1)
    assert jobs.run_rating_incremental(spark, cust, plans, tables)["written"] == 0
    rated = read_table(spark, tables.rated)
    assert one["written"] + two["written"] == rated.count() == rated.select("record_id").distinct().count()
    assert rated.count() == valid.select("record_id").distinct().count()
    # compacting the store leaves what is unrated apart
    write(valid.limit(5).withColumn("record_id", F.concat(F.lit("n"), "record_id")), 2)
    out = jobs.run_compaction(spark, tables)
    assert out["normalized_records"] == {"parts_before": 3, "parts": 2, "removed": 0}
    assert jobs.run_rating_incremental(spark, cust, plans, tables)["written"] == 5
    assert read_table(spark, tables.rated).count() == rated.count() + 5


def test_incremental_rating_after_a_full_run(spark):
    """A rated table that was filled from elsewhere is compared once, then batches alone decide."""
    tables = jobs.TablePaths(scratch_path(spark, "incremental"))
    valid = flows.valid_usage(spark, SF_SMALL).select(*NORMALIZED.fieldNames())
    cust, plans = fixtures.customers(spark, SF_SMALL), fixtures.rate_plans(spark)
    jobs.run_rating(spark, valid.limit(50), cust, plans, tables)
    ms.store_batch(tables.normalized)(valid, 0)
    jobs.run_rating_incremental(spark, cust, plans, tables)
    rated = read_table(spark, tables.rated).select(*rating.RATED_COLUMNS)
    assert rated.count() == rated.select("record_id").distinct().count() == valid.select("record_id").distinct().count()


def test_deliveries_mediate_each_row_once(spark, monkeypatch):
    """However many deliveries the month comes in, its rows are computed once."""
    from chargeline.plans import queries

    seen = spark.sparkContext.accumulator(0)

    def look(s):
        seen.add(1)
        return s
    usage = flows.valid_usage(spark, SF_SMALL)
    monkeypatch.setattr(queries.flows, "valid_usage", lambda *a, **k: usage.withColumn("status", F.udf(look)("status")))
    got = queries.REGISTRY["store_compacted"](spark, SF_SMALL)
    assert seen.value == usage.count()
    assert sorted(map(str, got.collect())) == sorted(map(str, usage.dropDuplicates(["record_id"]).select(*got.columns).collect()))
