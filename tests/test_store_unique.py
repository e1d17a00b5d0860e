"""The normalised store and the rated table hold each record id once."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from chargeline.operators import rating
from chargeline.plans import flows, jobs
from chargeline.rules import DEFAULT_RULES
from chargeline.sinks.snapshots import read_table
from chargeline.session import checkpoint_root, scratch_path
from chargeline.sources import fixtures
from chargeline.streaming import mediation_stream as ms


def test_null_time_and_cross_month_redelivery_are_stored_once(spark):
    table = scratch_path(spark, "store")
    records = flows.valid_usage(spark, SF_SMALL).limit(3).withColumn("status", F.lit("valid"))
    rows = records.withColumn("record_id", F.lit("x1")).limit(1)
    write = ms.store_batch(table)
    for i, ts in enumerate(("2024-01-31 23:59:00", "2024-02-01 00:01:00", None)):
        write(rows.withColumn("timestamp", F.lit(ts).cast("timestamp_ntz")), i)
    none = rows.withColumn("record_id", F.lit("x2")).withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    for i in range(2):
        write(none, 10 + i)
    assert sorted(r.record_id for r in read_table(spark, table).collect()) == ["x1", "x2"]


def test_a_record_without_time_is_rated_once_under_any_run_time(spark):
    tables = jobs.TablePaths(scratch_path(spark, "rate-null-time"))
    valid = flows.valid_usage(spark, SF_SMALL).withColumn("timestamp", F.lit(None).cast("timestamp_ntz"))
    cust, plans = fixtures.customers(spark, SF_SMALL), fixtures.rate_plans(spark)
    ids = valid.select("record_id").distinct().count()
    for day in (dt.datetime(2024, 1, 31), dt.datetime(2024, 2, 28)):
        jobs.run_rating(spark, valid, cust, plans, tables, replace(DEFAULT_RULES, as_of=day))
    rated = read_table(spark, tables.rated)
    assert rated.count() == ids == rated.select("record_id").distinct().count()


def test_building_a_rating_plan_starts_no_job(spark):
    valid = flows.valid_usage(spark, SF_SMALL)
    cust, plans = fixtures.customers(spark, SF_SMALL), fixtures.rate_plans(spark)
    sc = spark.sparkContext
    sc.setJobGroup("plan-only", "plan only")
    try:
        rating.rate(valid, cust, plans)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert not list(sc.statusTracker().getJobIdsForGroup("plan-only"))


def test_a_timeout_is_an_error():
    class Slow:
        name, id = "slow", 1

        def awaitTermination(self, s):
            return False

    with pytest.raises(TimeoutError):
        ms.await_all([Slow()], timeout_s=1)


def test_no_machine_local_checkpoint_off_local(spark):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError):
        checkpoint_root(Session())
