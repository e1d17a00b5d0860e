"""Plan assertions: the physical plans have the intended shape (read from
``explain()`` output)."""

import contextlib
import io

import pytest

from conftest import SF_SMALL
from chargeline.plans.queries import REGISTRY

SIDE_EFFECTING = ("stream_", "report_csv", "usage_archive", "rating_job", "rating_rerun", "billing_job")


def explain(df, mode="extended") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(n for n in REGISTRY if not n.startswith(SIDE_EFFECTING)))
def test_no_python_udf_and_no_cartesian(spark, name):
    text = explain(REGISTRY[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, f"{name}: {node}"


def test_rate_plan_dimension_is_broadcast(spark):
    text = explain(REGISTRY["rated_records"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in text
    assert "ExistingRDD" not in text


def test_scan_reads_only_needed_columns(spark):
    text = explain(REGISTRY["rated_records"](spark, SF_SMALL), "formatted")
    # events has six columns; value and props are never read
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>" in text


def test_billing_prunes_months_and_pushes_filters_into_the_rated_scan(spark):
    from chargeline.operators import billing
    from chargeline.plans import flows, jobs
    from chargeline.session import scratch_path
    from chargeline.sources.fixtures import rate_plans

    tables = jobs.TablePaths(scratch_path(spark, "plan-tables"))
    cust = flows.customers(spark, SF_SMALL)
    jobs.run_rating(spark, flows.valid_usage(spark, SF_SMALL), cust, rate_plans(spark), tables)
    totals = billing.usage_totals(spark.read.parquet(tables.rated))
    text = explain(totals, "formatted")
    scan = text.split("(1) Scan parquet")[1].split("(2)")[0]
    assert "PartitionFilters: [isnotnull(billing_month" in scan
    assert "EqualTo(rating_status,rated)" in scan
    assert "GreaterThanOrEqual(timestamp" in scan


def test_dedup_is_partially_aggregated(spark):
    text = explain(REGISTRY["mediate_valid_dedup"](spark, SF_SMALL), "formatted")
    assert "partial_min" in text


def test_incremental_rating_reads_only_record_ids_of_the_history(spark):
    from chargeline.operators import rating
    from chargeline.plans import flows, jobs
    from chargeline.session import scratch_path
    from chargeline.sources.fixtures import rate_plans

    tables = jobs.TablePaths(scratch_path(spark, "history-tables"))
    cust, plans = flows.customers(spark, SF_SMALL), rate_plans(spark)
    jobs.run_rating(spark, flows.valid_usage(spark, SF_SMALL), cust, plans, tables)
    out = rating.rate(flows.valid_usage(spark, SF_SMALL), cust, plans,
                      already_rated=spark.read.parquet(tables.rated))
    text = explain(out, "formatted")
    import re
    scan = next(p for p in re.split(r"\n\n+", text) if "Scan parquet" in p and tables.rated in p)
    assert re.search(r"ReadSchema: struct<record_id:string>", scan)
    assert len(re.findall(r"^\(\d+\) SortAggregate", text, re.M)) == 2


def test_bucketed_customers_are_not_shuffled(spark):
    import re

    from chargeline.operators import billing, rating
    from chargeline.plans import flows, jobs
    from chargeline.session import scratch_path
    from chargeline.sources.fixtures import rate_plans

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        cust = jobs.publish_customers(spark, flows.customers(spark, SF_SMALL), "customers_bucketed", 8,
                                      scratch_path(spark, "customers-bucketed"))
        rated = rating.rate(flows.valid_usage(spark, SF_SMALL), cust, rate_plans(spark))
        for df in (rated, billing.breakdown(rated, cust, rate_plans(spark))):
            text = explain(df, "simple")
            assert "Bucketed: true" in text
            # only the usage side shuffles: de-duplication by record_id, then
            # usage by msisdn; the billing aggregate and both customer joins
            # reuse that msisdn partitioning
            shuffles = re.findall(r"Exchange hashpartitioning\((\w+)#", text)
            assert sorted(shuffles) == ["msisdn", "record_id"], shuffles
        assert rated.count() > 0
    finally:
        spark.sql("DROP TABLE IF EXISTS customers_bucketed")
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_partitioned_writes_rebalance_instead_of_one_task_per_month(spark):
    from chargeline.sinks import writers

    from conftest import SF_MID

    rated = REGISTRY["rated_records"](spark, SF_MID)
    text = explain(writers._balanced(rated, "billing_month"))
    assert "REBALANCE_PARTITIONS_BY_COL" in text
    # all usage falls in one month; it must still be written by several tasks.
    # (At test size AQE would first merge the upstream shuffle into one map
    # task, and a split can only cut between map outputs.)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16KB")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        from chargeline.session import scratch_path
        path = scratch_path(spark, "rebalanced")
        writers.append_partitioned(rated, path, "billing_month")
        import os
        month_dir = [d for d in os.listdir(path) if d.startswith("billing_month=")]
        assert len(month_dir) == 1
        files = [f for f in os.listdir(os.path.join(path, month_dir[0])) if f.endswith(".parquet")]
        assert len(files) > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_store_to_invoices_shuffles_usage_once(spark):
    """Rating the (unique) normalised store against bucketed customers and
    billing the result: a single hash shuffle, usage by msisdn."""
    import re

    from chargeline.operators import billing, mediation, rating
    from chargeline.plans import flows, jobs
    from chargeline.session import scratch_path
    from chargeline.sources.fixtures import rate_plans

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        cust = jobs.publish_customers(spark, flows.customers(spark, SF_SMALL), "customers_bucketed_once", 8,
                                      scratch_path(spark, "customers-bucketed-once"))
        store = scratch_path(spark, "store-once")
        mediation.dedupe_records(flows.valid_usage(spark, SF_SMALL)).write.parquet(store)
        rated = rating.rate(spark.read.parquet(store), cust, rate_plans(spark), input_unique=True)
        invoices = billing.bill(rated, cust, rate_plans(spark))
        shuffles = re.findall(r"Exchange hashpartitioning\((\w+)#", explain(invoices, "simple"))
        assert shuffles == ["msisdn"], shuffles
        assert invoices.count() > 0
    finally:
        spark.sql("DROP TABLE IF EXISTS customers_bucketed_once")
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_a_filter_on_the_status_evaluates_nothing_again(spark):
    from pyspark.sql import functions as F

    from chargeline.operators import mediation
    from chargeline.sources import fixtures

    def mentions(df, text):
        return explain(df).split("== Physical Plan ==")[1].count(text)

    sent = mediation.to_messages(fixtures.raw_usage(spark, SF_SMALL)).where(F.length("value") > 0)
    for part in (mediation.valid_records, mediation.dead_letters):
        parsed = mediation.parse_messages(sent)
        assert mentions(part(mediation.mediate(parsed)), "from_json(") == mentions(parsed, "from_json(") == 1
        raw = fixtures.raw_usage(spark, SF_SMALL)
        assert mentions(part(mediation.mediate(raw)), "lpad(") == mentions(raw, "lpad(")


def test_status_of_odd_rows(spark):
    """Text that is none, empty or no JSON, and records that fail one rule each, come out once with their status."""
    from chargeline.operators import mediation

    texts = {None: "error", "": "error", "no json": "error", "[]": "error",
             '{"record_id": "a", "record_type": "voice", "caller_id": "1", "duration_sec": 3}': "valid",
             '{"record_id": "b", "record_type": "voice", "caller_id": "1", "duration_sec": -3}': "error",
             '{"record_id": "c", "user_id": "1"}': "valid",
             '{"record_id": "d", "record_type": "fax", "user_id": "1"}': "error"}
    sent = spark.createDataFrame([(t,) for t in texts], "value string")
    out = mediation.mediate(mediation.parse_messages(sent))
    assert sorted(r.status for r in out.collect()) == sorted(texts.values())
    assert sorted(r.record_id for r in mediation.valid_records(out).collect()) == ["a", "c"]
    assert mediation.dead_letters(out).count() == 6
