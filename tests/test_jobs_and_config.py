"""Batch jobs end to end, config loading and stream monitoring."""

import os

from conftest import SF_SMALL
from chargeline.plans import flows, jobs
from chargeline.rules import DEFAULT_RULES, rules_from_config
from chargeline.session import scratch_path, size_shuffle_partitions
from chargeline.sources.fixtures import rate_plans
from chargeline.sources.tables import table_path


def test_run_period_writes_tables_and_reports(spark):
    tables = jobs.TablePaths(scratch_path(spark, "period"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    counts = jobs.run_period(spark, flows.valid_usage(spark, SF_SMALL), flows.customers(spark, SF_SMALL),
                             rate_plans(spark), tables, input_paths=[table_path(SF_SMALL, "events")])
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert counts["rating"]["written"] == sum(counts["rating"][k] for k in ("rated", "rejected", "unmatched"))
    assert counts["billing"]["invoices"] > 0
    for path in counts["reports"]:
        assert any(f.endswith(".csv") for f in os.listdir(path))
    # a second cycle adds no rated record and keeps one invoice per subscriber
    again = jobs.run_period(spark, flows.valid_usage(spark, SF_SMALL), flows.customers(spark, SF_SMALL),
                            rate_plans(spark), tables)
    assert again["rating"]["written"] == 0
    inv = spark.read.parquet(tables.invoices)
    assert inv.count() == inv.select("invoice_id").distinct().count() == counts["billing"]["invoices"]


def test_shuffle_partitions_follow_input_size(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    n = size_shuffle_partitions(spark, [table_path(SF_SMALL, "events")], target_bytes=1 << 10)
    assert n > 8 and spark.conf.get("spark.sql.shuffle.partitions") == str(n)
    spark.conf.set("spark.sql.shuffle.partitions", old)


def test_rules_from_config():
    cfg = {"billing": {"taxes": {"vat_rate": 0.18}, "seasonal_discounts": {"ramadan_month": 4},
                       "discounts": {"urban_discount_rate": 0.5}}}
    r = rules_from_config(cfg)
    assert (r.vat_rate, r.seasonal_month) == (0.18, 4)
    assert r.urban_discount_rate == DEFAULT_RULES.urban_discount_rate
    assert r.regulatory_fee == DEFAULT_RULES.regulatory_fee


def test_progress_counter_sees_batches(spark):
    from chargeline.streaming.monitor import ProgressCounter
    from chargeline.streaming import mediation_stream as ms
    import json

    base = scratch_path(spark, "monitor")
    os.makedirs(f"{base}/inbox")
    with open(f"{base}/inbox/a.json", "w") as fh:
        fh.write(json.dumps({"record_id": "m1", "record_type": "sms", "timestamp": "2024-01-10 10:00:00",
                             "sender_id": "+212000000001"}) + "\n")
    listener = ProgressCounter()
    spark.streams.addListener(listener)
    try:
        ms.await_all(ms.start_mediation(ms.usage_source(spark, "text", path=f"{base}/inbox"),
                                        checkpoint_root=f"{base}/ckpt", valid_path=f"{base}/v",
                                        dead_path=f"{base}/d"))
        import time
        for _ in range(50):
            if listener.totals.get("mediation_valid", {}).get("input_rows"):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert listener.totals["mediation_valid"]["input_rows"] == 1


def test_rules_reject_inconsistent_values():
    import datetime as dt
    from dataclasses import replace

    import pytest

    with pytest.raises(ValueError):
        replace(DEFAULT_RULES, period_end=dt.datetime(2023, 12, 1))
    with pytest.raises(ValueError):
        replace(DEFAULT_RULES, vat_rate=20.0)
    with pytest.raises(ValueError):
        rules_from_config({"billing": {"seasonal_discounts": {"ramadan_month": 13}}})
