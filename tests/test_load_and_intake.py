"""Dimension loading, database table names, intake limits and single-read mediation from the command line."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from rows import customers, records
from chargeline import cli
from chargeline.operators import billing, customers as customer_ops, mediation, rating
from chargeline.plans import flows
from chargeline.rules import Rules
from chargeline.schemas import RATE_PLANS
from chargeline.session import scratch_path, sized_shuffles
from chargeline.sources import fixtures, jdbc


def test_repeated_dimension_rows_do_not_multiply_records_or_invoices(spark):
    cust = customer_ops.load(customers(spark, [{"customer_name": "B"}, {"customer_name": "A"},
                                               {"msisdn": "+212000000002", "status": None}]))
    plans = customer_ops.load_plans(spark.createDataFrame(
        [(1, "Standard Plan", "voice", 0.01, None, None, None)] * 2, RATE_PLANS))
    usage = records(spark, [{}, {"msisdn": "+212000000002"}])
    rated = rating.rate(usage, cust, plans)
    assert rated.groupBy("rating_status").count().collect() == [("rated", 2)]
    bd = billing.breakdown(rated, cust, plans).orderBy("msisdn").collect()
    assert [(r.customer_name, r.voice_free_minutes, r.voice_billable_minutes) for r in bd] == [
        ("A", 0, 1.0), ("Test Customer", 0, 1.0)]


def test_small_amounts_are_not_lost_in_sums(spark):
    rated = rating.project_rated(rating.price(rating.enrich(
        rating.with_event_time(records(spark, [{"duration_sec": 1.0}] * 1000)),
        customers(spark, [{}]), spark.createDataFrame(
            [(1, "Standard Plan", "voice", 4e-7, 0, None, None)], RATE_PLANS))))
    assert billing.usage_totals(rated).first().voice_cost_rated == pytest.approx(4e-4, abs=1e-12)


def test_jdbc_table_names(monkeypatch):
    seen = {}

    class Conf:
        def get(self, key, default=None):
            return {"spark.chargeline.jdbc.user": "u"}.get(key, default)

    class Session:
        class sparkContext:
            getConf = staticmethod(Conf)

    monkeypatch.setattr(jdbc, "read_jdbc", lambda spark, url, table, **kw: seen.update(url=url, table=table, **kw))
    jdbc.table_from_url(Session, "jdbc:postgresql://h/db#customers?id,1,900,8")
    assert seen == {"url": "jdbc:postgresql://h/db", "table": "customers", "user": "u", "password": None,
                    "driver": None, "partition_column": "id", "lower_bound": 1, "upper_bound": 900,
                    "num_partitions": 8}
    with pytest.raises(ValueError):
        jdbc.table_from_url(Session, "jdbc:postgresql://h/db")


def test_single_read_mediation_in_small_batches(spark):
    root = scratch_path(spark, "cli-store")
    mediation.to_messages(fixtures.raw_usage(spark, SF_SMALL)).repartition(3).write.text(f"{root}/inbox")
    for _ in range(2):
        cli.main(["stream-mediation", "--source", "text", "--path", f"{root}/inbox", "--tables", root,
                  "--sink", "store", "--max-per-trigger", "1"])
    stored = spark.read.parquet(f"{root}/normalized_records")
    assert stored.count() == flows.valid_usage(spark, SF_SMALL).select("record_id").distinct().count()
    dead = spark.read.parquet(f"{root}/dead_letters")
    assert dead.count() == flows.mediated(spark, SF_SMALL).filter(F.col("status") == "error").count()
    assert dead.select("batch_id").distinct().count() == 3


def test_kafka_sink_needs_topics():
    with pytest.raises(SystemExit):
        cli.main(["stream-mediation", "--source", "kafka", "--servers", "h:1", "--topic", "t", "--tables", "x",
                  "--sink", "kafka"])


def test_sizing_restores_the_session(spark):
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    with sized_shuffles(spark, []):
        assert spark.conf.get(key) == old
    # the test session names its own count, which is kept
    with sized_shuffles(spark, [f"{SF_SMALL}/events.parquet"]):
        assert spark.conf.get(key) == old
    assert spark.conf.get(key) == old


def test_rule_constants():
    """The oracle reads the rules, so a wrong constant is only seen here."""
    r = Rules()
    assert (r.evening_hours, r.evening_factor, r.morning_hours, r.morning_factor) == ((18, 23), 1.02, (8, 12), 0.98)
    assert (r.friday_factor, r.roaming_factor, r.vat_rate, r.regulatory_fee) == (0.97, 1.5, 0.20, 1.5)
    assert (r.seasonal_month, r.seasonal_rate, r.voice_threshold_minutes, r.voice_discount_rate) == (3, 0.1, 300, 0.1)
    assert (r.data_threshold_mb, r.data_discount_rate, r.spend_threshold, r.spend_discount_rate) == (
        2000, 0.08, 100, 0.05)
    assert (r.student_discount_rate, r.urban_discount_rate, r.loyalty_rate_per_year, r.loyalty_max_rate,
            r.loyalty_min_months) == (0.15, 0.05, 0.02, 0.10, 12)


def test_quantile_predicates_cut_crowded_ids_evenly(spark):
    """Nine tenths of the ids crowd in a thousandth of their range."""
    from pyspark.sql import functions as F

    from chargeline.sources.jdbc import quantile_predicates

    ids = spark.range(10_000).select(F.when(F.col("id") % 10 == 0, F.col("id") * 100).otherwise(F.col("id") % 1000).alias("k"))
    table = ids.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k UNION ALL SELECT -5 UNION ALL SELECT 99999999"))
    parts = quantile_predicates(ids, "k", 8)
    assert len(parts) == 8
    sizes = [table.where(p).count() for p in parts]
    assert sum(sizes) == 10_003  # each row in one part, also rows outside the extract and NULL
    assert max(sizes) < 2 * 10_003 / 8
    assert quantile_predicates(ids.limit(0), "k", 4) == ["1 = 1"] == quantile_predicates(ids, "k", 1)
    same = quantile_predicates(ids.select(F.lit(3).alias("k")), "k", 4)
    assert same == ["k < 3 OR k IS NULL", "k >= 3"]


def test_key_changes_add_up_to_the_full_check(spark):
    import random

    from chargeline.operators import quality

    rnd = random.Random(3)
    rows = [(rnd.choice([None, *"abcdefgh", f"x{rnd.randrange(60)}"]),) for _ in range(300)]
    frame = lambda r: spark.createDataFrame(r, "k string")
    changes, at = None, 0
    for size in (0, 7, 100, 1, 192):
        new, old = frame(rows[at:at + size]), frame(rows[:at])
        one = quality.key_changes(new, old if at else None, "k")
        changes = one if changes is None else changes.unionByName(one)
        at += size
    got = {r.check_name: r.violations for r in quality.summed_changes(changes, "t").collect()}
    assert got == {r.check_name: r.violations for r in quality.key_violations({"t": (frame(rows), "k")}).collect()}
