"""A subscriber holding a third of all usage: the rating join splits its
partition (AQE skew join) and billing pre-aggregates it map-side."""

import contextlib
import io

from pyspark.sql import functions as F

from conftest import SF_MID
from chargeline.operators import billing, rating
from chargeline.plans import flows
from chargeline.sources.fixtures import rate_plans

HOT = "+212000000012"  # active, voice plan


def final_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_hot_subscriber(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",   # customers too big to broadcast
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.shuffle.partitions": "16",
        # at test size every partition is below the advisory size, so AQE would
        # first merge them all; at real sizes coalescing leaves big ones alone
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        valid = flows.valid_usage(spark, SF_MID)
        # every third record moves to one subscriber
        skewed = valid.withColumn(
            "msisdn", F.when(F.xxhash64("record_id") % 3 == 0, F.lit(HOT)).otherwise(F.col("msisdn")))
        cust = flows.customers(spark, SF_MID)
        rated = rating.rate(skewed, cust, rate_plans(spark))
        rows = rated.groupBy("msisdn").count().orderBy(F.desc("count")).limit(1).collect()
        assert rows[0]["msisdn"] == HOT and rows[0]["count"] > valid.count() / 4
        rated.collect()
        assert "skew=true" in final_plan(rated)
        totals = billing.usage_totals(rated)
        totals.collect()
        assert "partial_sum" in final_plan(totals)
        assert "skew=true" in final_plan(totals)
        bills = billing.bill(rated, cust, rate_plans(spark))
        bills.collect()
        assert "skew=true" in final_plan(bills)
        assert totals.filter(F.col("msisdn") == HOT).count() == 1
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_record_id_collapses_map_side(spark):
    """One record id copied into a third of the input: the dedup aggregate
    collapses the copies inside each map task, so the shuffle carries at most
    one row per map task for it, and the survivor is the earliest copy."""
    from chargeline.operators import mediation

    valid = flows.valid_usage(spark, SF_MID)
    hot = valid.withColumn(
        "record_id", F.when(F.xxhash64("record_id") % 3 == 0, F.lit("r-hot")).otherwise(F.col("record_id")))
    out = mediation.dedupe_records(hot)
    rows = out.filter(F.col("record_id") == "r-hot").collect()
    assert len(rows) == 1
    earliest = hot.filter(F.col("record_id") == "r-hot").agg(F.min("timestamp")).first()[0]
    assert rows[0].timestamp == earliest
    text = final_plan(out)
    assert "partial_min" in text
    assert out.count() == valid.count() - hot.filter(F.col("record_id") == "r-hot").count() + 1


def test_hot_subscriber_on_bucketed_customers(spark):
    """Bucketed customers leave one shuffled side, which AQE does not split: the
    hot subscriber is found by a sketch and joined where its rows lie."""
    from chargeline.operators import joins
    from chargeline.plans import jobs
    from chargeline.session import scratch_path

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        path = scratch_path(spark, "hot-usage")
        valid = flows.valid_usage(spark, SF_MID)
        (valid.withColumn("msisdn", F.when(F.xxhash64("record_id") % 3 == 0, F.lit(HOT)).otherwise(F.col("msisdn")))
         .repartition(16, "record_id").write.parquet(path))
        skewed = spark.read.parquet(path)
        n = skewed.count()
        cust = jobs.publish_customers(spark, flows.customers(spark, SF_MID), "customers_hot", 16,
                                      scratch_path(spark, "customers-hot"))
        hot = rating.hot_subscribers(skewed, 0.05)
        assert hot == [HOT]
        assert joins.heavy_keys(skewed.withColumn("msisdn", F.lit(None).cast("string")), "msisdn") == []
        plain = rating.rate(skewed, cust, rate_plans(spark), input_unique=True)
        split = rating.rate(skewed, cust, rate_plans(spark), input_unique=True, hot_subscribers=hot)
        text = final_plan(split)
        assert "Bucketed: true" in text and "BroadcastHashJoin" in text and "Union" in text

        def largest(df):
            per_task = df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
            return per_task / n

        assert largest(plain) > 0.3 and largest(split) < 0.2
        cols = sorted(plain.columns)
        assert sorted(map(tuple, plain.select(cols).collect()), key=str) == sorted(
            map(tuple, split.select(cols).collect()), key=str)
    finally:
        spark.sql("DROP TABLE IF EXISTS customers_hot")
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
