"""Subscriber-dimension operators: eligibility, profile, insert-if-absent."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chargeline.functions.columns import money
from chargeline.operators.dedup import dedupe
from chargeline.operators.joins import broadcast_if_small
from chargeline.rules import DEFAULT_RULES, Rules

PROFILE_DIMENSIONS = ("rate_plan_id", "region", "student", "status", "subscription_type")


def conform(customers: DataFrame) -> DataFrame:
    """Q05: column defaults of the customer table applied on load."""
    return customers.withColumns({
        "subscription_type": F.coalesce("subscription_type", F.lit("postpaid")),
        "status": F.coalesce("status", F.lit("active")),
        "student": F.coalesce("student", F.lit(False)),
    })


def load(customers: DataFrame) -> DataFrame:
    """Q01/Q05 on load: defaults, then one row per msisdn (the smallest copy),
    so a repeated subscriber row cannot multiply rated records or invoices. On
    a table bucketed by msisdn this adds no shuffle."""
    return dedupe(conform(customers), ["msisdn"])


def load_plans(rate_plans: DataFrame) -> DataFrame:
    """Q01/Q05 on load: no free units unless given, one row per plan id."""
    return dedupe(rate_plans.withColumn("free_units", F.coalesce("free_units", F.lit(0))), ["rate_plan_id"])


def eligible(customers: DataFrame) -> DataFrame:
    """Active subscribers and their plan."""
    return customers.filter(F.col("status") == "active").select("msisdn", "rate_plan_id")


def by_service(customers: DataFrame, rate_plans: DataFrame,
               rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Active subscribers per service of their plan."""
    plans = broadcast_if_small(rate_plans.select("rate_plan_id", "service_type"))
    return (eligible(customers).join(plans, "rate_plan_id", "inner")
            .groupBy("service_type").agg(F.count(F.lit(1)).alias("customer_count")))


def profile(customers: DataFrame, dimensions=PROFILE_DIMENSIONS) -> DataFrame:
    """Count and share of subscribers per value of each dimension.

    One scan: each row is unpivoted into (dimension, value) pairs and counted
    with a partial aggregate; the per-dimension total is a window over the
    already-aggregated rows (a handful per dimension).
    """
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value"))
                      for d in dimensions])
    counts = (customers.select(F.inline(pairs)).groupBy("dimension", "value")
              .agg(F.count(F.lit(1)).alias("customer_count")))
    total = F.sum("customer_count").over(Window.partitionBy("dimension"))
    return counts.withColumn("pct", money(F.lit(100.0) * F.col("customer_count") / total, 1))


def insert_new(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rows of ``incoming`` whose msisdn is not yet in ``existing`` (one per
    msisdn, deterministic survivor) -- the rows an insert-if-absent appends."""
    fresh = dedupe(incoming, ["msisdn"])
    return fresh.join(existing.select("msisdn"), "msisdn", "left_anti")
