"""Rating: price every normalised record from the customer and rate-plan tables.

Plan shape: one shuffle join of usage with customers on msisdn (AQE splits a
hot subscriber's partition), one broadcast join with the rate-plan dimension
(size checked), and a single projection for the status and cost rules.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chargeline.functions.columns import in_range, month_start, ts_literal
from chargeline.operators.dedup import dedupe
from chargeline.operators.joins import broadcast_if_small, heavy_keys, left_join_split, new_keys_only
from chargeline.rules import DEFAULT_RULES, Rules
from chargeline.schemas import NORMALIZED, RATED_COLUMNS

_INPUT_COLUMNS = [f for f in NORMALIZED.fieldNames() if f != "status"]

def dedupe_input(records: DataFrame) -> DataFrame:
    """One row per record_id, deterministic survivor."""
    return dedupe(records.select(*_INPUT_COLUMNS), ["record_id"], ["timestamp"])

def not_yet_rated(records: DataFrame, rated: DataFrame | None) -> DataFrame:
    """Drop records whose id is already in the rated table.

    An absent table is an explicit ``None`` (first run), not a swallowed error.
    The record id alone decides, so a record without an event time, rated under
    an earlier ``as_of``, is not rated again in another month.
    """
    return new_keys_only(records, rated, "record_id")


def with_event_time(records: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Missing event time -> run time ``as_of``; month of the record."""
    ts = F.coalesce(F.col("timestamp"), ts_literal(rules.as_of))
    return (records.withColumn("timestamp", ts)
            .withColumn("billing_month", month_start("timestamp")))

def hot_subscribers(records: DataFrame, share: float = 0.01) -> list[str]:
    """Subscribers with at least ``share`` of the records, for ``rate``."""
    return heavy_keys(records, "msisdn", share)


def enrich(records: DataFrame, customers: DataFrame, rate_plans: DataFrame,
           rules: Rules = DEFAULT_RULES, hot: Sequence[str] = ()) -> DataFrame:
    """Attach the subscriber's plan and status, then the price of the
    plan for this record's service (left joins: nothing is dropped)."""
    cust = customers.select(
        "msisdn",
        F.col("rate_plan_id").alias("customer_rate_plan_id"),
        F.col("status").alias("customer_status"),
        "region", "student", "activation_date")
    plans = broadcast_if_small(rate_plans.select(F.col("rate_plan_id").alias("plan_id"), "plan_name",
                                                 "service_type", "unit_price"))
    with_customer = left_join_split(records, cust, "msisdn", hot)
    return (with_customer
            .join(plans, (F.col("customer_rate_plan_id") == F.col("plan_id"))
                  & (F.col("record_type") == F.col("service_type")), "left")
            .drop("plan_id", "service_type"))

def roaming(rules: Rules) -> Column:
    return F.col("cell_id").isin(*rules.roaming_cells)

def first_status() -> Column:
    """Customer known? active? has a plan?"""
    return (F.when(F.col("customer_status").isNull(), "unmatched")
            .when(F.col("customer_status") != "active", "rejected")
            .when(F.col("customer_rate_plan_id").isNull(), "unmatched")
            .otherwise("rated"))

def required_plan(rules: Rules) -> Column:
    """voice/sms from a roaming cell needs a premium plan."""
    return F.when(F.col("record_type").isin(*rules.premium_services) & roaming(rules),
                  "premium").otherwise("any")

def rating_status(rules: Rules) -> Column:
    """R09 on top of R07. A NULL plan name makes the premium test NULL, so it
    falls through to the missing-price test (unmatched)."""
    s1 = first_status()
    rated = s1 == "rated"
    return (F.when(rated & (required_plan(rules) == "premium")
                   & ~F.col("plan_name").contains(rules.premium_marker), "rejected")
            .when(rated & F.col("unit_price").isNull(), "unmatched")
            .otherwise(s1))

def base_cost(status: Column) -> Column:
    """Quantity x unit price for rated voice/data; everything else 0."""
    rated = status == "rated"
    rt = F.col("record_type")
    d, v = F.col("duration_sec"), F.col("data_volume_mb")
    return (F.when(rated & (rt == "voice"),
                   F.when(d.isNull() | (d <= 0), F.lit(0.0)).otherwise(d * F.col("unit_price")))
            .when(rated & (rt == "data"),
                  F.when(v.isNull() | (v <= 0), F.lit(0.0)).otherwise(v * F.col("unit_price")))
            .otherwise(F.lit(0.0)))

def time_of_day(cost: Column, rules: Rules) -> Column:
    """Evening surcharge / morning discount on voice (inclusive hours)."""
    voice = (F.col("record_type") == "voice") & (cost > 0)
    hour = F.hour("timestamp")
    return (F.when(voice & in_range(hour, *rules.evening_hours), cost * rules.evening_factor)
            .when(voice & in_range(hour, *rules.morning_hours), cost * rules.morning_factor)
            .otherwise(cost))

def friday(cost: Column, rules: Rules) -> Column:
    """Friday discount on voice (dayofweek: Sunday=1 .. Saturday=7)."""
    cond = (F.col("record_type") == "voice") & (cost > 0) & (F.dayofweek("timestamp") == 6)
    return F.when(cond, cost * rules.friday_factor).otherwise(cost)

def roaming_surcharge(cost: Column, rules: Rules) -> Column:
    """Roaming cell surcharge on every priced record."""
    return F.when((cost > 0) & roaming(rules), cost * rules.roaming_factor).otherwise(cost)

def price(enriched: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """R07-R13 as stage columns (base_cost, cost_time_of_day, cost_friday, cost)."""
    status = rating_status(rules)
    df = enriched.withColumns({"required_rate_plan_type": required_plan(rules), "rating_status": status})
    df = df.withColumn("base_cost", base_cost(F.col("rating_status")))
    df = df.withColumn("cost_time_of_day", time_of_day(F.col("base_cost"), rules))
    df = df.withColumn("cost_friday", friday(F.col("cost_time_of_day"), rules))
    return df.withColumn("cost", roaming_surcharge(F.col("cost_friday"), rules))

def project_rated(priced: DataFrame) -> DataFrame:
    """The rated-record layout; the plan id is the customer's."""
    return priced.withColumn("rate_plan_id", F.col("customer_rate_plan_id")).select(*RATED_COLUMNS)

def rate(records: DataFrame, customers: DataFrame, rate_plans: DataFrame,
         rules: Rules = DEFAULT_RULES, already_rated: DataFrame | None = None,
         input_unique: bool = False, hot_subscribers: Sequence[str] = ()) -> DataFrame:
    """Valid normalised records -> rated records (one row per record_id).

    The source system de-duplicates again after rating; the input is already unique
    per record_id and the joins cannot multiply rows (unique dimension keys), so
    the second pass would be a no-op shuffle and is left out.

    ``input_unique=True`` declares the input unique per record_id (e.g. the
    idempotent normalised store) and skips the de-duplication shuffle.

    ``hot_subscribers`` are joined apart (``joins.left_join_split``). Against
    bucketed customers nothing else splits a hot subscriber; against a shuffled
    table AQE does.
    """
    unique = records.select(*_INPUT_COLUMNS) if input_unique else dedupe_input(records)
    timed = with_event_time(unique, rules)
    fresh = not_yet_rated(timed, already_rated)
    enriched = enrich(fresh, customers, rate_plans, rules, hot_subscribers)
    return project_rated(price(enriched, rules))

def status_breakdown(rated: DataFrame) -> DataFrame:
    return rated.groupBy("rating_status").agg(F.count(F.lit(1)).alias("records"))

__all__ = ["rate", "price", "enrich", "with_event_time", "not_yet_rated", "dedupe_input",
           "project_rated", "RATED_COLUMNS", "status_breakdown"]
