"""Reports over customers, rated records and invoices.

Global sums are taken over exact decimals so they do not depend on partition
order; averages are the exact sum divided by the count. Every report is a
small aggregate or a top-k, except the listings P01/P02, which sort globally
(a range-partitioned sort, no single-task step).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chargeline.functions.columns import money, number_text
from chargeline.rules import DEFAULT_RULES, Rules

SERVICES = ("voice", "sms", "data")


def customers_report(customers: DataFrame) -> DataFrame:
    """Customer listing by name (NULL names last)."""
    return customers.select(
        "msisdn", "customer_name", "subscription_type", "rate_plan_id", "activation_date",
        "status", "region",
        F.when(F.col("student"), "Yes").otherwise("No").alias("is_student"),
    ).orderBy(F.col("customer_name").asc_nulls_last(), "msisdn")


def invoices_report(invoices: DataFrame) -> DataFrame:
    """Invoices with costs at 2 decimals, newest first."""
    return invoices.select(
        "invoice_id", "msisdn", "customer_name",
        money("voice_cost").alias("voice_cost"),
        money("sms_cost").alias("sms_cost"),
        money("data_cost").alias("data_cost"),
        money("total_cost").alias("total_cost"),
        "voice_usage", "sms_usage", "data_usage", "status", "invoice_date",
    ).orderBy(F.col("invoice_date").desc_nulls_first(), "invoice_id")


def _revenue_aggs(amount: Column, count_name: str) -> list[Column]:
    exact = F.sum(amount.cast("decimal(18,6)"))
    n = F.count(F.lit(1))
    return [
        F.round(exact, 2).cast("decimal(18,2)").alias("total_revenue"),
        n.alias(count_name),
        money(exact.cast("double") / n).alias("avg_revenue_per_customer"),
    ]


def revenue_by_region(invoices: DataFrame) -> DataFrame:
    """Revenue per region; ``customer_count`` counts invoices."""
    return (invoices.groupBy("region").agg(*_revenue_aggs(F.col("total_cost"), "customer_count"))
            .orderBy(F.col("total_revenue").desc_nulls_first(), "region"))


def revenue_by_service(invoices: DataFrame) -> DataFrame:
    """Revenue per service in one scan -- each invoice is unpivoted into
    (service, cost) rows and aggregated once, instead of three scans + UNION."""
    pairs = F.array(*[F.struct(F.lit(s).alias("service_type"),
                               F.col(f"{s}_cost").alias("amount")) for s in SERVICES])
    long = invoices.select(F.inline(pairs))
    return (long.groupBy("service_type").agg(*_revenue_aggs(F.col("amount"), "total_invoices"))
            .orderBy(F.col("total_revenue").desc_nulls_first(), "service_type"))


def rated_records_report(rated: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Newest rated records (top-k; ties broken by record_id)."""
    return (rated.filter(F.col("rating_status") == "rated")
            .select("record_id", "record_type", "timestamp", "msisdn",
                    money("cost").alias("cost"), "rating_status")
            .orderBy(F.col("timestamp").desc_nulls_first(), "record_id")
            .limit(rules.report_row_limit))


def rate_plans_report(rate_plans: DataFrame) -> DataFrame:
    """The plan catalogue; price as an exact decimal at 4 places."""
    return rate_plans.select(
        "rate_plan_id", "plan_name", "service_type",
        F.round(F.col("unit_price").cast("decimal(18,6)"), 4).cast("decimal(38,18)").alias("unit_price"),
        "free_units", "tiered_threshold_mb", "tiered_price_mb",
    ).orderBy("service_type", "plan_name")


def original_data(prefix_type: str = "record_type") -> Column:
    """Compact text of a failed record; missing values print as empty text."""
    def part(label: str, c: Column) -> list[Column]:
        return [F.lit(label), F.coalesce(c, F.lit(""))]

    return F.concat(*part("record_type:", F.col(prefix_type)),
                    *part(", msisdn:", F.col("msisdn")),
                    *part(", duration:", number_text("duration_sec")),
                    *part(", data_volume:", number_text("data_volume_mb")))


def dead_records(rated: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Rating failures in the dead-record layout (no ordering, no limit)."""
    return rated.filter(F.col("rating_status").isin("unmatched", "rejected", "error")).select(
        "record_id",
        F.col("rating_status").alias("error_reason"),
        F.lit(rules.dead_record_source).alias("error_source"),
        F.col("timestamp").alias("error_timestamp"),
        original_data().alias("original_data"),
    )


def dead_records_report(rated: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Newest rating failures (top-k)."""
    return (dead_records(rated, rules)
            .orderBy(F.col("error_timestamp").desc_nulls_first(), "record_id")
            .limit(rules.report_row_limit))


def dead_records_unified(mediation_errors: DataFrame, rated: DataFrame,
                         rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Mediation dead letters and rating failures in one layout."""
    med = mediation_errors.select(
        "record_id",
        F.lit("error").alias("error_reason"),
        F.lit(rules.mediation_source).alias("error_source"),
        F.col("timestamp").alias("error_timestamp"),
        original_data().alias("original_data"),
    )
    return med.unionByName(dead_records(rated, rules))
