"""Invoice presentation: latest invoice, printed view, documents, outbox."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chargeline.functions.columns import date_text
from chargeline.functions.template import INVOICE_DOCUMENT, render
from chargeline.operators.dedup import dedupe
from chargeline.operators.joins import broadcast_if_small
from chargeline.rules import DEFAULT_RULES, Rules


def latest(invoices: DataFrame) -> DataFrame:
    """Newest invoice per subscriber (ties: larger invoice_id). An
    aggregate, so a subscriber with many invoices never needs one task."""
    return dedupe(invoices, ["msisdn"], ["invoice_date", "invoice_id"], keep="max")


def view(invoices: DataFrame, customers: DataFrame, rate_plans: DataFrame,
         rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The figures printed on an invoice. Plan facts come from the
    subscriber's plan (0 / 'Unknown Plan' when the plan is not of that service);
    the VAT line is the residual of the total over subtotal + fee, and only the
    seasonal discount is shown (as printed by the source system)."""
    plans = broadcast_if_small(rate_plans)
    joined = (invoices.join(customers.select("msisdn", "rate_plan_id"), "msisdn", "left")
              .join(plans, "rate_plan_id", "left"))
    svc = F.col("service_type")

    def fact(service: str, col: str, default) -> Column:
        return F.coalesce(F.when(svc == service, F.col(col)), F.lit(default))

    subtotal = F.col("voice_cost") + F.col("sms_cost") + F.col("data_cost")
    fee = F.lit(rules.regulatory_fee)
    with_fee = F.col("subtotal") + fee
    seasonal = rules.as_of.month == rules.seasonal_month
    seasonal_amt = F.col("subtotal") * rules.seasonal_rate if seasonal else F.lit(0.0)
    return joined.select(
        "invoice_id", "msisdn", "customer_name", "region", "student", "invoice_date",
        "billing_period_start", "billing_period_end", "status",
        "voice_cost", "sms_cost", "data_cost", "total_cost", "voice_usage", "sms_usage", "data_usage",
        F.coalesce(F.when(svc == "voice", F.col("plan_name")), F.lit(rules.unknown_plan_name)).alias("plan_name"),
        fact("voice", "free_units", 0).alias("voice_free_minutes"),
        fact("sms", "free_units", 0).alias("sms_free_units"),
        fact("data", "tiered_threshold_mb", 0.0).alias("data_threshold_mb"),
        fact("voice", "unit_price", 0.0).alias("voice_unit_price"),
        fact("sms", "unit_price", 0.0).alias("sms_unit_price"),
        fact("data", "unit_price", 0.0).alias("data_unit_price"),
        fact("data", "tiered_price_mb", 0.0).alias("data_tiered_price"),
        subtotal.alias("subtotal"),
    ).select(
        "*",
        F.greatest(F.lit(0.0), F.col("voice_usage") - F.col("voice_free_minutes")).alias("voice_billable_minutes"),
        F.greatest(F.lit(0), F.col("sms_usage") - F.col("sms_free_units")).alias("sms_billable_count"),
        fee.alias("regulatory_fee"),
        F.when(F.col("total_cost") > with_fee, F.col("total_cost") - with_fee).otherwise(0.0).alias("vat_amount"),
        seasonal_amt.alias("seasonal_discount"),
    ).select(
        "*",
        F.greatest(F.lit(0.0), F.col("seasonal_discount")).alias("total_discounts"),
        F.lit(0.0).alias("usage_discounts"),
        F.lit(0.0).alias("loyalty_discount"),
        F.lit(0.0).alias("student_discount"),
        F.lit(0.0).alias("urban_discount"),
    )


BREAKDOWN_AMOUNTS = ["subtotal_before_discounts", "usage_discounts", "total_spending_discount",
                     "student_discount", "urban_discount", "loyalty_discount", "seasonal_discount",
                     "total_discounts", "total_cost_after_discounts", "regulatory_fee",
                     "vat_amount", "total_cost"]


def breakdown_view(bd: DataFrame, rate_plans: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The invoice figures as actually billed (fee waived for students, VAT on
    the discounted total, every discount line), rounded like the invoice."""
    from chargeline.operators.billing import invoice_identity

    plans = broadcast_if_small(rate_plans.select("rate_plan_id", "plan_name"))
    usage_disc = F.col("subtotal_before_discounts") - F.col("net_after_usage_discounts")
    total_disc = (usage_disc + F.col("total_spending_discount") + F.col("student_discount")
                  + F.col("urban_discount") + F.col("loyalty_discount") + F.col("seasonal_discount"))
    df = (bd.join(plans, "rate_plan_id", "left")
          .withColumn("usage_discounts", usage_disc)
          .withColumn("total_discounts", total_disc))
    s = rules.money_scale
    return df.select(
        invoice_identity(rules).alias("invoice_id"), "msisdn", "customer_name",
        F.coalesce(F.col("plan_name"), F.lit(rules.unknown_plan_name)).alias("plan_name"),
        *[F.round(F.col(c), s).alias(c) for c in BREAKDOWN_AMOUNTS])


def documents(v: DataFrame, rules: Rules = DEFAULT_RULES, keep: tuple[str, ...] = ()) -> DataFrame:
    """One HTML document per invoice, built as a single string expression."""
    return v.select("invoice_id", "msisdn", render(INVOICE_DOCUMENT, rules).alias("document"), *keep)


def outbox(v: DataFrame, rules: Rules = DEFAULT_RULES, keep: tuple[str, ...] = ()) -> DataFrame:
    """Notification rows (subject, body) -- delivery is not part of Spark."""
    from chargeline.functions.template import INVOICE_MAIL_BODY
    subject = F.concat(F.lit(rules.mail_subject_prefix), date_text("invoice_date"))
    return v.select("invoice_id", "msisdn", subject.alias("subject"),
                    render(INVOICE_MAIL_BODY, rules).alias("body"), *keep)


__all__ = ["latest", "view", "breakdown_view", "documents", "outbox"]
