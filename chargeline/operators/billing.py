"""Billing: aggregate rated usage per subscriber and period into invoices.

Plan shape: filter (pushed into the scan / pruned by billing_month) -> partial
+ final hash aggregate on msisdn -> join with customers on msisdn (the
aggregate is already hash-partitioned on msisdn, so only customers shuffles)
-> one size-checked broadcast join with the rate-plan dimension -> a single
projection with the invoice arithmetic. Partial aggregation collapses a hot
subscriber's records inside each map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chargeline.functions.columns import exact_sum, ts_literal
from chargeline.operators.joins import broadcast_if_small
from chargeline.rules import DEFAULT_RULES, Rules
from chargeline.schemas import INVOICE_COLUMNS  # noqa: F401  (public layout)



def in_period(rules: Rules) -> Column:
    ts = F.col("timestamp")
    start, end = ts_literal(rules.period_start), ts_literal(rules.period_end)
    upper = ts <= end if rules.inclusive_period_end else ts < end
    return (ts >= start) & upper


def month_bounds(rules: Rules) -> Column:
    """Partition filter on billing_month implied by the period (pruning only)."""
    lo = rules.period_start.date().replace(day=1)
    return (F.col("billing_month") >= F.lit(lo)) & (F.col("billing_month") <= F.lit(rules.period_end.date()))


def usage_totals(rated: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Per-subscriber cost and usage totals of rated records in the period.

    Costs are summed as DECIMAL(28,12) so the total does not depend on the order
    in which partitions are combined. Minutes and MB are rounded up per record.
    """
    rt = F.col("record_type")
    cond = (F.col("rating_status") == "rated") & in_period(rules)
    if "billing_month" in rated.columns:
        cond = cond & month_bounds(rules)
    minutes = F.ceil(F.col("duration_sec") / 60.0).cast("double")
    megabytes = F.ceil(F.col("data_volume_mb")).cast("double")
    return (rated.filter(cond).groupBy("msisdn").agg(
        exact_sum(F.when(rt == "voice", F.col("cost")).otherwise(0.0)).alias("voice_cost_rated"),
        exact_sum(F.when(rt == "sms", F.col("cost")).otherwise(0.0)).alias("sms_cost_rated"),
        exact_sum(F.when(rt == "data", F.col("cost")).otherwise(0.0)).alias("data_cost_rated"),
        F.sum(F.when(rt == "voice", minutes).otherwise(0.0)).alias("voice_usage_minutes"),
        F.count(F.when(rt == "sms", F.lit(1))).alias("sms_usage_count"),
        F.sum(F.when(rt == "data", megabytes).otherwise(0.0)).alias("data_usage_mb"),
    ))


def attach_plans(totals: DataFrame, customers: DataFrame, rate_plans: DataFrame,
                 rules: Rules = DEFAULT_RULES) -> DataFrame:
    """B07/B08 + the plan facts of B09-B11 (one plan row per id, so one join)."""
    cust = customers.select("msisdn", "customer_name", "rate_plan_id", "student", "region",
                            "activation_date")
    plans = broadcast_if_small(rate_plans)
    svc = F.col("service_type")
    joined = totals.join(cust, "msisdn", "inner").join(plans, "rate_plan_id", "left")
    return joined.select(
        *totals.columns, "customer_name", "rate_plan_id", "student", "region", "activation_date",
        (F.datediff(ts_literal(rules.as_of).cast("date"), F.col("activation_date"))
         / rules.days_per_month).alias("loyalty_months"),
        F.when(svc == "voice", F.col("free_units")).alias("voice_free_minutes"),
        F.when(svc == "sms", F.col("free_units")).alias("sms_free_units"),
        F.when(svc == "sms", F.col("unit_price")).alias("sms_unit_price"),
        F.when(svc == "data", F.col("unit_price")).alias("data_unit_price"),
        F.when(svc == "data", F.col("tiered_threshold_mb")).alias("data_threshold_mb"),
        F.when(svc == "data", F.col("tiered_price_mb")).alias("data_tiered_price"),
    )


def service_costs(df: DataFrame) -> DataFrame:
    """Free allowances and tiers -> voice/sms/data cost (NULL -> 0)."""
    minutes, free = F.col("voice_usage_minutes"), F.coalesce("voice_free_minutes", F.lit(0))
    billable = F.when(minutes > free, minutes - free).otherwise(0.0)
    df = df.withColumn("voice_billable_minutes", billable)
    b = F.col("voice_billable_minutes")
    voice = F.when((b > 0) & (minutes > 0), F.col("voice_cost_rated") * (b / minutes)).otherwise(0.0)
    count, sfree = F.col("sms_usage_count"), F.coalesce("sms_free_units", F.lit(0))
    sms = F.when(count > sfree, (count - sfree) * F.col("sms_unit_price")).otherwise(0.0)
    mb, thr = F.col("data_usage_mb"), F.col("data_threshold_mb")
    data = F.when(mb <= thr, F.col("data_cost_rated")).otherwise(
        thr * F.col("data_unit_price") + (mb - thr) * F.col("data_tiered_price"))
    return (df.withColumns({"voice_cost": F.coalesce(voice, F.lit(0.0)),
                            "sms_cost": F.coalesce(sms, F.lit(0.0)),
                            "data_cost": F.coalesce(data, F.lit(0.0))})
            .withColumn("subtotal_before_discounts",
                        F.col("voice_cost") + F.col("sms_cost") + F.col("data_cost")))


def discounts(df: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Usage, spend, student, urban, loyalty and seasonal discounts
    (additive on the post-usage-discount net), regulatory fee, VAT, total."""
    # each withColumns layer only reads columns of the previous layers
    df = df.withColumns({
        "voice_cost": F.when(F.col("voice_usage_minutes") >= rules.voice_threshold_minutes,
                             F.col("voice_cost") * rules.voice_discount_factor).otherwise(F.col("voice_cost")),
        "data_cost": F.when(F.col("data_usage_mb") >= rules.data_threshold_mb,
                            F.col("data_cost") * rules.data_discount_factor).otherwise(F.col("data_cost")),
    })
    net = F.col("voice_cost") + F.col("sms_cost") + F.col("data_cost")
    sub = F.col("subtotal_before_discounts")
    student = F.coalesce(F.col("student"), F.lit(False))
    months = F.col("loyalty_months")
    yearly = months / 12 * rules.loyalty_rate_per_year
    loyalty_rate = F.when(months >= rules.loyalty_min_months,
                          F.when(yearly > rules.loyalty_max_rate, F.lit(rules.loyalty_max_rate))
                          .otherwise(yearly)).otherwise(0.0)
    seasonal = rules.as_of.month == rules.seasonal_month
    df = df.withColumns({
        "net_after_usage_discounts": net,
        "total_spending_discount":
            F.when(sub >= rules.spend_threshold, sub * rules.spend_discount_rate).otherwise(0.0),
        "student_discount": F.when(student, net * rules.student_discount_rate).otherwise(0.0),
        "urban_discount":
            F.when(F.col("region") == "urban", net * rules.urban_discount_rate).otherwise(0.0),
        "loyalty_discount_rate": loyalty_rate,
        "loyalty_discount": net * loyalty_rate,
        "seasonal_discount": net * rules.seasonal_rate if seasonal else F.lit(0.0),
        "regulatory_fee": F.when(student, F.lit(0.0)).otherwise(F.lit(rules.regulatory_fee)),
    })
    after = (net - F.col("total_spending_discount") - F.col("student_discount")
             - F.col("urban_discount") - F.col("loyalty_discount") - F.col("seasonal_discount"))
    df = df.withColumn("total_cost_after_discounts", after)
    with_fees = F.col("total_cost_after_discounts") + F.col("regulatory_fee")
    vat = with_fees * rules.vat_rate
    return df.withColumns({"subtotal_with_fees": with_fees, "vat_amount": vat,
                           "total_cost": with_fees + vat})


def invoice_identity(rules: Rules = DEFAULT_RULES) -> Column:
    """B23 (deterministic): the same subscriber and period always get the same
    id, so a re-run overwrites instead of duplicating."""
    return F.md5(F.concat(F.col("msisdn"), F.lit("-" + rules.period_start.strftime("%Y-%m-%d"))))


def breakdown(rated: DataFrame, customers: DataFrame, rate_plans: DataFrame,
              rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Every intermediate amount, one row per billed subscriber."""
    totals = usage_totals(rated, rules)
    return discounts(service_costs(attach_plans(totals, customers, rate_plans, rules)), rules)


def invoices(bd: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Rounded 16-column invoice rows."""
    s = rules.money_scale

    def r(c: str) -> Column:
        return F.coalesce(F.round(F.col(c), s), F.lit(0.0))

    return bd.select(
        invoice_identity(rules).alias("invoice_id"),
        "msisdn", "customer_name",
        ts_literal(rules.period_start).alias("billing_period_start"),
        ts_literal(rules.period_end).alias("billing_period_end"),
        r("voice_cost").alias("voice_cost"),
        r("sms_cost").alias("sms_cost"),
        r("data_cost").alias("data_cost"),
        r("voice_usage_minutes").alias("voice_usage"),
        F.coalesce(F.col("sms_usage_count"), F.lit(0)).alias("sms_usage"),
        r("data_usage_mb").alias("data_usage"),
        r("total_cost").alias("total_cost"),
        ts_literal(rules.as_of).alias("invoice_date"),
        F.lit(rules.invoice_status).alias("status"),
        "region", "student",
    )


def bill(rated: DataFrame, customers: DataFrame, rate_plans: DataFrame,
         rules: Rules = DEFAULT_RULES) -> DataFrame:
    return invoices(breakdown(rated, customers, rate_plans, rules), rules)
