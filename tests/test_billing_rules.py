"""Billing arithmetic on hand-written rows (allowances, tiers, discounts, fees)."""

import datetime as dt
from dataclasses import replace

import pytest

from rows import customers, records
from chargeline.operators import billing, rating
from chargeline.rules import DEFAULT_RULES
from chargeline.sources.fixtures import rate_plans

WED = dt.datetime(2024, 1, 10, 3, 0, 0)  # no time-of-day or Friday factor


def bill(spark, recs, cust=None, rules=DEFAULT_RULES):
    cust_df = customers(spark, cust or [{}])
    rated = rating.rate(records(spark, recs), cust_df, rate_plans(spark), rules)
    return {r.msisdn: r for r in billing.breakdown(rated, cust_df, rate_plans(spark), rules).collect()}


def voice_minutes(spark, minutes, **cust):
    recs = [{"timestamp": WED, "duration_sec": 60.0}] * minutes
    return bill(spark, recs, [dict({"rate_plan_id": 1}, **cust)])["+212000000001"]


def test_voice_allowance_pro_rata(spark):
    b = voice_minutes(spark, 10)
    assert b.voice_usage_minutes == 10.0
    assert b.voice_billable_minutes == 8.0
    assert b.voice_cost == 10 * 0.6 * (8.0 / 10.0)


def test_voice_usage_equal_to_free_minutes_costs_nothing(spark):
    b = voice_minutes(spark, 2)
    assert (b.voice_billable_minutes, b.voice_cost) == (0.0, 0.0)


def test_minutes_round_up_per_record(spark):
    b = bill(spark, [{"timestamp": WED, "duration_sec": 61.0}, {"timestamp": WED, "duration_sec": 120.0}])
    assert b["+212000000001"].voice_usage_minutes == 4.0


@pytest.mark.parametrize("minutes,discounted", [(299, False), (300, True)])
def test_voice_volume_discount_threshold(spark, minutes, discounted):
    b = voice_minutes(spark, minutes)
    base = minutes * 0.6 * ((minutes - 2) / minutes)
    assert b.voice_cost == pytest.approx(base * (0.9 if discounted else 1.0), rel=1e-12)


def data_bill(spark, mbs, plan=3):
    recs = [{"record_type": "data", "timestamp": WED, "duration_sec": 30.0, "data_volume_mb": mb} for mb in mbs]
    return bill(spark, recs, [{"rate_plan_id": plan}])["+212000000001"]


def test_data_within_tier_keeps_rated_cost(spark):
    b = data_bill(spark, [4.2, 5.0])
    assert b.data_usage_mb == 11.0 - 1.0  # ceil(4.2)=5, ceil(5.0)=5
    assert b.data_cost == pytest.approx((4.2 + 5.0) * 0.05)


def test_data_above_tier_is_repriced(spark):
    b = data_bill(spark, [500.0])
    assert b.data_cost == 10.0 * 0.05 + (500.0 - 10.0) * 0.1


@pytest.mark.parametrize("mb,discounted", [(1999.0, False), (2000.0, True)])
def test_data_volume_discount_threshold(spark, mb, discounted):
    b = data_bill(spark, [mb])
    cost = 10.0 * 0.05 + (mb - 10.0) * 0.1
    assert b.data_cost == pytest.approx(cost * (0.92 if discounted else 1.0), rel=1e-12)


def test_sms_beyond_free_units(spark):
    recs = [{"record_type": "sms", "timestamp": WED, "duration_sec": None}] * 7
    b = bill(spark, recs, [{"rate_plan_id": 2}])["+212000000001"]
    assert b.sms_usage_count == 7
    assert b.sms_cost == pytest.approx(2 * 0.05)


def test_spend_discount_at_exactly_100(spark):
    # 10000 s at 0.01 = 100.00 rated; 2 free minutes of 167 -> scale; use a
    # roaming-free data plan instead: 0.05 * 10 + 0.1 * (x - 10) = 100 -> x = 1005 MB
    b = data_bill(spark, [1005.0])
    assert b.subtotal_before_discounts == pytest.approx(100.0)
    assert b.total_spending_discount == pytest.approx(5.0)


def test_student_urban_fee_and_vat(spark):
    b = voice_minutes(spark, 10, student=True, region="urban")
    net = b.voice_cost
    assert b.student_discount == pytest.approx(net * 0.15)
    assert b.urban_discount == pytest.approx(net * 0.05)
    assert b.regulatory_fee == 0.0
    assert b.total_cost == pytest.approx(b.total_cost_after_discounts * 1.2)


def test_null_region_gets_no_urban_discount(spark):
    b = voice_minutes(spark, 10, region=None)
    assert b.urban_discount == 0.0 and b.regulatory_fee == 1.5


def test_loyalty_exactly_twelve_months_and_cap(spark):
    as_of = DEFAULT_RULES.as_of.date()
    b = voice_minutes(spark, 10, activation_date=as_of - dt.timedelta(days=360))
    assert b.loyalty_months == 12.0
    assert b.loyalty_discount_rate == pytest.approx(0.02)
    b = voice_minutes(spark, 10, activation_date=as_of - dt.timedelta(days=3650))
    assert b.loyalty_discount_rate == 0.10
    b = voice_minutes(spark, 10, activation_date=as_of - dt.timedelta(days=300))
    assert b.loyalty_discount_rate == 0.0


def test_seasonal_discount_in_configured_month(spark):
    march = replace(DEFAULT_RULES, as_of=dt.datetime(2024, 3, 2))
    recs = [{"timestamp": WED, "duration_sec": 60.0}] * 10
    b = bill(spark, recs, [{"rate_plan_id": 1, "activation_date": dt.date(2024, 1, 1)}], march)["+212000000001"]
    assert b.seasonal_discount == pytest.approx(b.net_after_usage_discounts * 0.10)


def test_all_null_durations(spark):
    recs = [{"timestamp": WED, "duration_sec": None}] * 3
    inv = billing.invoices(billing.breakdown(
        rating.rate(records(spark, recs), customers(spark, [{}]), rate_plans(spark)),
        customers(spark, [{}]), rate_plans(spark))).collect()
    assert inv[0].voice_usage == 0.0 and inv[0].voice_cost == 0.0


def test_invoice_ids_are_stable_and_period_bound(spark):
    recs = records(spark, [{"timestamp": WED}])
    cust = customers(spark, [{}])
    def ids(rules):
        rated = rating.rate(recs, cust, rate_plans(spark), rules)
        return [r.invoice_id for r in billing.bill(rated, cust, rate_plans(spark), rules).collect()]
    assert ids(DEFAULT_RULES) == ids(DEFAULT_RULES)
    other = replace(DEFAULT_RULES, period_start=dt.datetime(2024, 1, 5))
    assert ids(other) != ids(DEFAULT_RULES)


def test_period_is_half_open_unless_inclusive(spark):
    end = DEFAULT_RULES.period_end
    recs = [{"timestamp": end, "duration_sec": 600.0}]
    assert bill(spark, recs) == {}
    inclusive = replace(DEFAULT_RULES, inclusive_period_end=True)
    assert "+212000000001" in bill(spark, recs, rules=inclusive)


def test_invoice_view_prints_fee_and_residual_vat_for_students(spark):
    from chargeline.operators import invoices as inv_ops

    cust_rows = [{"rate_plan_id": 1, "student": True}]
    recs = [{"timestamp": WED, "duration_sec": 600.0}] * 3
    cust = customers(spark, cust_rows)
    rated = rating.rate(records(spark, recs), cust, rate_plans(spark))
    bd = billing.breakdown(rated, cust, rate_plans(spark))
    inv = billing.invoices(bd)
    (v,) = inv_ops.view(inv, cust, rate_plans(spark)).collect()
    (b,) = bd.collect()
    assert b.regulatory_fee == 0.0                       # billed: waived for students
    assert v.regulatory_fee == 1.5                       # printed: shown anyway
    assert v.plan_name == "Standard Plan"
    assert v.voice_free_minutes == 2 and v.voice_billable_minutes == v.voice_usage - 2
    residual = v.total_cost - (v.subtotal + 1.5)
    assert v.vat_amount == (residual if residual > 0 else 0.0)
    (bv,) = inv_ops.breakdown_view(bd, rate_plans(spark)).collect()
    assert bv.regulatory_fee == 0.0 and bv.plan_name == "Standard Plan"
