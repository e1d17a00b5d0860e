"""Cross-query invariants at sf0.01 and the fixture's branch coverage."""

import pytest

from conftest import SF_MID
from chargeline.operators import counters, mediation, rating, reports
from chargeline.plans import flows
from chargeline.plans.queries import REGISTRY


@pytest.fixture(scope="module")
def stages(spark):
    mediated = flows.mediated(spark, SF_MID)
    rated = flows.rated(spark, SF_MID)
    invoices = flows.invoices(spark, SF_MID)
    return mediated, rated, invoices


def test_invoice_counts_agree_between_region_and_service(spark, stages):
    _, _, invoices = stages
    by_region = sum(r.customer_count for r in reports.revenue_by_region(invoices).collect())
    by_service = {r.service_type: r.total_invoices for r in reports.revenue_by_service(invoices).collect()}
    assert set(by_service.values()) == {by_region} == {invoices.count()}


def test_rating_partitions_valid_records(spark, stages):
    mediated, rated, _ = stages
    counts = {r.stage: r.records for r in counters.stage_counts(mediated, rated, stages[2]).collect()}
    assert counts["rating_rated"] + counts["rating_rejected"] + counts["rating_unmatched"] \
        == counts["rating_out"] == counts["mediation_valid"]


def test_fixture_branch_coverage(spark, stages):
    """The sf0.01 fixture hits the branches the test plan relies on."""
    mediated, rated, invoices = stages
    st = {r.status: r.records for r in mediation.status_counts(mediated).collect()}
    assert st == {"error": 662, "valid": 9338}
    rs = {r.rating_status: r.records for r in rating.status_breakdown(rated).collect()}
    assert rs == {"rated": 4550, "rejected": 2827, "unmatched": 1961}
    inv = invoices.collect()
    assert len(inv) == 99
    assert sum(1 for r in inv if r.voice_usage >= 300) == 29
    assert sum(1 for r in inv if r.data_usage >= 2000) == 25
    assert sum(1 for r in inv if r.student) == 22
    assert sum(1 for r in inv if r.region == "urban") == 72


def test_second_rating_run_rates_nothing(spark):
    valid = flows.valid_usage(spark, SF_MID)
    cust, plans = flows.customers(spark, SF_MID), flows.fixtures.rate_plans(spark)
    first = rating.rate(valid, cust, plans)
    assert rating.rate(valid, cust, plans, already_rated=first).count() == 0


def test_invoice_ids_identical_on_rerun(spark):
    a = sorted(r.invoice_id for r in REGISTRY["billing_invoices"](spark, SF_MID).collect())
    b = sorted(r.invoice_id for r in REGISTRY["billing_invoices"](spark, SF_MID).collect())
    assert a == b and len(set(a)) == len(a)
