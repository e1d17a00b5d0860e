"""Report row order (the oracle comparison is order-insensitive)."""

from conftest import SF_SMALL
from chargeline.plans.queries import REGISTRY


def rows(spark, name):
    return REGISTRY[name](spark, SF_SMALL).collect()


def test_customer_listing_by_name_nulls_last(spark):
    r = rows(spark, "report_customers")
    keys = [(x.customer_name is None, x.customer_name or "", x.msisdn) for x in r]
    assert keys == sorted(keys)


def test_invoice_listing_newest_first(spark):
    r = rows(spark, "report_invoices")
    keys = [(-x.invoice_date.timestamp(), x.invoice_id) for x in r]
    assert keys == sorted(keys)


def test_revenue_reports_by_revenue_desc(spark):
    for name in ("report_revenue_by_region", "report_revenue_by_service"):
        revenue = [x.total_revenue for x in rows(spark, name)]
        assert revenue == sorted(revenue, reverse=True)


def test_top_k_reports_newest_first(spark):
    r = rows(spark, "report_rated_records")
    keys = [(-x.timestamp.timestamp(), x.record_id) for x in r]
    assert keys == sorted(keys) and len(r) <= 1000
    d = rows(spark, "report_dead_records")
    keys = [(-x.error_timestamp.timestamp(), x.record_id) for x in d]
    assert keys == sorted(keys) and len(d) <= 1000
