"""Declarative text templates rendered as one Spark string expression per row.

A template is a list of parts ``(kind, arg)``:

* ``lit``   literal text
* ``rule``  literal text taken from a ``Rules`` attribute
* ``text``  column value, HTML-escaped (missing -> empty)
* ``plain`` column value as is (missing -> empty)
* ``num2``  amount with two decimals, half-up (12.50)
* ``int``   whole number
* ``title`` first letter upper case, rest lower case
* ``yesno`` boolean as Yes / No (missing -> No)
* ``date``  date part yyyy-MM-dd

Rendering is a single ``concat`` of built-in expressions, so documents are
produced inside whole-stage codegen on the executors, one row per invoice.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chargeline.functions.columns import date_text, decimal_text, html_escape, title_case

# FIXED VALUES: the section titles, row labels and units below are the printed
# texts of the source system's invoice and notification (kept for parity);
# the HTML around them is this package's own.
INVOICE_DOCUMENT = [
    ("lit", "<!DOCTYPE html><html><head><meta charset=\"utf-8\"><title>Invoice "),
    ("text", "invoice_id"),
    ("lit", "</title></head><body><section class=\"bill-to\"><h3>Bill To:</h3><p><strong>"),
    ("text", "customer_name"),
    ("lit", "</strong></p><p>MSISDN: "), ("text", "msisdn"),
    ("lit", "</p><p>Region: "), ("title", "region"),
    ("lit", "</p><p>Student: "), ("yesno", "student"),
    ("lit", "</p></section><section class=\"details\"><h3>Invoice Details:</h3><p>Invoice ID: "),
    ("text", "invoice_id"),
    ("lit", "</p><p>Invoice Date: "), ("date", "invoice_date"),
    ("lit", "</p><p>Billing Period: "), ("date", "billing_period_start"),
    ("lit", " to "), ("date", "billing_period_end"),
    ("lit", "</p><p>Status: "), ("title", "status"),
    ("lit", "</p></section><h3>Usage Summary</h3><table><tr><th>Service Type</th><th>Usage</th>"
            "<th>Free Allowance</th><th>Billable Usage</th><th>Cost (MAD)</th></tr>"
            "<tr><td>Voice Calls</td><td>"),
    ("num2", "voice_usage"), ("lit", " minutes</td><td>"),
    ("int", "voice_free_minutes"), ("lit", " minutes</td><td>"),
    ("num2", "voice_billable_minutes"), ("lit", " minutes</td><td>"),
    ("num2", "voice_cost"),
    ("lit", "</td></tr><tr><td>SMS Messages</td><td>"),
    ("int", "sms_usage"), ("lit", " messages</td><td>"),
    ("int", "sms_free_units"), ("lit", " messages</td><td>"),
    ("int", "sms_billable_count"), ("lit", " messages</td><td>"),
    ("num2", "sms_cost"),
    ("lit", "</td></tr><tr><td>Data Usage</td><td>"),
    ("num2", "data_usage"), ("lit", " MB</td><td>0 MB</td><td>"),
    ("num2", "data_usage"), ("lit", " MB</td><td>"),
    ("num2", "data_cost"),
    ("lit", "</td></tr></table><h3>Discount Summary</h3><table><tr><th>Discount Type</th>"
            "<th>Amount (MAD)</th></tr><tr><td>Usage Threshold Discounts</td><td>-"),
    ("num2", "usage_discounts"),
    ("lit", "</td></tr><tr><td>Seasonal Discount</td><td>-"),
    ("num2", "seasonal_discount"),
    ("lit", "</td></tr></table><table class=\"totals\"><tr><td>Subtotal:</td><td>"),
    ("num2", "subtotal"),
    ("lit", " MAD</td></tr><tr><td>Total Discounts:</td><td>-"),
    ("num2", "total_discounts"),
    ("lit", " MAD</td></tr><tr><td>VAT (20%):</td><td>"),
    ("num2", "vat_amount"),
    ("lit", " MAD</td></tr><tr><td>Regulatory Fee:</td><td>"),
    ("num2", "regulatory_fee"),
    ("lit", " MAD</td></tr><tr><td>TOTAL DUE:</td><td>"),
    ("num2", "total_cost"),
    ("lit", " MAD</td></tr></table></body></html>"),
]

INVOICE_MAIL_BODY = [
    ("lit", "Dear "), ("plain", "customer_name"), ("lit", ",\n\n"),
    ("rule", "mail_body_intro"),
    ("lit", "\n\nInvoice Summary:\n- Invoice ID: "), ("plain", "invoice_id"),
    ("lit", "\n- Billing Period: "), ("date", "billing_period_start"),
    ("lit", " to "), ("date", "billing_period_end"),
    ("lit", "\n- Total Amount: "), ("num2", "total_cost"),
    ("lit", " MAD\n- Status: "), ("plain", "status"),
    ("lit", "\n\nBest regards,\nCustomer Service\n"),
]


def part_column(kind: str, arg: str, rules) -> Column:
    if kind == "lit":
        return F.lit(arg)
    if kind == "rule":
        return F.lit(str(getattr(rules, arg)))
    c = F.col(arg)
    if kind == "text":
        return F.coalesce(html_escape(c.cast("string")), F.lit(""))
    if kind == "plain":
        return F.coalesce(c.cast("string"), F.lit(""))
    if kind == "num2":
        return F.coalesce(decimal_text(c, 2), F.lit(""))
    if kind == "int":
        return F.coalesce(c.cast("bigint").cast("string"), F.lit(""))
    if kind == "title":
        return F.coalesce(html_escape(title_case(c)), F.lit(""))
    if kind == "yesno":
        return F.when(F.coalesce(c, F.lit(False)), F.lit("Yes")).otherwise(F.lit("No"))
    if kind == "date":
        return F.coalesce(date_text(c), F.lit(""))
    raise ValueError(f"unknown template part {kind!r}")


def render(template, rules) -> Column:
    return F.concat(*[part_column(k, a, rules) for k, a in template])
