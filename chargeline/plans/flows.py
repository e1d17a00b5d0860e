"""End-to-end compositions of the stages over the lake tables.

Each function returns a lazy DataFrame; nothing is collected. The billing
period defaults to the fixture's month (see ``Rules``). ``source`` selects the
usage stream: ``events`` (billing fixture) or ``orders`` (volume fixture).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chargeline.operators import billing, customers as customer_ops, mediation, rating
from chargeline.rules import DEFAULT_RULES, Rules
from chargeline.sources import fixtures


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_ops.conform(fixtures.customers(spark, sf_dir))


def mediated(spark: SparkSession, sf_dir: str, rules: Rules = DEFAULT_RULES,
             source: str = "events") -> DataFrame:
    return mediation.mediate(fixtures.raw_usage(spark, sf_dir, source), rules)


def valid_usage(spark: SparkSession, sf_dir: str, rules: Rules = DEFAULT_RULES,
                source: str = "events") -> DataFrame:
    return mediation.valid_records(mediated(spark, sf_dir, rules, source))


def priced(spark: SparkSession, sf_dir: str, rules: Rules = DEFAULT_RULES,
           source: str = "events") -> DataFrame:
    """Rating with every intermediate column (status, stage costs)."""
    records = rating.with_event_time(rating.dedupe_input(valid_usage(spark, sf_dir, rules, source)), rules)
    enriched = rating.enrich(records, customers(spark, sf_dir), fixtures.rate_plans(spark), rules)
    return rating.price(enriched, rules)


def rated(spark: SparkSession, sf_dir: str, rules: Rules = DEFAULT_RULES,
          already_rated: DataFrame | None = None, source: str = "events",
          cust: DataFrame | None = None, plans: DataFrame | None = None) -> DataFrame:
    cust = customers(spark, sf_dir) if cust is None else cust
    plans = fixtures.rate_plans(spark) if plans is None else plans
    return rating.rate(valid_usage(spark, sf_dir, rules, source), cust, plans, rules, already_rated)


def breakdown(spark: SparkSession, sf_dir: str, rules: Rules = DEFAULT_RULES,
              rated_df: DataFrame | None = None, source: str = "events") -> DataFrame:
    cust, plans = customers(spark, sf_dir), fixtures.rate_plans(spark)
    if rated_df is None:
        rated_df = rated(spark, sf_dir, rules, source=source, cust=cust, plans=plans)
    return billing.breakdown(rated_df, cust, plans, rules)


def service_lines(spark: SparkSession, sf_dir: str, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """B07-B12 only (before usage discounts)."""
    totals = billing.usage_totals(rated(spark, sf_dir, rules), rules)
    return billing.service_costs(billing.attach_plans(
        totals, customers(spark, sf_dir), fixtures.rate_plans(spark), rules))


def invoices(spark: SparkSession, sf_dir: str, rules: Rules = DEFAULT_RULES,
             rated_df: DataFrame | None = None, source: str = "events") -> DataFrame:
    return billing.invoices(breakdown(spark, sf_dir, rules, rated_df, source), rules)
