"""Data-quality checks from the table constraints (Q01-Q04), as batch jobs.

Each check reads its table once: conditional counts in one aggregate, then an
unpivot into (check, violations) rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chargeline.operators.joins import broadcast_if_small
from chargeline.rules import DEFAULT_RULES, Rules


def _unpivot(counts: DataFrame, table: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(f"{table}.{c}").alias("check_name"),
                               F.col(c).cast("bigint").alias("violations")) for c in counts.columns])
    return counts.select(F.inline(pairs))


def key_violations(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Q01: per table, keys occurring more than once, surplus rows, NULL keys."""
    out = None
    for name, (df, key) in tables.items():
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        agg = per_key.agg(
            F.count_if(F.col(key).isNotNull() & (F.col("n") > 1)).alias(f"{key}:duplicate_keys"),
            F.coalesce(F.sum(F.when(F.col(key).isNotNull() & (F.col("n") > 1), F.col("n") - 1)),
                       F.lit(0)).alias(f"{key}:surplus_rows"),
            F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias(f"{key}:null_keys"),
        )
        part = _unpivot(agg, name)
        out = part if out is None else out.unionByName(part)
    return out


def key_changes(new: DataFrame, stored: DataFrame | None, key: str) -> DataFrame:
    """Q01 for appended rows: one row with what they add to the table's duplicate
    keys, surplus rows and NULL keys. ``stored`` has the rows that the table held
    before of the keys in ``new`` (others are not looked at)."""
    added = new.groupBy(key).agg(F.count(F.lit(1)).alias("c"))
    if stored is None:
        both = added.withColumn("n", F.lit(0))
    else:
        before = stored.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("n"))
        both = added.join(before, F.col(key) == F.col("_k"), "left").withColumn("n", F.coalesce("n", F.lit(0)))
    known, n, c = F.col(key).isNotNull(), F.col("n"), F.col("c")
    return both.agg(
        F.count_if(known & (n < 2) & (n + c > 1)).alias(f"{key}:duplicate_keys"),
        F.coalesce(F.sum(F.when(known, F.when(n > 0, c).otherwise(c - 1))), F.lit(0)).alias(f"{key}:surplus_rows"),
        F.coalesce(F.sum(F.when(~known, c)), F.lit(0)).alias(f"{key}:null_keys"))


def summed_changes(changes: DataFrame, table: str) -> DataFrame:
    """The check rows of ``key_violations`` from all changes since the table was empty."""
    return _unpivot(changes.agg(*[F.coalesce(F.sum(f"`{c}`"), F.lit(0)).alias(c) for c in changes.columns]), table)


def foreign_key_violations(rated: DataFrame, rate_plans: DataFrame,
                           rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Q02: rated records whose plan id is not in the plan catalogue."""
    plans = broadcast_if_small(rate_plans.select("rate_plan_id"))
    return (rated.filter(F.col("rate_plan_id").isNotNull())
            .join(plans, "rate_plan_id", "left_anti")
            .select("record_id", "rate_plan_id", "rating_status"))


def count_checks(df: DataFrame, table: str, checks: Mapping[str, Column]) -> DataFrame:
    """Rows violating each named condition (a NULL condition is not a violation)."""
    agg = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])
    return _unpivot(agg, table)


def not_in(col: str, values: Sequence[str]) -> Column:
    return F.col(col).isNotNull() & ~F.col(col).isin(*values)


def too_long(col: str, n: int) -> Column:
    return F.length(col) > n


def domain_checks(rules: Rules = DEFAULT_RULES) -> dict[str, dict[str, Column]]:
    """Q03: value domains and text widths per table."""
    return {
        "normalized_records": {
            "record_type:domain": not_in("record_type", rules.record_types),
            "record_id:width": too_long("record_id", 50),
            "record_type:width": too_long("record_type", 20),
            "msisdn:width": too_long("msisdn", 15),
            "secondary_msisdn:width": too_long("secondary_msisdn", 15),
            "cell_id:width": too_long("cell_id", 50),
            "technology:width": too_long("technology", 10),
            "status:width": too_long("status", 20),
        },
        "customers": {
            "region:domain": not_in("region", ("rural", "urban")),
            "msisdn:width": too_long("msisdn", 15),
            "customer_name:width": too_long("customer_name", 100),
            "subscription_type:width": too_long("subscription_type", 20),
            "status:width": too_long("status", 20),
            "region:width": too_long("region", 50),
        },
        "rate_plans": {
            "plan_name:width": too_long("plan_name", 100),
            "service_type:width": too_long("service_type", 20),
        },
        "rated_records": {
            "rating_status:domain": not_in("rating_status", ("rated", "unmatched", "rejected", "error")),
            "record_id:width": too_long("record_id", 50),
            "record_type:width": too_long("record_type", 20),
            "msisdn:width": too_long("msisdn", 15),
            "secondary_msisdn:width": too_long("secondary_msisdn", 15),
            "cell_id:width": too_long("cell_id", 50),
            "technology:width": too_long("technology", 10),
            "rating_status:width": too_long("rating_status", 20),
        },
        "invoices": {
            "status:domain": not_in("status", ("pending", "paid", "failed")),
            "region:domain": not_in("region", ("rural", "urban")),
            "invoice_id:width": too_long("invoice_id", 50),
            "msisdn:width": too_long("msisdn", 15),
            "customer_name:width": too_long("customer_name", 100),
            "status:width": too_long("status", 20),
            "region:width": too_long("region", 50),
        },
    }


def not_null_checks() -> dict[str, Column]:
    """Q04: mandatory invoice columns."""
    return {f"{c}:not_null": F.col(c).isNull()
            for c in ("msisdn", "billing_period_start", "billing_period_end", "invoice_date")}
