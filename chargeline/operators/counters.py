"""Stage counters (A04/A08): record counts per pipeline stage.

As a query, each stage's DataFrame is aggregated once with conditional counts.
Inside write jobs the same numbers come from ``DataFrame.observe`` on the data
being written, which costs no extra pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _rows(agg: DataFrame) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("stage"), F.col(c).cast("bigint").alias("records"))
                      for c in agg.columns])
    return agg.select(F.inline(pairs))


def mediation_counts(mediated: DataFrame) -> DataFrame:
    return _rows(mediated.agg(
        F.count(F.lit(1)).alias("mediation_in"),
        F.count_if(F.col("status") == "valid").alias("mediation_valid"),
        F.count_if(F.col("status") == "error").alias("mediation_error")))


def rating_counts(rated: DataFrame) -> DataFrame:
    s = F.col("rating_status")
    return _rows(rated.agg(
        F.count(F.lit(1)).alias("rating_out"),
        F.count_if(s == "rated").alias("rating_rated"),
        F.count_if(s == "rejected").alias("rating_rejected"),
        F.count_if(s == "unmatched").alias("rating_unmatched")))


def billing_counts(invoices: DataFrame) -> DataFrame:
    return _rows(invoices.agg(
        F.count(F.lit(1)).alias("invoices"),
        F.count_if(F.col("student")).alias("invoices_student"),
        F.count_if(F.col("region") == "urban").alias("invoices_urban")))


def stage_counts(mediated: DataFrame, rated: DataFrame, invoices: DataFrame) -> DataFrame:
    return mediation_counts(mediated).unionByName(rating_counts(rated)).unionByName(billing_counts(invoices))
