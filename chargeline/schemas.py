"""Declared record layouts."""

from pyspark.sql.types import (BooleanType, DateType, DoubleType, IntegerType, StringType,
                               StructField, StructType, TimestampNTZType)

# Raw usage message as it arrives on the wire (JSON text).
USAGE_RAW = StructType([
    StructField("record_id", StringType()),
    StructField("record_type", StringType()),
    StructField("timestamp", StringType()),
    StructField("caller_id", StringType()),
    StructField("callee_id", StringType()),
    StructField("sender_id", StringType()),
    StructField("receiver_id", StringType()),
    StructField("user_id", StringType()),
    StructField("duration_sec", IntegerType()),
    StructField("data_volume_mb", DoubleType()),
    StructField("session_duration_sec", IntegerType()),
    StructField("cell_id", StringType()),
    StructField("technology", StringType()),
])

NORMALIZED = StructType([
    StructField("record_id", StringType()),
    StructField("record_type", StringType()),
    StructField("timestamp", TimestampNTZType()),
    StructField("msisdn", StringType()),
    StructField("secondary_msisdn", StringType()),
    StructField("duration_sec", DoubleType()),
    StructField("data_volume_mb", DoubleType()),
    StructField("cell_id", StringType()),
    StructField("technology", StringType()),
    StructField("status", StringType()),
])

CUSTOMERS = StructType([
    StructField("msisdn", StringType()),
    StructField("customer_name", StringType()),
    StructField("subscription_type", StringType()),
    StructField("rate_plan_id", IntegerType()),
    StructField("activation_date", DateType()),
    StructField("status", StringType()),
    StructField("region", StringType()),
    StructField("student", BooleanType()),
])

RATE_PLANS = StructType([
    StructField("rate_plan_id", IntegerType()),
    StructField("plan_name", StringType()),
    StructField("service_type", StringType()),
    StructField("unit_price", DoubleType()),
    StructField("free_units", IntegerType()),
    StructField("tiered_threshold_mb", DoubleType()),
    StructField("tiered_price_mb", DoubleType()),
])

RATED_COLUMNS = ["record_id", "record_type", "timestamp", "msisdn", "secondary_msisdn",
                 "duration_sec", "data_volume_mb", "cell_id", "technology", "cost",
                 "rate_plan_id", "rating_status", "billing_month"]

INVOICE_COLUMNS = ["invoice_id", "msisdn", "customer_name", "billing_period_start",
                   "billing_period_end", "voice_cost", "sms_cost", "data_cost", "voice_usage",
                   "sms_usage", "data_usage", "total_cost", "invoice_date", "status", "region",
                   "student"]

__all__ = ["USAGE_RAW", "NORMALIZED", "CUSTOMERS", "RATE_PLANS", "RATED_COLUMNS",
           "INVOICE_COLUMNS"]
