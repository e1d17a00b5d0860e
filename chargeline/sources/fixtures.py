"""Billing-domain inputs derived from the shared lake tables.

``customer`` becomes the subscriber dimension, ``events`` the usage stream, and
the six rate plans are a literal dimension. The projections are kept as SQL
expression text because the same text feeds Spark (``selectExpr``) and the
DuckDB oracle, so both engines start from identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chargeline.functions.columns import ntz_text
from chargeline.schemas import RATE_PLANS
from chargeline.sources.tables import read_table

CUSTOMER_EXPRS = [
    "concat('+212', lpad(cast(c_custkey as varchar(20)), 9, '0')) AS msisdn",
    "c_name AS customer_name",
    "'postpaid' AS subscription_type",
    "cast(CASE WHEN c_custkey % 97 = 5 THEN NULL WHEN c_custkey % 89 = 1 THEN 99 "
    "ELSE 1 + c_custkey % 6 END as int) AS rate_plan_id",
    "date '2019-01-01' + cast((c_custkey * 37) % 1825 as int) AS activation_date",
    "CASE WHEN c_custkey % 10 IN (3, 6, 9) THEN 'suspended' ELSE 'active' END AS status",
    "CASE WHEN c_custkey % 20 < 13 THEN 'urban' ELSE 'rural' END AS region",
    "c_custkey % 20 IN (0, 7, 14) AS student",
]

USAGE_EXPRS = [
    "concat('r-', cast(event_id as varchar(20))) AS record_id",
    "ts",
    "CASE WHEN event_type = 'error' AND event_id % 11 = 0 THEN 'unknown' "
    "WHEN event_type = 'error' AND event_id % 11 = 1 THEN NULL "
    "WHEN user_id % 30 IN (1, 4) AND event_id % 16 <> 0 THEN 'voice' "
    "WHEN event_type = 'signup' THEN CASE event_id % 3 WHEN 0 THEN 'voice' WHEN 1 THEN 'sms' ELSE 'data' END "
    "ELSE CASE user_id % 3 WHEN 0 THEN 'voice' WHEN 1 THEN 'sms' ELSE 'data' END END AS record_type",
    "CASE WHEN event_type = 'error' AND event_id % 13 = 0 THEN NULL "
    "WHEN event_type = 'error' AND event_id % 13 = 1 THEN '999000000001' "
    "WHEN event_id % 50 = 14 THEN '+999000000001' "
    "WHEN event_id % 50 = 7 THEN '+212999999999' "
    "ELSE concat('+212', lpad(cast(user_id as varchar(20)), 9, '0')) END AS party",
    "CASE WHEN event_id % 17 = 0 THEN NULL "
    "ELSE concat(CASE WHEN event_id % 9 = 0 THEN '+33' ELSE '+212' END, "
    "lpad(cast((user_id * 7 + event_id) % 1500 as varchar(20)), 9, '0')) END AS counterpart",
    "CASE WHEN event_type = 'error' AND event_id % 7 = 0 THEN NULL "
    "WHEN event_type = 'error' AND event_id % 7 = 1 THEN -1 ELSE 1 END "
    "* CASE WHEN user_id % 30 = 0 THEN 10 + (event_id * 7919) % 91 "
    "ELSE 200 + (event_id * 7919) % 1801 END AS secs",
    "CASE WHEN event_type = 'error' AND event_id % 7 = 2 THEN NULL "
    "WHEN event_type = 'error' AND event_id % 7 = 3 THEN -1 ELSE 1 END "
    "* CASE WHEN user_id % 30 IN (2, 5) THEN CASE WHEN event_id % 8 = 0 THEN 0.5E0 ELSE 0.0E0 END "
    "ELSE (10000 + (event_id * 104729) % 990000) / 100.0E0 END AS mb",
    "CASE WHEN event_id % 10 = 0 THEN CASE event_id % 30 WHEN 0 THEN 'PARIS' WHEN 10 THEN 'TOULOUSE' "
    "ELSE 'NEW YORK' END "
    "ELSE CASE event_id % 3 WHEN 0 THEN 'RABAT' WHEN 1 THEN 'FES' ELSE 'AGADIR' END END AS cell_id",
    "CASE event_id % 4 WHEN 0 THEN '2G' WHEN 1 THEN '3G' WHEN 2 THEN '4G' ELSE '5G' END AS technology",
]

# Volume fixture: order lines as usage (o_custkey is the subscriber). The key
# (l_orderkey, l_linenumber) is not unique in the source, so this stream has
# natural duplicates that differ in their other columns.
ORDERS_USAGE_EXPRS = [
    "concat('o-', cast(l_orderkey as varchar(20)), '-', cast(l_linenumber as varchar(20))) AS record_id",
    None,  # ts: dialect-specific, see ORDERS_TS_SPARK / the oracle
    "CASE l_linenumber % 3 WHEN 0 THEN 'voice' WHEN 1 THEN 'sms' ELSE 'data' END AS record_type",
    "concat('+212', lpad(cast(o_custkey as varchar(20)), 9, '0')) AS party",
    "concat('+212', lpad(cast(l_suppkey as varchar(20)), 9, '0')) AS counterpart",
    "cast(l_quantity as bigint) * 37 AS secs",
    "l_extendedprice / 10 AS mb",
    "CASE WHEN l_partkey % 10 = 0 THEN CASE l_partkey % 30 WHEN 0 THEN 'PARIS' WHEN 10 THEN 'TOULOUSE' "
    "ELSE 'NEW YORK' END "
    "ELSE CASE l_partkey % 3 WHEN 0 THEN 'RABAT' WHEN 1 THEN 'FES' ELSE 'AGADIR' END END AS cell_id",
    "CASE l_suppkey % 4 WHEN 0 THEN '2G' WHEN 1 THEN '3G' WHEN 2 THEN '4G' ELSE '5G' END AS technology",
]
ORDERS_TS_SPARK = ("l_shipdate + make_dt_interval(0, cast((l_partkey * 7 + l_linenumber * 5) % 24 as int), "
                   "cast((l_suppkey * 13) % 60 as int), 0) AS ts")

# Every fifth record of the billing fixture comes without an event time.
NO_TIME_TS = "CASE WHEN event_id % 5 = 0 THEN NULL ELSE ts END AS ts"
NO_TIME_USAGE_EXPRS = [NO_TIME_TS if e == "ts" else e for e in USAGE_EXPRS]

# FIXED VALUES: the rate-plan catalogue (id, plan, service, unit price,
# free units, tier threshold MB, tier price per MB).
RATE_PLAN_ROWS = [
    (1, "Standard Plan", "voice", 0.01, 2, None, None),
    (2, "Standard Plan", "sms", 0.05, 5, None, None),
    (3, "Standard Plan", "data", 0.05, 0, 10.0, 0.10),
    (4, "Premium Plan", "voice", 0.08, 4, None, None),
    (5, "Premium Plan", "sms", 0.05, 6, None, None),
    (6, "Premium Plan", "data", 0.04, 0, 20.0, 0.08),
]


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer").selectExpr(*CUSTOMER_EXPRS)


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def rate_plans(spark: SparkSession) -> DataFrame:
    """The catalogue as an inline literal relation (a stable logical plan; no
    driver-side RDD), built from one SQL expression."""
    rows = ", ".join(
        "named_struct(" + ", ".join(f"'{f.name}', CAST({_sql_literal(v)} AS {f.dataType.simpleString()})"
                                   for v, f in zip(r, RATE_PLANS.fields)) + ")"
        for r in RATE_PLAN_ROWS)
    return spark.range(1).selectExpr(f"inline(array({rows}))")


def usage(spark: SparkSession, sf_dir: str, source: str = "events") -> DataFrame:
    """Typed usage: record_id, ts, record_type, party, counterpart, secs, mb, cell_id, technology.

    ``source="events"`` is the billing fixture, ``"events_no_time"`` the same with
    event times missing; ``source="orders"`` the volume fixture (line items
    joined with their orders on the order key).
    """
    if source == "orders":
        lines = read_table(spark, sf_dir, "lineitem")
        orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey, "inner")
        exprs = [ORDERS_TS_SPARK if e is None else e for e in ORDERS_USAGE_EXPRS]
        return joined.selectExpr(*exprs)
    exprs = NO_TIME_USAGE_EXPRS if source == "events_no_time" else USAGE_EXPRS
    return read_table(spark, sf_dir, "events").selectExpr(*exprs)


def usage_raw(typed: DataFrame, timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Route typed usage into the wire layout: the subscriber lands in caller_id
    (voice), sender_id (sms) or user_id (data, unknown or missing type); the
    counterpart in callee_id / receiver_id; seconds in duration_sec (voice) or
    session_duration_sec (data); volume only on data records."""
    rt = F.col("record_type")
    voice, sms, data = rt == "voice", rt == "sms", rt == "data"
    other = ~F.coalesce(rt.isin("voice", "sms"), F.lit(False))
    return typed.select(
        "record_id",
        "record_type",
        (ntz_text("ts") if timestamp_format == "yyyy-MM-dd HH:mm:ss"
         else F.date_format("ts", timestamp_format)).alias("timestamp"),
        F.when(voice, F.col("party")).alias("caller_id"),
        F.when(voice, F.col("counterpart")).alias("callee_id"),
        F.when(sms, F.col("party")).alias("sender_id"),
        F.when(sms, F.col("counterpart")).alias("receiver_id"),
        F.when(other, F.col("party")).alias("user_id"),
        F.when(voice, F.col("secs")).cast("int").alias("duration_sec"),
        F.when(data, F.col("mb")).cast("double").alias("data_volume_mb"),
        F.when(data, F.col("secs")).cast("int").alias("session_duration_sec"),
        "cell_id",
        "technology",
    )


def raw_usage(spark: SparkSession, sf_dir: str, source: str = "events") -> DataFrame:
    return usage_raw(usage(spark, sf_dir, source))
