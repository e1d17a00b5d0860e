"""Independent SQL formulation of every registered query, for DuckDB.

The chain is written as named CTEs (customers -> usage -> normalized ->
mediated -> rated -> billing) and each query selects from them. Only the
fixture projections are shared text with the Spark side (both engines must
start from identical rows); every rule is re-stated here in SQL.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from chargeline.rules import DEFAULT_RULES, Rules
from chargeline.sources.fixtures import (CUSTOMER_EXPRS, NO_TIME_USAGE_EXPRS, ORDERS_USAGE_EXPRS, RATE_PLAN_ROWS,
                                        USAGE_EXPRS)


def dbl(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def ts(v) -> str:
    return f"TIMESTAMP '{v.strftime('%Y-%m-%d %H:%M:%S')}'"


def strs(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _plans_values() -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return f"'{v}'"
        return repr(v)
    rows = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in RATE_PLAN_ROWS)
    return (
        "SELECT CAST(a AS INTEGER) AS rate_plan_id, b AS plan_name, c AS service_type, "
        "CAST(d AS DOUBLE) AS unit_price, CAST(e AS INTEGER) AS free_units, "
        "CAST(f AS DOUBLE) AS tiered_threshold_mb, CAST(g AS DOUBLE) AS tiered_price_mb "
        f"FROM (VALUES {rows}) AS t(a, b, c, d, e, f, g)")


def round_half_up(expr: str, scale: int) -> str:
    """Spark's round(double): half-up on the value's shortest decimal text."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18)), {scale}) AS DOUBLE)"


ORDERS_TS_DUCKDB = ("l_shipdate + to_hours(CAST((l_partkey * 7 + l_linenumber * 5) % 24 AS BIGINT)) "
                    "+ to_minutes(CAST((l_suppkey * 13) % 60 AS BIGINT)) AS ts")


def usage_sql(source: str) -> str:
    if source == "orders":
        exprs = [ORDERS_TS_DUCKDB if e is None else e for e in ORDERS_USAGE_EXPRS]
        return (f"SELECT {', '.join(exprs)} FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
    exprs = NO_TIME_USAGE_EXPRS if source == "events_no_time" else USAGE_EXPRS
    return f"SELECT {', '.join(exprs)} FROM events"


def base_ctes(r: Rules = DEFAULT_RULES, source: str = "events") -> str:
    roam = strs(r.roaming_cells)
    types = strs(r.record_types)
    prefixes = " OR ".join(f"starts_with(msisdn, '{p}')" for p in r.invalid_msisdn_prefixes)
    end_cmp = "<=" if r.inclusive_period_end else "<"
    seasonal = r.as_of.month == r.seasonal_month
    zero = "CAST(0 AS DOUBLE)"
    return f"""
customers AS (SELECT {", ".join(CUSTOMER_EXPRS)} FROM customer),
rate_plans AS ({_plans_values()}),
usage AS ({usage_sql(source)}),
raw_usage AS (
  SELECT record_id, record_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp",
         CASE WHEN record_type = 'voice' THEN party END AS caller_id,
         CASE WHEN record_type = 'voice' THEN counterpart END AS callee_id,
         CASE WHEN record_type = 'sms' THEN party END AS sender_id,
         CASE WHEN record_type = 'sms' THEN counterpart END AS receiver_id,
         CASE WHEN NOT coalesce(record_type IN ('voice', 'sms'), false) THEN party END AS user_id,
         CAST(CASE WHEN record_type = 'voice' THEN secs END AS INTEGER) AS duration_sec,
         CAST(CASE WHEN record_type = 'data' THEN mb END AS DOUBLE) AS data_volume_mb,
         CAST(CASE WHEN record_type = 'data' THEN secs END AS INTEGER) AS session_duration_sec,
         cell_id, technology
  FROM usage),
normalized AS (
  SELECT record_id, record_type, date_trunc('second', ts) AS "timestamp", party AS msisdn,
         CASE WHEN record_type IN ('voice', 'sms') THEN counterpart END AS secondary_msisdn,
         CAST(CAST(CASE WHEN record_type IN ('voice', 'data') THEN secs END AS INTEGER) AS DOUBLE) AS duration_sec,
         CASE WHEN record_type = 'data' THEN CAST(mb AS DOUBLE) END AS data_volume_mb,
         cell_id, technology
  FROM usage),
mediated AS (
  SELECT record_id, record_type, "timestamp", msisdn, secondary_msisdn, duration_sec, data_volume_mb,
         cell_id, technology,
         CASE WHEN record_id IS NULL OR msisdn IS NULL OR ({prefixes})
                   OR (duration_sec IS NOT NULL AND duration_sec < 0)
                   OR (data_volume_mb IS NOT NULL AND data_volume_mb < 0)
                   OR NOT (record_type IN ({types}))
              THEN 'error' ELSE 'valid' END AS status
  FROM normalized),
valid AS (SELECT * FROM mediated WHERE status = 'valid'),
valid_unique AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY "timestamp" NULLS FIRST,
           record_type NULLS FIRST, msisdn NULLS FIRST, secondary_msisdn NULLS FIRST,
           duration_sec NULLS FIRST, data_volume_mb NULLS FIRST, cell_id NULLS FIRST,
           technology NULLS FIRST) AS rn
    FROM valid) WHERE rn = 1),
enriched AS (
  SELECT v.record_id, v.record_type, coalesce(v."timestamp", {ts(r.as_of)}) AS "timestamp", v.msisdn,
         v.secondary_msisdn, v.duration_sec, v.data_volume_mb, v.cell_id, v.technology,
         c.rate_plan_id AS customer_rate_plan_id, c.status AS customer_status, c.region, c.student,
         c.activation_date, p.plan_name, p.unit_price
  FROM valid_unique v
  LEFT JOIN customers c ON v.msisdn = c.msisdn
  LEFT JOIN rate_plans p ON c.rate_plan_id = p.rate_plan_id AND v.record_type = p.service_type),
status1 AS (
  SELECT *,
         CASE WHEN customer_status IS NULL THEN 'unmatched'
              WHEN customer_status <> 'active' THEN 'rejected'
              WHEN customer_rate_plan_id IS NULL THEN 'unmatched'
              ELSE 'rated' END AS first_status,
         CASE WHEN record_type IN ({strs(r.premium_services)}) AND cell_id IN ({roam})
              THEN 'premium' ELSE 'any' END AS required_rate_plan_type
  FROM enriched),
status2 AS (
  SELECT *,
         CASE WHEN first_status = 'rated' AND required_rate_plan_type = 'premium'
                   AND NOT contains(plan_name, '{r.premium_marker}') THEN 'rejected'
              WHEN first_status = 'rated' AND unit_price IS NULL THEN 'unmatched'
              ELSE first_status END AS rating_status
  FROM status1),
cost0 AS (
  SELECT *,
         CASE WHEN rating_status = 'rated' AND record_type = 'voice' THEN
                   CASE WHEN duration_sec IS NULL OR duration_sec <= 0 THEN {zero} ELSE duration_sec * unit_price END
              WHEN rating_status = 'rated' AND record_type = 'data' THEN
                   CASE WHEN data_volume_mb IS NULL OR data_volume_mb <= 0 THEN {zero} ELSE data_volume_mb * unit_price END
              ELSE {zero} END AS base_cost
  FROM status2),
cost1 AS (
  SELECT *,
         CASE WHEN record_type = 'voice' AND base_cost > 0
                   AND hour("timestamp") BETWEEN {r.evening_hours[0]} AND {r.evening_hours[1]}
                   THEN base_cost * {dbl(r.evening_factor)}
              WHEN record_type = 'voice' AND base_cost > 0
                   AND hour("timestamp") BETWEEN {r.morning_hours[0]} AND {r.morning_hours[1]}
                   THEN base_cost * {dbl(r.morning_factor)}
              ELSE base_cost END AS cost_time_of_day
  FROM cost0),
cost2 AS (
  SELECT *,
         CASE WHEN record_type = 'voice' AND cost_time_of_day > 0 AND strftime("timestamp", '%A') = 'Friday'
              THEN cost_time_of_day * {dbl(r.friday_factor)} ELSE cost_time_of_day END AS cost_friday
  FROM cost1),
priced AS (
  SELECT *,
         CASE WHEN cost_friday > 0 AND cell_id IN ({roam}) THEN cost_friday * {dbl(r.roaming_factor)}
              ELSE cost_friday END AS cost
  FROM cost2),
rated AS (
  SELECT record_id, record_type, "timestamp", msisdn, secondary_msisdn, duration_sec, data_volume_mb,
         cell_id, technology, cost, customer_rate_plan_id AS rate_plan_id, rating_status,
         CAST(date_trunc('month', "timestamp") AS DATE) AS billing_month
  FROM priced)
""" + ",\n" + billing_ctes(r)



def billing_ctes(r: Rules = DEFAULT_RULES, p: str = "") -> str:
    """Billing CTEs for one run (period, as_of); ``p`` prefixes the CTE names
    so several runs can live in one statement."""
    end_cmp = "<=" if r.inclusive_period_end else "<"
    seasonal = r.as_of.month == r.seasonal_month
    zero = "CAST(0 AS DOUBLE)"
    return f"""
{p}totals AS (
  SELECT msisdn,
         CAST(sum(CAST(CASE WHEN record_type = 'voice' THEN cost ELSE {zero} END AS DECIMAL(28,12))) AS DOUBLE) AS voice_cost_rated,
         CAST(sum(CAST(CASE WHEN record_type = 'sms' THEN cost ELSE {zero} END AS DECIMAL(28,12))) AS DOUBLE) AS sms_cost_rated,
         CAST(sum(CAST(CASE WHEN record_type = 'data' THEN cost ELSE {zero} END AS DECIMAL(28,12))) AS DOUBLE) AS data_cost_rated,
         sum(CASE WHEN record_type = 'voice' THEN CAST(ceil(duration_sec / CAST(60 AS DOUBLE)) AS DOUBLE) ELSE {zero} END) AS voice_usage_minutes,
         count(CASE WHEN record_type = 'sms' THEN 1 END) AS sms_usage_count,
         sum(CASE WHEN record_type = 'data' THEN CAST(ceil(data_volume_mb) AS DOUBLE) ELSE {zero} END) AS data_usage_mb
  FROM rated
  WHERE rating_status = 'rated' AND "timestamp" >= {ts(r.period_start)} AND "timestamp" {end_cmp} {ts(r.period_end)}
  GROUP BY msisdn),
{p}billed AS (
  SELECT t.*, c.customer_name, c.rate_plan_id, c.student, c.region, c.activation_date,
         CAST(date_diff('day', c.activation_date, CAST({ts(r.as_of)} AS DATE)) AS DOUBLE) / {dbl(r.days_per_month)} AS loyalty_months,
         CASE WHEN p.service_type = 'voice' THEN p.free_units END AS voice_free_minutes,
         CASE WHEN p.service_type = 'sms' THEN p.free_units END AS sms_free_units,
         CASE WHEN p.service_type = 'sms' THEN p.unit_price END AS sms_unit_price,
         CASE WHEN p.service_type = 'data' THEN p.unit_price END AS data_unit_price,
         CASE WHEN p.service_type = 'data' THEN p.tiered_threshold_mb END AS data_threshold_mb,
         CASE WHEN p.service_type = 'data' THEN p.tiered_price_mb END AS data_tiered_price
  FROM {p}totals t JOIN customers c ON t.msisdn = c.msisdn
  LEFT JOIN rate_plans p ON c.rate_plan_id = p.rate_plan_id),
{p}billable AS (
  SELECT *,
         CASE WHEN voice_usage_minutes > voice_free_minutes THEN voice_usage_minutes - voice_free_minutes
              ELSE {zero} END AS voice_billable_minutes
  FROM {p}billed),
{p}svc AS (
  SELECT *,
         coalesce(CASE WHEN voice_billable_minutes > 0 AND voice_usage_minutes > 0
                       THEN voice_cost_rated * (voice_billable_minutes / voice_usage_minutes) ELSE {zero} END, {zero}) AS voice_cost0,
         coalesce(CASE WHEN sms_usage_count > sms_free_units
                       THEN (sms_usage_count - sms_free_units) * sms_unit_price ELSE {zero} END, {zero}) AS sms_cost,
         coalesce(CASE WHEN data_usage_mb <= data_threshold_mb THEN data_cost_rated
                       ELSE data_threshold_mb * data_unit_price + (data_usage_mb - data_threshold_mb) * data_tiered_price END, {zero}) AS data_cost0
  FROM {p}billable),
{p}svc2 AS (
  SELECT *, voice_cost0 + sms_cost + data_cost0 AS subtotal_before_discounts,
         CASE WHEN voice_usage_minutes >= {dbl(r.voice_threshold_minutes)} THEN voice_cost0 * {dbl(r.voice_discount_factor)}
              ELSE voice_cost0 END AS voice_cost,
         CASE WHEN data_usage_mb >= {dbl(r.data_threshold_mb)} THEN data_cost0 * {dbl(r.data_discount_factor)}
              ELSE data_cost0 END AS data_cost
  FROM {p}svc),
{p}disc AS (
  SELECT *,
         voice_cost + sms_cost + data_cost AS net_after_usage_discounts,
         CASE WHEN subtotal_before_discounts >= {dbl(r.spend_threshold)}
              THEN subtotal_before_discounts * {dbl(r.spend_discount_rate)} ELSE {zero} END AS total_spending_discount,
         CASE WHEN coalesce(student, false) THEN (voice_cost + sms_cost + data_cost) * {dbl(r.student_discount_rate)}
              ELSE {zero} END AS student_discount,
         CASE WHEN region = 'urban' THEN (voice_cost + sms_cost + data_cost) * {dbl(r.urban_discount_rate)}
              ELSE {zero} END AS urban_discount,
         CASE WHEN loyalty_months >= {dbl(r.loyalty_min_months)} THEN
                   CASE WHEN loyalty_months / 12 * {dbl(r.loyalty_rate_per_year)} > {dbl(r.loyalty_max_rate)}
                        THEN {dbl(r.loyalty_max_rate)} ELSE loyalty_months / 12 * {dbl(r.loyalty_rate_per_year)} END
              ELSE {zero} END AS loyalty_discount_rate
  FROM {p}svc2),
{p}disc2 AS (
  SELECT *,
         (voice_cost + sms_cost + data_cost) * loyalty_discount_rate AS loyalty_discount,
         {"(voice_cost + sms_cost + data_cost) * " + dbl(r.seasonal_rate) if seasonal else zero} AS seasonal_discount
  FROM {p}disc),
{p}disc3 AS (
  SELECT *,
         voice_cost + sms_cost + data_cost - total_spending_discount - student_discount - urban_discount
           - loyalty_discount - seasonal_discount AS total_cost_after_discounts,
         CASE WHEN coalesce(student, false) THEN {zero} ELSE {dbl(r.regulatory_fee)} END AS regulatory_fee
  FROM {p}disc2),
{p}disc4 AS (SELECT *, total_cost_after_discounts + regulatory_fee AS subtotal_with_fees FROM {p}disc3),
{p}disc5 AS (SELECT *, subtotal_with_fees * {dbl(r.vat_rate)} AS vat_amount FROM {p}disc4),
{p}breakdown AS (SELECT *, subtotal_with_fees + vat_amount AS total_cost FROM {p}disc5),
{p}invoices AS (
  SELECT md5(concat(msisdn, '-{r.period_start.strftime('%Y-%m-%d')}')) AS invoice_id,
         msisdn, customer_name,
         {ts(r.period_start)} AS billing_period_start, {ts(r.period_end)} AS billing_period_end,
         coalesce({round_half_up("voice_cost", r.money_scale)}, {zero}) AS voice_cost,
         coalesce({round_half_up("sms_cost", r.money_scale)}, {zero}) AS sms_cost,
         coalesce({round_half_up("data_cost", r.money_scale)}, {zero}) AS data_cost,
         coalesce({round_half_up("voice_usage_minutes", r.money_scale)}, {zero}) AS voice_usage,
         coalesce(sms_usage_count, 0) AS sms_usage,
         coalesce({round_half_up("data_usage_mb", r.money_scale)}, {zero}) AS data_usage,
         coalesce({round_half_up("total_cost", r.money_scale)}, {zero}) AS total_cost,
         {ts(r.as_of)} AS invoice_date, '{r.invoice_status}' AS status, region, student
  FROM {p}breakdown)"""

def money(expr: str, scale: int = 2) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(18,6)), {scale}) AS DECIMAL(18,{scale}))"


def with_base(select: str, r: Rules = DEFAULT_RULES, extra: str = "", source: str = "events") -> str:
    ctes = base_ctes(r, source).strip()
    if extra:
        ctes += ",\n" + extra.strip()
    return "WITH " + ctes + "\n" + select


def revenue_aggs(amount: str, count_name: str) -> str:
    return (f"CAST(round(sum(CAST({amount} AS DECIMAL(18,6))), 2) AS DECIMAL(18,2)) AS total_revenue, "
            f"count(*) AS {count_name}, "
            f"{money(f'CAST(sum(CAST({amount} AS DECIMAL(18,6))) AS DOUBLE) / count(*)')} AS avg_revenue_per_customer")


ORACLE: dict[str, str] = {}

# Damage done to messages: cut short (no field survives), event time impossible or of another form, text for seconds.
_DAMAGED = """
damaged AS (
  SELECT * REPLACE (
    CASE WHEN kind IN (1, 2) THEN NULL ELSE "timestamp" END AS "timestamp",
    CASE WHEN kind = 3 AND record_type = 'voice' THEN NULL ELSE duration_sec END AS duration_sec)
  FROM (SELECT *, CAST(substr(record_id, 3) AS BIGINT) % 7 AS kind FROM normalized)
  WHERE kind <> 0
  UNION ALL
  SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 0
  FROM normalized WHERE CAST(substr(record_id, 3) AS BIGINT) % 7 = 0)
"""

# Subscribers as loaded: the table's defaults where the input has none.
_LOADED_CUSTOMERS = """customers AS (
  SELECT msisdn, customer_name, CASE WHEN n % 4 <> 1 THEN subscription_type ELSE 'postpaid' END AS subscription_type,
         rate_plan_id, activation_date, CASE WHEN n % 5 <> 2 THEN status ELSE 'active' END AS status, region,
         CASE WHEN n % 3 <> 0 THEN student ELSE false END AS student
  FROM (SELECT *, CAST(substr(msisdn, 5) AS BIGINT) AS n FROM given_customers)),
rate_plans AS ("""


def oracle(name: str, select: str, r: Rules = DEFAULT_RULES, extra: str = "",
           source: str = "events") -> None:
    ORACLE[name] = with_base(select, r, extra, source)


oracle("report_revenue_by_region",
       f"SELECT region, {revenue_aggs('total_cost', 'customer_count')} FROM invoices GROUP BY region "
       "ORDER BY total_revenue DESC, region")


NORM_COLS = ('record_id, record_type, "timestamp", msisdn, secondary_msisdn, duration_sec, '
             'data_volume_mb, cell_id, technology')
RATED_COLS = (NORM_COLS + ', cost, rate_plan_id, rating_status, billing_month')

oracle("mediate_json_parse", f"SELECT {NORM_COLS}, 'valid' AS status FROM normalized")
oracle("mediate_normalize", f"SELECT {NORM_COLS}, 'valid' AS status FROM normalized")
oracle("mediate_validate", "SELECT * FROM mediated")
oracle("mediate_damaged_messages", f"""SELECT {NORM_COLS},
  CASE WHEN record_id IS NULL OR msisdn IS NULL OR starts_with(msisdn, '999')
            OR coalesce(duration_sec, 0) < 0 OR coalesce(data_volume_mb, 0) < 0
            OR record_type NOT IN ('voice', 'sms', 'data') THEN 'error' ELSE 'valid' END AS status
  FROM damaged""", extra=_DAMAGED)
oracle("mediate_status_counts", "SELECT status, count(*) AS records FROM mediated GROUP BY status")
oracle("mediate_valid_dedup", "SELECT * FROM valid_unique")
oracle("mediate_dead_letters", "SELECT * FROM mediated WHERE status = 'error'")

oracle("rating_new_records", f"SELECT {RATED_COLS} FROM rated WHERE \"timestamp\" >= TIMESTAMP '2024-01-16 00:00:00'")
oracle("rating_enriched",
       'SELECT record_id, record_type, "timestamp", CAST(date_trunc(\'month\', "timestamp") AS DATE) AS billing_month, '
       "msisdn, customer_rate_plan_id, customer_status, region, student, activation_date, plan_name, unit_price "
       "FROM enriched")
oracle("rating_status", "SELECT record_id, required_rate_plan_type, rating_status FROM priced")
oracle("rating_status_counts", "SELECT rating_status, count(*) AS records FROM rated GROUP BY rating_status")
oracle("rating_base_cost", "SELECT record_id, rating_status, base_cost FROM priced")
oracle("rating_time_of_day", "SELECT record_id, cost_time_of_day FROM priced")
oracle("rating_friday", "SELECT record_id, cost_friday FROM priced")
oracle("rating_roaming", "SELECT record_id, cost FROM priced")
oracle("rated_records", f"SELECT {RATED_COLS} FROM rated")

oracle("billing_usage", "SELECT * FROM totals")
oracle("billing_voice", "SELECT msisdn, voice_usage_minutes, voice_free_minutes, voice_billable_minutes, "
       "voice_cost_rated, voice_cost0 AS voice_cost FROM svc")
oracle("billing_sms", "SELECT msisdn, sms_usage_count, sms_free_units, sms_unit_price, sms_cost FROM svc")
oracle("billing_data", "SELECT msisdn, data_usage_mb, data_threshold_mb, data_cost_rated, data_cost0 AS data_cost FROM svc")
oracle("billing_discounts",
       "SELECT msisdn, loyalty_months, subtotal_before_discounts, voice_cost, sms_cost, data_cost, "
       "total_spending_discount, student_discount, urban_discount, loyalty_discount_rate, loyalty_discount, "
       "seasonal_discount, total_cost_after_discounts, regulatory_fee, vat_amount, total_cost FROM breakdown")
oracle("billing_invoices", "SELECT * FROM invoices")


def _late_run_rules() -> Rules:
    import datetime as dt
    from dataclasses import replace
    return replace(DEFAULT_RULES, as_of=dt.datetime(2024, 3, 5))


oracle("billing_invoices_late_run", "SELECT * FROM invoices", _late_run_rules())


# ------------------------------------------------------------------ helpers
def sql_str(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def number_text(expr: str) -> str:
    return f"regexp_replace(regexp_replace(CAST({money(expr)} AS VARCHAR), '0+$', ''), '\\.$', '')"


def html_escape(expr: str) -> str:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        expr = f"replace({expr}, {sql_str(a)}, {sql_str(b)})"
    return expr


def render_template(template, r: Rules = DEFAULT_RULES) -> str:
    parts = []
    for kind, arg in template:
        if kind == "lit":
            parts.append(sql_str(arg))
        elif kind == "rule":
            parts.append(sql_str(str(getattr(r, arg))))
        elif kind == "text":
            parts.append(f"coalesce({html_escape(f'CAST({arg} AS VARCHAR)')}, '')")
        elif kind == "plain":
            parts.append(f"coalesce(CAST({arg} AS VARCHAR), '')")
        elif kind == "num2":
            parts.append(f"coalesce(CAST({money(arg)} AS VARCHAR), '')")
        elif kind == "int":
            parts.append(f"coalesce(CAST(CAST({arg} AS BIGINT) AS VARCHAR), '')")
        elif kind == "title":
            t = f"concat(upper(substr({arg}, 1, 1)), lower(substr({arg}, 2)))"
            parts.append(f"coalesce({html_escape(t)}, '')")
        elif kind == "yesno":
            parts.append(f"CASE WHEN coalesce({arg}, false) THEN 'Yes' ELSE 'No' END")
        elif kind == "date":
            parts.append(f"coalesce(strftime({arg}, '%Y-%m-%d'), '')")
        else:
            raise ValueError(kind)
    return "concat(" + ", ".join(parts) + ")"


def original_data_sql(type_col: str = "record_type") -> str:
    return (f"concat('record_type:', coalesce({type_col}, ''), ', msisdn:', coalesce(msisdn, ''), "
            f"', duration:', coalesce({number_text('duration_sec')}, ''), "
            f"', data_volume:', coalesce({number_text('data_volume_mb')}, ''))")


# ------------------------------------------------------------------ customers
oracle("eligible_customers", "SELECT msisdn, rate_plan_id FROM customers WHERE status = 'active'")
oracle("customers_by_service",
       "SELECT p.service_type, count(*) AS customer_count FROM customers c "
       "JOIN rate_plans p ON c.rate_plan_id = p.rate_plan_id WHERE c.status = 'active' GROUP BY p.service_type")
_profile_union = " UNION ALL ".join(
    f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value FROM customers"
    for d in ("rate_plan_id", "region", "student", "status", "subscription_type"))
oracle("customer_profile",
       "SELECT dimension, value, customer_count, "
       + money("CAST(100 AS DOUBLE) * customer_count / sum(customer_count) OVER (PARTITION BY dimension)", 1)
       + f" AS pct FROM (SELECT dimension, value, count(*) AS customer_count FROM ({_profile_union}) "
       "GROUP BY dimension, value)")
oracle("customer_insert_new", "SELECT * FROM customers WHERE activation_date >= DATE '2022-01-01'")

# ------------------------------------------------------------------ reports
oracle("report_customers",
       "SELECT msisdn, customer_name, subscription_type, rate_plan_id, activation_date, status, region, "
       "CASE WHEN student THEN 'Yes' ELSE 'No' END AS is_student FROM customers "
       "ORDER BY customer_name NULLS LAST, msisdn")
oracle("report_invoices",
       f"SELECT invoice_id, msisdn, customer_name, {money('voice_cost')} AS voice_cost, "
       f"{money('sms_cost')} AS sms_cost, {money('data_cost')} AS data_cost, {money('total_cost')} AS total_cost, "
       "voice_usage, sms_usage, data_usage, status, invoice_date FROM invoices "
       "ORDER BY invoice_date DESC NULLS FIRST, invoice_id")
oracle("report_revenue_by_service",
       f"SELECT service_type, {revenue_aggs('amount', 'total_invoices')} FROM ("
       "SELECT 'voice' AS service_type, voice_cost AS amount FROM invoices UNION ALL "
       "SELECT 'sms', sms_cost FROM invoices UNION ALL SELECT 'data', data_cost FROM invoices) "
       "GROUP BY service_type ORDER BY total_revenue DESC, service_type")
oracle("report_rated_records",
       f'SELECT record_id, record_type, "timestamp", msisdn, {money("cost")} AS cost, rating_status '
       "FROM rated WHERE rating_status = 'rated' "
       f'ORDER BY "timestamp" DESC NULLS FIRST, record_id LIMIT {DEFAULT_RULES.report_row_limit}')
_dead = (f"SELECT record_id, rating_status AS error_reason, '{DEFAULT_RULES.dead_record_source}' AS error_source, "
         f'"timestamp" AS error_timestamp, {original_data_sql()} AS original_data FROM rated '
         "WHERE rating_status IN ('unmatched', 'rejected', 'error')")
oracle("report_dead_records",
       f"{_dead} ORDER BY error_timestamp DESC NULLS FIRST, record_id LIMIT {DEFAULT_RULES.report_row_limit}")
oracle("report_dead_records_unified",
       f"SELECT record_id, 'error' AS error_reason, '{DEFAULT_RULES.mediation_source}' AS error_source, "
       f'"timestamp" AS error_timestamp, {original_data_sql()} AS original_data FROM mediated '
       f"WHERE status = 'error' UNION ALL {_dead}")


# ------------------------------------------------------------------ invoices
def _half_runs() -> tuple[Rules, Rules]:
    import datetime as dt
    from dataclasses import replace
    mid = dt.datetime(2024, 1, 16)
    return (replace(DEFAULT_RULES, period_end=mid, as_of=mid),
            replace(DEFAULT_RULES, period_start=mid))


_first, _second = _half_runs()
_TWO_RUNS = billing_ctes(_first, "a_") + ",\n" + billing_ctes(_second, "b_") + """,
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY msisdn ORDER BY invoice_date DESC, invoice_id DESC) AS rn
    FROM (SELECT * FROM a_invoices UNION ALL SELECT * FROM b_invoices)) WHERE rn = 1)"""


def _view_ctes(r: Rules = DEFAULT_RULES) -> str:
    fee = dbl(r.regulatory_fee)
    zero = "CAST(0 AS DOUBLE)"
    seasonal = (f"subtotal * {dbl(r.seasonal_rate)}" if r.as_of.month == r.seasonal_month else zero)

    def fact(svc, col, default):
        return f"coalesce(CASE WHEN p.service_type = '{svc}' THEN p.{col} END, {default})"

    return _TWO_RUNS + f""",
view0 AS (
  SELECT l.invoice_id, l.msisdn, l.customer_name, l.region, l.student, l.invoice_date,
         l.billing_period_start, l.billing_period_end, l.status, l.voice_cost, l.sms_cost, l.data_cost,
         l.total_cost, l.voice_usage, l.sms_usage, l.data_usage,
         coalesce(CASE WHEN p.service_type = 'voice' THEN p.plan_name END, {sql_str(r.unknown_plan_name)}) AS plan_name,
         {fact('voice', 'free_units', 0)} AS voice_free_minutes,
         {fact('sms', 'free_units', 0)} AS sms_free_units,
         {fact('data', 'tiered_threshold_mb', zero)} AS data_threshold_mb,
         {fact('voice', 'unit_price', zero)} AS voice_unit_price,
         {fact('sms', 'unit_price', zero)} AS sms_unit_price,
         {fact('data', 'unit_price', zero)} AS data_unit_price,
         {fact('data', 'tiered_price_mb', zero)} AS data_tiered_price,
         l.voice_cost + l.sms_cost + l.data_cost AS subtotal
  FROM latest l LEFT JOIN customers c ON l.msisdn = c.msisdn
  LEFT JOIN rate_plans p ON c.rate_plan_id = p.rate_plan_id),
view1 AS (
  SELECT *, greatest({zero}, voice_usage - voice_free_minutes) AS voice_billable_minutes,
         greatest(0, sms_usage - sms_free_units) AS sms_billable_count,
         {fee} AS regulatory_fee,
         CASE WHEN total_cost > subtotal + {fee} THEN total_cost - (subtotal + {fee}) ELSE {zero} END AS vat_amount,
         {seasonal} AS seasonal_discount
  FROM view0),
inv_view AS (
  SELECT *, greatest({zero}, seasonal_discount) AS total_discounts, {zero} AS usage_discounts,
         {zero} AS loyalty_discount, {zero} AS student_discount, {zero} AS urban_discount
  FROM view1)"""


oracle("invoice_latest", "SELECT * FROM latest", extra=_TWO_RUNS)
oracle("invoice_view", "SELECT * FROM inv_view", extra=_view_ctes())


def _breakdown_sql(r: Rules = DEFAULT_RULES) -> str:
    amounts = {
        "subtotal_before_discounts": "subtotal_before_discounts",
        "usage_discounts": "subtotal_before_discounts - net_after_usage_discounts",
        "total_spending_discount": "total_spending_discount",
        "student_discount": "student_discount",
        "urban_discount": "urban_discount",
        "loyalty_discount": "loyalty_discount",
        "seasonal_discount": "seasonal_discount",
        "total_discounts": "(subtotal_before_discounts - net_after_usage_discounts) + total_spending_discount"
                           " + student_discount + urban_discount + loyalty_discount + seasonal_discount",
        "total_cost_after_discounts": "total_cost_after_discounts",
        "regulatory_fee": "b.regulatory_fee",
        "vat_amount": "vat_amount",
        "total_cost": "total_cost",
    }
    cols = ", ".join(f"{round_half_up(e, r.money_scale)} AS {n}" for n, e in amounts.items())
    return (f"SELECT md5(concat(b.msisdn, '-{r.period_start.strftime('%Y-%m-%d')}')) AS invoice_id, "
            f"b.msisdn, b.customer_name, coalesce(p.plan_name, {sql_str(r.unknown_plan_name)}) AS plan_name, {cols} "
            "FROM breakdown b LEFT JOIN rate_plans p ON b.rate_plan_id = p.rate_plan_id")


oracle("invoice_breakdown", _breakdown_sql())


def _doc_sql() -> str:
    from chargeline.functions.template import INVOICE_DOCUMENT
    return f"SELECT invoice_id, msisdn, {render_template(INVOICE_DOCUMENT)} AS document FROM inv_view"


def _outbox_sql(r: Rules = DEFAULT_RULES) -> str:
    from chargeline.functions.template import INVOICE_MAIL_BODY
    return (f"SELECT invoice_id, msisdn, concat({sql_str(r.mail_subject_prefix)}, strftime(invoice_date, '%Y-%m-%d')) "
            f"AS subject, {render_template(INVOICE_MAIL_BODY, r)} AS body FROM inv_view")


oracle("invoice_documents", _doc_sql(), extra=_view_ctes())
oracle("invoice_outbox", _outbox_sql(), extra=_view_ctes())


# ------------------------------------------------------------------ quality
def _key_sql(table: str, source: str, key: str) -> str:
    sub = f"(SELECT {key} AS k, count(*) AS n FROM {source} GROUP BY {key})"
    return " UNION ALL ".join([
        f"SELECT '{table}.{key}:duplicate_keys' AS check_name, CAST(count(*) FILTER (WHERE k IS NOT NULL AND n > 1) AS BIGINT) AS violations FROM {sub}",
        f"SELECT '{table}.{key}:surplus_rows', CAST(coalesce(sum(CASE WHEN k IS NOT NULL AND n > 1 THEN n - 1 END), 0) AS BIGINT) FROM {sub}",
        f"SELECT '{table}.{key}:null_keys', CAST(coalesce(sum(CASE WHEN k IS NULL THEN n END), 0) AS BIGINT) FROM {sub}",
    ])


oracle("quality_keys", " UNION ALL ".join([
    _key_sql("customers", "customers", "msisdn"),
    _key_sql("rate_plans", "rate_plans", "rate_plan_id"),
    _key_sql("normalized_records", "valid_unique", "record_id"),
    _key_sql("rated_records", "rated", "record_id"),
    _key_sql("invoices", "invoices", "invoice_id"),
]))
oracle("quality_keys_incremental", _key_sql("records", "delivered", "record_id"), extra="""
delivered AS (
  SELECT CASE WHEN CAST(substr(record_id, 3) AS BIGINT) % 13 <> 5 THEN record_id END AS record_id
  FROM mediated, (VALUES (1), (2)) AS t(copy)
  WHERE copy = 1 OR CAST(substr(record_id, 3) AS BIGINT) % 3 = 1)
""")
oracle("quality_foreign_keys",
       "SELECT record_id, rate_plan_id, rating_status FROM rated WHERE rate_plan_id IS NOT NULL "
       "AND rate_plan_id NOT IN (SELECT rate_plan_id FROM rate_plans)")


def _count_sql(table: str, source: str, checks: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}.{n}' AS check_name, CAST(count(*) FILTER (WHERE coalesce({c}, false)) AS BIGINT) AS violations FROM {source}"
        for n, c in checks.items())


def _not_in(col, values):
    return f"({col} IS NOT NULL AND NOT {col} IN ({strs(values)}))"


_r = DEFAULT_RULES
oracle("quality_domains", " UNION ALL ".join([
    _count_sql("normalized_records", "valid_unique", {
        "record_type:domain": _not_in("record_type", _r.record_types),
        "record_id:width": "length(record_id) > 50",
        "record_type:width": "length(record_type) > 20",
        "msisdn:width": "length(msisdn) > 15",
        "secondary_msisdn:width": "length(secondary_msisdn) > 15",
        "cell_id:width": "length(cell_id) > 50",
        "technology:width": "length(technology) > 10",
        "status:width": "length(status) > 20"}),
    _count_sql("customers", "customers", {
        "region:domain": _not_in("region", ("rural", "urban")),
        "msisdn:width": "length(msisdn) > 15",
        "customer_name:width": "length(customer_name) > 100",
        "subscription_type:width": "length(subscription_type) > 20",
        "status:width": "length(status) > 20",
        "region:width": "length(region) > 50"}),
    _count_sql("rate_plans", "rate_plans", {
        "plan_name:width": "length(plan_name) > 100",
        "service_type:width": "length(service_type) > 20"}),
    _count_sql("rated_records", "rated", {
        "rating_status:domain": _not_in("rating_status", ("rated", "unmatched", "rejected", "error")),
        "record_id:width": "length(record_id) > 50",
        "record_type:width": "length(record_type) > 20",
        "msisdn:width": "length(msisdn) > 15",
        "secondary_msisdn:width": "length(secondary_msisdn) > 15",
        "cell_id:width": "length(cell_id) > 50",
        "technology:width": "length(technology) > 10",
        "rating_status:width": "length(rating_status) > 20"}),
    _count_sql("invoices", "invoices", {
        "status:domain": _not_in("status", ("pending", "paid", "failed")),
        "region:domain": _not_in("region", ("rural", "urban")),
        "invoice_id:width": "length(invoice_id) > 50",
        "msisdn:width": "length(msisdn) > 15",
        "customer_name:width": "length(customer_name) > 100",
        "status:width": "length(status) > 20",
        "region:width": "length(region) > 50"}),
]))
oracle("quality_not_null", _count_sql("invoices", "invoices", {
    f"{c}:not_null": f"{c} IS NULL"
    for c in ("msisdn", "billing_period_start", "billing_period_end", "invoice_date")}))

# ------------------------------------------------------------------ counters
oracle("stage_counts", " UNION ALL ".join([
    "SELECT 'mediation_in' AS stage, CAST(count(*) AS BIGINT) AS records FROM mediated",
    "SELECT 'mediation_valid', CAST(count(*) FILTER (WHERE status = 'valid') AS BIGINT) FROM mediated",
    "SELECT 'mediation_error', CAST(count(*) FILTER (WHERE status = 'error') AS BIGINT) FROM mediated",
    "SELECT 'rating_out', CAST(count(*) AS BIGINT) FROM rated",
    "SELECT 'rating_rated', CAST(count(*) FILTER (WHERE rating_status = 'rated') AS BIGINT) FROM rated",
    "SELECT 'rating_rejected', CAST(count(*) FILTER (WHERE rating_status = 'rejected') AS BIGINT) FROM rated",
    "SELECT 'rating_unmatched', CAST(count(*) FILTER (WHERE rating_status = 'unmatched') AS BIGINT) FROM rated",
    "SELECT 'invoices', CAST(count(*) AS BIGINT) FROM invoices",
    "SELECT 'invoices_student', CAST(count(*) FILTER (WHERE student) AS BIGINT) FROM invoices",
    "SELECT 'invoices_urban', CAST(count(*) FILTER (WHERE region = 'urban') AS BIGINT) FROM invoices",
]))

# ------------------------------------------------------------------ streaming and sinks
oracle("stream_mediation", "SELECT * FROM valid_unique")
oracle("stream_dead_letters", "SELECT * FROM mediated WHERE status = 'error' "
       "UNION ALL SELECT * FROM mediated WHERE status = 'error'")
oracle("stream_normalized_store", "SELECT * FROM valid_unique")
oracle("stream_mediation_single_read", "SELECT * FROM valid_unique")
oracle("stream_late_records", "SELECT * FROM valid_unique")
oracle("stream_bounded_dedup", "SELECT * FROM valid_unique")
oracle("stream_store_from_messages", "SELECT * FROM valid_unique")
oracle("store_compacted", "SELECT * FROM valid_unique")
oracle("rating_incremental_batches", f"SELECT {RATED_COLS} FROM rated")
oracle("stream_store_null_time", "SELECT * FROM valid_unique", source="events_no_time")
oracle("stream_store_cross_month", "SELECT * FROM valid_unique")
ORACLE["report_csv_roundtrip"] = ORACLE["report_revenue_by_region"]
oracle("usage_archive_roundtrip", "SELECT * FROM raw_usage")
oracle("rating_job_rerun", f"SELECT {RATED_COLS} FROM rated")
oracle("rating_rerun_null_time", f"SELECT {RATED_COLS} FROM rated",
       replace(DEFAULT_RULES, as_of=dt.datetime(2024, 1, 31)), source="events_no_time")
oracle("billing_job_rerun", "SELECT * FROM invoices")


# ------------------------------------------------------------------ volume fixture
def _orders_rules() -> Rules:
    import datetime as dt
    from dataclasses import replace
    return replace(DEFAULT_RULES, period_start=dt.datetime(1996, 12, 1), period_end=dt.datetime(1997, 1, 1),
                   as_of=dt.datetime(1997, 1, 1))


oracle("mediate_valid_dedup_orders", "SELECT * FROM valid_unique", _orders_rules(), source="orders")
oracle("rated_records_orders", f"SELECT {RATED_COLS} FROM rated", _orders_rules(), source="orders")
oracle("billing_invoices_orders", "SELECT * FROM invoices", _orders_rules(), source="orders")


# ------------------------------------------------------------------ customers as loaded
def _with_loaded_customers(select: str) -> str:
    sql = with_base(select)
    return sql.replace("customers AS (", "given_customers AS (", 1).replace("rate_plans AS (", _LOADED_CUSTOMERS, 1)


ORACLE["customers_loaded"] = _with_loaded_customers("SELECT * FROM customers")
ORACLE["billing_invoices_loaded_customers"] = _with_loaded_customers("SELECT * FROM invoices")
