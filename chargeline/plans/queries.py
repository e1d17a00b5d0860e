"""Registry of named queries: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import replace as _replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType, LongType, StringType, StructField, StructType

from chargeline.functions.columns import month_start, ts_literal
from chargeline.operators import (billing, counters, customers as cust_ops, invoices as inv_ops,
                                  mediation, quality, rating, reports)
from chargeline.plans import flows, jobs
from chargeline.rules import DEFAULT_RULES
from chargeline.schemas import NORMALIZED, USAGE_RAW
from chargeline.session import scratch_path
from chargeline.sinks import ledger, writers
from chargeline.sinks.snapshots import SnapshotTable, read_table
from chargeline.sources import fixtures
from chargeline.streaming import bounded_dedup, mediation_stream as ms

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


@query("report_revenue_by_region")
def report_revenue_by_region(spark, sf_dir):
    return reports.revenue_by_region(flows.invoices(spark, sf_dir))


# ---------------------------------------------------------------- mediation


@query("mediate_json_parse")
def mediate_json_parse(spark, sf_dir):
    """M01-M04 + M10: raw usage -> JSON text -> parsed -> normalised."""
    messages = mediation.to_messages(fixtures.raw_usage(spark, sf_dir))
    return mediation.normalize(mediation.parse_messages(messages))


@query("mediate_normalize")
def mediate_normalize(spark, sf_dir):
    return mediation.normalize(fixtures.raw_usage(spark, sf_dir))


@query("mediate_validate")
def mediate_validate(spark, sf_dir):
    return flows.mediated(spark, sf_dir)


@query("mediate_status_counts")
def mediate_status_counts(spark, sf_dir):
    return mediation.status_counts(flows.mediated(spark, sf_dir))


@query("mediate_valid_dedup")
def mediate_valid_dedup(spark, sf_dir):
    """M08/M09 on an at-least-once delivery: every message arrives twice."""
    raw = fixtures.raw_usage(spark, sf_dir)
    delivered = raw.unionByName(raw)
    return mediation.dedupe_records(mediation.valid_records(mediation.mediate(delivered)))


@query("mediate_dead_letters")
def mediate_dead_letters(spark, sf_dir):
    return mediation.dead_letters(flows.mediated(spark, sf_dir))


def damaged_messages(spark, sf_dir):
    """Messages of which some are cut short, have an impossible event time, text
    where a number belongs, or a field that nobody knows."""
    raw = fixtures.raw_usage(spark, sf_dir)
    kind = F.col("kind")
    raw = raw.withColumn("kind", F.substring("record_id", 3, 20).cast("bigint") % 7)
    raw = raw.withColumns({
        "timestamp": F.when(kind == 1, F.concat(F.lit("2024-13-"), F.substring("timestamp", 9, 11))).when(
            kind == 2, F.replace("timestamp", F.lit(" "), F.lit("T"))).otherwise(F.col("timestamp")),
        "duration_sec": F.when(kind == 3, F.lit("long")).otherwise(F.col("duration_sec").cast("string")),
        "operator": F.when(kind == 4, F.lit("x"))})
    value = F.to_json(F.struct(*[c for c in raw.columns if c != "kind"]))
    # numbers are bare again, but for the text in their place
    value = F.regexp_replace(value, r'"duration_sec":"(-?[0-9]+)"', r'"duration_sec":$1')
    return raw.select(F.when(kind == 0, F.substring(value, 1, 40)).otherwise(value).alias("value"))


@query("mediate_damaged_messages")
def mediate_damaged_messages(spark, sf_dir):
    """Damaged text becomes an empty record (a dead letter) or a missing field, never a failure."""
    return mediation.mediate(mediation.parse_messages(damaged_messages(spark, sf_dir)))


# ---------------------------------------------------------------- rating
MID_MONTH = _dt.datetime(2024, 1, 16)


@query("rating_new_records")
def rating_new_records(spark, sf_dir):
    """R02 incremental run: a first run rated the records before mid-month; the
    second run over the whole month rates only what is new."""
    valid = flows.valid_usage(spark, sf_dir)
    cust, plans = fixtures.customers(spark, sf_dir), fixtures.rate_plans(spark)
    first = rating.rate(valid.filter(F.col("timestamp") < ts_literal(MID_MONTH)), cust, plans)
    return rating.rate(valid, cust, plans, DEFAULT_RULES, already_rated=first)


@query("rating_enriched")
def rating_enriched(spark, sf_dir):
    return flows.priced(spark, sf_dir).select(
        "record_id", "record_type", "timestamp", "billing_month", "msisdn",
        "customer_rate_plan_id", "customer_status", "region", "student", "activation_date",
        "plan_name", "unit_price")


@query("rating_status")
def rating_status_q(spark, sf_dir):
    return flows.priced(spark, sf_dir).select("record_id", "required_rate_plan_type", "rating_status")


@query("rating_status_counts")
def rating_status_counts(spark, sf_dir):
    return rating.status_breakdown(flows.rated(spark, sf_dir))


@query("rating_base_cost")
def rating_base_cost(spark, sf_dir):
    return flows.priced(spark, sf_dir).select("record_id", "rating_status", "base_cost")


@query("rating_time_of_day")
def rating_time_of_day(spark, sf_dir):
    return flows.priced(spark, sf_dir).select("record_id", "cost_time_of_day")


@query("rating_friday")
def rating_friday(spark, sf_dir):
    return flows.priced(spark, sf_dir).select("record_id", "cost_friday")


@query("rating_roaming")
def rating_roaming(spark, sf_dir):
    return flows.priced(spark, sf_dir).select("record_id", "cost")


@query("rated_records")
def rated_records(spark, sf_dir):
    return flows.rated(spark, sf_dir)


# ---------------------------------------------------------------- billing
@query("billing_usage")
def billing_usage(spark, sf_dir):
    return billing.usage_totals(flows.rated(spark, sf_dir))


@query("billing_voice")
def billing_voice(spark, sf_dir):
    return flows.service_lines(spark, sf_dir).select(
        "msisdn", "voice_usage_minutes", "voice_free_minutes", "voice_billable_minutes",
        "voice_cost_rated", "voice_cost")


@query("billing_sms")
def billing_sms(spark, sf_dir):
    return flows.service_lines(spark, sf_dir).select(
        "msisdn", "sms_usage_count", "sms_free_units", "sms_unit_price", "sms_cost")


@query("billing_data")
def billing_data(spark, sf_dir):
    return flows.service_lines(spark, sf_dir).select(
        "msisdn", "data_usage_mb", "data_threshold_mb", "data_cost_rated", "data_cost")


BREAKDOWN_COLUMNS = ["msisdn", "loyalty_months", "subtotal_before_discounts", "voice_cost",
                     "sms_cost", "data_cost", "total_spending_discount", "student_discount",
                     "urban_discount", "loyalty_discount_rate", "loyalty_discount",
                     "seasonal_discount", "total_cost_after_discounts", "regulatory_fee",
                     "vat_amount", "total_cost"]


@query("billing_discounts")
def billing_discounts(spark, sf_dir):
    return flows.breakdown(spark, sf_dir).select(*BREAKDOWN_COLUMNS)


@query("billing_invoices")
def billing_invoices(spark, sf_dir):
    return flows.invoices(spark, sf_dir)


LATE_RUN = _replace(DEFAULT_RULES, as_of=_dt.datetime(2024, 3, 5))


@query("billing_invoices_late_run")
def billing_invoices_late_run(spark, sf_dir):
    """January billed on 5 March: seasonal month discount and longer tenure."""
    return flows.invoices(spark, sf_dir, LATE_RUN)


# ---------------------------------------------------------------- customers

INCUMBENT_BEFORE = _dt.date(2022, 1, 1)


def incomplete_customers(spark, sf_dir):
    """Subscribers with missing values where the table has defaults, and every row twice."""
    n = F.substring("msisdn", 5, 20).cast("bigint")
    rows = fixtures.customers(spark, sf_dir).withColumns({
        "subscription_type": F.when(n % 4 != 1, F.col("subscription_type")),
        "status": F.when(n % 5 != 2, F.col("status")),
        "student": F.when(n % 3 != 0, F.col("student"))})
    return rows.unionByName(rows)


@query("customers_loaded")
def customers_loaded(spark, sf_dir):
    """Q05 + Q01 on load: defaults filled in, one row per subscriber."""
    return cust_ops.load(incomplete_customers(spark, sf_dir))


@query("billing_invoices_loaded_customers")
def billing_invoices_loaded_customers(spark, sf_dir):
    """Rating and billing with subscribers as loaded: defaults decide status and student discount."""
    cust, plans = cust_ops.load(incomplete_customers(spark, sf_dir)), fixtures.rate_plans(spark)
    return billing.bill(rating.rate(flows.valid_usage(spark, sf_dir), cust, plans), cust, plans)


@query("eligible_customers")
def eligible_customers(spark, sf_dir):
    return cust_ops.eligible(fixtures.customers(spark, sf_dir))


@query("customers_by_service")
def customers_by_service(spark, sf_dir):
    return cust_ops.by_service(fixtures.customers(spark, sf_dir), fixtures.rate_plans(spark))


@query("customer_profile")
def customer_profile(spark, sf_dir):
    return cust_ops.profile(fixtures.customers(spark, sf_dir))


@query("customer_insert_new")
def customer_insert_new(spark, sf_dir):
    """The table holds the subscribers activated before 2022; a generator
    run re-sends every subscriber (twice); only the absent ones are inserted."""
    everyone = fixtures.customers(spark, sf_dir)
    existing = everyone.filter(F.col("activation_date") < F.lit(INCUMBENT_BEFORE))
    return cust_ops.insert_new(existing, everyone.unionByName(everyone))


# ---------------------------------------------------------------- reports
@query("report_customers")
def report_customers(spark, sf_dir):
    return reports.customers_report(fixtures.customers(spark, sf_dir))


@query("report_invoices")
def report_invoices(spark, sf_dir):
    return reports.invoices_report(flows.invoices(spark, sf_dir))


@query("report_revenue_by_service")
def report_revenue_by_service(spark, sf_dir):
    return reports.revenue_by_service(flows.invoices(spark, sf_dir))


@query("report_rated_records")
def report_rated_records(spark, sf_dir):
    return reports.rated_records_report(flows.rated(spark, sf_dir))


@query("report_dead_records")
def report_dead_records(spark, sf_dir):
    return reports.dead_records_report(flows.rated(spark, sf_dir))


@query("report_dead_records_unified")
def report_dead_records_unified(spark, sf_dir):
    mediated = flows.mediated(spark, sf_dir)
    rated = rating.rate(mediation.valid_records(mediated), fixtures.customers(spark, sf_dir),
                        fixtures.rate_plans(spark))
    return reports.dead_records_unified(mediation.dead_letters(mediated), rated)


# ---------------------------------------------------------------- invoices
FIRST_HALF = _replace(DEFAULT_RULES, period_end=MID_MONTH, as_of=MID_MONTH)
SECOND_HALF = _replace(DEFAULT_RULES, period_start=MID_MONTH)


def two_runs(spark, sf_dir):
    """Invoices of two half-month billing runs over the same rated records."""
    rated = flows.rated(spark, sf_dir)
    return (flows.invoices(spark, sf_dir, FIRST_HALF, rated)
            .unionByName(flows.invoices(spark, sf_dir, SECOND_HALF, rated)))


def latest_view(spark, sf_dir):
    return inv_ops.view(inv_ops.latest(two_runs(spark, sf_dir)), fixtures.customers(spark, sf_dir),
                        fixtures.rate_plans(spark), DEFAULT_RULES)


@query("invoice_latest")
def invoice_latest(spark, sf_dir):
    return inv_ops.latest(two_runs(spark, sf_dir))


@query("invoice_view")
def invoice_view(spark, sf_dir):
    return latest_view(spark, sf_dir)


@query("invoice_breakdown")
def invoice_breakdown(spark, sf_dir):
    return inv_ops.breakdown_view(flows.breakdown(spark, sf_dir), fixtures.rate_plans(spark))


@query("invoice_documents")
def invoice_documents(spark, sf_dir):
    return inv_ops.documents(latest_view(spark, sf_dir))


@query("invoice_outbox")
def invoice_outbox(spark, sf_dir):
    return inv_ops.outbox(latest_view(spark, sf_dir))


# ---------------------------------------------------------------- quality
def _quality_tables(spark, sf_dir):
    mediated = flows.mediated(spark, sf_dir)
    valid = mediation.dedupe_records(mediation.valid_records(mediated))
    # already unique by record_id: rating reuses this de-duplication
    rated = rating.rate(valid, fixtures.customers(spark, sf_dir), fixtures.rate_plans(spark),
                        input_unique=True)
    invoices = flows.invoices(spark, sf_dir, DEFAULT_RULES, rated)
    return {"customers": fixtures.customers(spark, sf_dir), "normalized_records": valid,
            "rate_plans": fixtures.rate_plans(spark), "rated_records": rated, "invoices": invoices}


@query("quality_keys")
def quality_keys(spark, sf_dir):
    t = _quality_tables(spark, sf_dir)
    return quality.key_violations({
        "customers": (t["customers"], "msisdn"),
        "rate_plans": (t["rate_plans"], "rate_plan_id"),
        "normalized_records": (t["normalized_records"], "record_id"),
        "rated_records": (t["rated_records"], "record_id"),
        "invoices": (t["invoices"], "invoice_id"),
    })


@query("quality_keys_incremental")
def quality_keys_incremental(spark, sf_dir):
    """Q01 by new batches: three deliveries without de-duplication, some ids missing,
    one delivery twice; each check reads the new ids and what they may repeat."""
    base = scratch_path(spark, "key-check")
    n = F.substring("record_id", 3, 20).cast("bigint")
    rows = flows.mediated(spark, sf_dir).withColumn("part", n % 3).withColumn(
        "record_id", F.when(n % 13 != 5, F.col("record_id"))).withColumn("billing_month", month_start("timestamp"))
    table = SnapshotTable(spark, f"{base}/table")
    book = ledger.IdLedger(table, "record_id")
    for part in (0, 1, 2, 1):
        table.append(rows.where(F.col("part") == part).drop("part"), "billing_month", also=book.write)
        out = jobs.run_key_check(spark, table.root, "record_id", "records", f"{base}/checks")
    return out


@query("quality_foreign_keys")
def quality_foreign_keys(spark, sf_dir):
    return quality.foreign_key_violations(flows.rated(spark, sf_dir), fixtures.rate_plans(spark))


@query("quality_domains")
def quality_domains(spark, sf_dir):
    t = _quality_tables(spark, sf_dir)
    out = None
    for table, checks in quality.domain_checks().items():
        part = quality.count_checks(t[table], table, checks)
        out = part if out is None else out.unionByName(part)
    return out


@query("quality_not_null")
def quality_not_null(spark, sf_dir):
    return quality.count_checks(flows.invoices(spark, sf_dir), "invoices", quality.not_null_checks())


# ---------------------------------------------------------------- counters
@query("stage_counts")
def stage_counts(spark, sf_dir):
    mediated = flows.mediated(spark, sf_dir)
    rated = rating.rate(mediation.valid_records(mediated), fixtures.customers(spark, sf_dir),
                        fixtures.rate_plans(spark))
    return counters.stage_counts(mediated, rated, flows.invoices(spark, sf_dir, DEFAULT_RULES, rated))


# ---------------------------------------------------------------- streaming


def run_stream_mediation(spark, sf_dir):
    """Deliver every message twice (second delivery after a restart) through
    the file source; returns the scratch folder holding the sinks."""
    base = scratch_path(spark, "stream-mediation")
    inbox = f"{base}/inbox"
    messages = mediation.to_messages(fixtures.raw_usage(spark, sf_dir))
    for delivery in range(2):
        messages.write.mode("append").text(inbox)
        source = ms.usage_source(spark, "text", path=inbox)
        ms.await_all(ms.start_mediation(source, checkpoint_root=f"{base}/checkpoints",
                                        valid_path=f"{base}/valid", dead_path=f"{base}/dead"))
    return base


@query("stream_mediation")
def stream_mediation(spark, sf_dir):
    base = run_stream_mediation(spark, sf_dir)
    return spark.read.schema(NORMALIZED).parquet(f"{base}/valid")


@query("stream_dead_letters")
def stream_dead_letters(spark, sf_dir):
    base = run_stream_mediation(spark, sf_dir)
    return spark.read.schema(NORMALIZED).parquet(f"{base}/dead")


@query("stream_normalized_store")
def stream_normalized_store(spark, sf_dir):
    """The store consumes the valid stream twice (the second time from a lost
    checkpoint, i.e. a full replay); the table still holds each record once."""
    base = run_stream_mediation(spark, sf_dir)
    table = f"{base}/normalized_records"
    for replay in range(2):
        ms.start_normalized_store(spark, f"{base}/valid", table,
                                  f"{base}/store-checkpoint-{replay}").awaitTermination()
    return read_table(spark, table).select(*NORMALIZED.fieldNames())


@query("stream_mediation_single_read")
def stream_mediation_single_read(spark, sf_dir):
    """K01 single-read mode: one query, both outputs from foreachBatch, the
    stream delivered twice with a restart; the store holds each record once."""
    base = scratch_path(spark, "stream-single-read")
    inbox = f"{base}/inbox"
    messages = mediation.to_messages(fixtures.raw_usage(spark, sf_dir))
    for delivery in range(2):
        messages.write.mode("append").text(inbox)
        ms.start_mediation_store(ms.usage_source(spark, "text", path=inbox),
                                 normalized_path=f"{base}/normalized", dead_path=f"{base}/dead",
                                 checkpoint=f"{base}/checkpoint").awaitTermination()
    return read_table(spark, f"{base}/normalized").select(*NORMALIZED.fieldNames())


@query("stream_late_records")
def stream_late_records(spark, sf_dir):
    """The newer half of the month is delivered first, the older half after a
    restart; every valid record comes out, however late."""
    base = scratch_path(spark, "stream-late")
    inbox = f"{base}/inbox"
    raw = fixtures.raw_usage(spark, sf_dir)
    late = F.coalesce(F.col("timestamp") < F.lit("2024-01-16 00:00:00"), F.lit(True))
    for delivery in (raw.where(~late), raw.where(late)):
        mediation.to_messages(delivery).write.mode("append").text(inbox)
        ms.await_all(ms.start_mediation(ms.usage_source(spark, "text", path=inbox),
                                        checkpoint_root=f"{base}/checkpoints",
                                        valid_path=f"{base}/valid", dead_path=f"{base}/dead"))
    return spark.read.schema(NORMALIZED).parquet(f"{base}/valid")


@query("stream_bounded_dedup")
def stream_bounded_dedup(spark, sf_dir):
    """Every message delivered twice, the older half of the month after the
    newer half; state bounded by a two-day watermark, late records reconciled."""
    base = scratch_path(spark, "stream-bounded")
    inbox = f"{base}/inbox"
    raw = fixtures.raw_usage(spark, sf_dir)
    late = F.coalesce(F.col("timestamp") < F.lit("2024-01-16 00:00:00"), F.lit(True))
    for delivery in (raw.where(~late), raw.where(late), raw):
        mediation.to_messages(delivery).write.mode("append").text(inbox)
        ms.await_all([bounded_dedup.start_split(ms.usage_source(spark, "text", path=inbox), f"{base}/out", "2 days")])
        ms.await_all([bounded_dedup.start_dedup(spark, f"{base}/out", "2 days")])
        bounded_dedup.reconcile_late(spark, f"{base}/out")
    return bounded_dedup.unique_records(spark, f"{base}/out")


def _store_deliveries(spark, name, deliveries):
    """The normalised store after each delivery was appended to its source and consumed."""
    base = scratch_path(spark, name)
    for delivery in deliveries:
        delivery.select(*NORMALIZED.fieldNames()).write.mode("append").parquet(f"{base}/valid")
        ms.start_normalized_store(spark, f"{base}/valid", f"{base}/normalized_records",
                                  f"{base}/checkpoint").awaitTermination()
    return read_table(spark, f"{base}/normalized_records").select(*NORMALIZED.fieldNames())


@query("stream_store_from_messages")
def stream_store_from_messages(spark, sf_dir):
    """M10 + S02: valid records serialised as messages, sent twice, and consumed into the store."""
    base = scratch_path(spark, "store-messages")
    messages = mediation.serialize(flows.valid_usage(spark, sf_dir).select(*NORMALIZED.fieldNames()), key="record_id")
    for _ in range(2):
        messages.select("value").write.mode("append").text(f"{base}/topic")
        source = ms.usage_source(spark, "text", path=f"{base}/topic")
        ms.start_normalized_store(spark, None, f"{base}/normalized_records", f"{base}/checkpoint",
                                  messages=source).awaitTermination()
    return read_table(spark, f"{base}/normalized_records").select(*NORMALIZED.fieldNames())


@query("stream_store_null_time")
def stream_store_null_time(spark, sf_dir):
    """Records without an event time, delivered twice, are stored once."""
    valid = flows.valid_usage(spark, sf_dir, source="events_no_time")
    return _store_deliveries(spark, "store-null-time", [valid, valid])


@query("stream_store_cross_month")
def stream_store_cross_month(spark, sf_dir):
    """Records that come again with a time in the next month are stored once, as first delivered."""
    valid = flows.valid_usage(spark, sf_dir)
    moved = valid.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 MONTH"))
    return _store_deliveries(spark, "store-cross-month", [valid, moved])


def _store_in_parts(spark, sf_dir, name, parts):
    """The normalised store after the month came in so many deliveries, each with one of the others again.

    The month is mediated once, into one folder per part; a delivery reads its folders."""
    tables = jobs.TablePaths(scratch_path(spark, name))
    inbox = f"{tables.root}/deliveries"
    valid = flows.valid_usage(spark, sf_dir).select(*NORMALIZED.fieldNames())
    (valid.withColumn("_part", F.pmod(F.xxhash64("record_id"), F.lit(parts)).cast("int"))
     .write.partitionBy("_part").parquet(inbox))
    delivered = spark.read.schema(StructType([*NORMALIZED.fields, StructField("_part", IntegerType())])).parquet(inbox)
    for i in range(parts):
        delivery = delivered.where(F.col("_part").isin(i, (i + 1) // 2)).drop("_part")
        ms.store_batch(tables.normalized, "deliveries")(delivery, i)
        yield tables


@query("store_compacted")
def store_compacted(spark, sf_dir):
    """Six deliveries, then the small parts rewritten as one; the table reads the same."""
    for tables in _store_in_parts(spark, sf_dir, "store-compacted", 6):
        pass
    jobs.run_compaction(spark, tables)
    return read_table(spark, tables.normalized).select(*NORMALIZED.fieldNames())


@query("rating_incremental_batches")
def rating_incremental_batches(spark, sf_dir):
    """The store grows by three deliveries; each rating run reads the new batches alone."""
    for tables in _store_in_parts(spark, sf_dir, "rating-incremental", 3):
        jobs.run_rating_incremental(spark, fixtures.customers(spark, sf_dir), fixtures.rate_plans(spark), tables)
    return read_table(spark, tables.rated).select(*rating.RATED_COLUMNS)


# ---------------------------------------------------------------- sinks

REVENUE_REGION_CSV = StructType([
    StructField("region", StringType()), StructField("total_revenue", DecimalType(18, 2)),
    StructField("customer_count", LongType()), StructField("avg_revenue_per_customer", DecimalType(18, 2))])


@query("report_csv_roundtrip")
def report_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "report-revenue-by-region")
    writers.write_report_csv(reports.revenue_by_region(flows.invoices(spark, sf_dir)), path)
    return writers.read_report_csv(spark, path, REVENUE_REGION_CSV)


@query("usage_archive_roundtrip")
def usage_archive_roundtrip(spark, sf_dir):
    """Raw usage appended to a JSON-lines archive and a CSV archive;
    both read back and must agree (the CSV copy is returned)."""
    raw = fixtures.raw_usage(spark, sf_dir)
    jpath, cpath = scratch_path(spark, "archive-json"), scratch_path(spark, "archive-csv")
    writers.archive_usage(raw, jpath, "json")
    writers.archive_usage(writers.read_usage_archive(spark, jpath, USAGE_RAW, "json"), cpath, "csv")
    return writers.read_usage_archive(spark, cpath, USAGE_RAW, "csv")


@query("rating_job_rerun")
def rating_job_rerun(spark, sf_dir):
    """K04 + R02: the rating job runs twice on the same input; the second run
    appends nothing, so the table holds every record once."""
    tables = jobs.TablePaths(scratch_path(spark, "tables"))
    valid = flows.valid_usage(spark, sf_dir)
    cust, plans = fixtures.customers(spark, sf_dir), fixtures.rate_plans(spark)
    for _ in range(2):
        jobs.run_rating(spark, valid, cust, plans, tables)
    return read_table(spark, tables.rated).select(*rating.RATED_COLUMNS)


@query("rating_rerun_null_time")
def rating_rerun_null_time(spark, sf_dir):
    """R02 + R03: records without an event time are rated once, under the run
    time of the first run; a run in another month writes none of them again."""
    tables = jobs.TablePaths(scratch_path(spark, "tables-null-time"))
    valid = flows.valid_usage(spark, sf_dir, source="events_no_time")
    cust, plans = fixtures.customers(spark, sf_dir), fixtures.rate_plans(spark)
    for as_of in (_dt.datetime(2024, 1, 31), _dt.datetime(2024, 2, 28)):
        jobs.run_rating(spark, valid, cust, plans, tables, _replace(DEFAULT_RULES, as_of=as_of))
    return read_table(spark, tables.rated).select(*rating.RATED_COLUMNS)


@query("billing_job_rerun")
def billing_job_rerun(spark, sf_dir):
    """Billing the same period twice replaces its invoices (same ids)."""
    tables = jobs.TablePaths(scratch_path(spark, "tables"))
    cust, plans = fixtures.customers(spark, sf_dir), fixtures.rate_plans(spark)
    jobs.run_rating(spark, flows.valid_usage(spark, sf_dir), cust, plans, tables)
    for _ in range(2):
        jobs.run_billing(spark, cust, plans, tables)
    return spark.read.parquet(tables.invoices).select(*billing.INVOICE_COLUMNS)


# ---------------------------------------------------------------- volume fixture
ORDERS_RULES = _replace(DEFAULT_RULES, period_start=_dt.datetime(1996, 12, 1),
                        period_end=_dt.datetime(1997, 1, 1), as_of=_dt.datetime(1997, 1, 1))


@query("mediate_valid_dedup_orders")
def mediate_valid_dedup_orders(spark, sf_dir):
    """M09 on natural duplicates: the earliest copy of each record_id survives."""
    return mediation.dedupe_records(flows.valid_usage(spark, sf_dir, ORDERS_RULES, "orders"))


@query("rated_records_orders")
def rated_records_orders(spark, sf_dir):
    return flows.rated(spark, sf_dir, ORDERS_RULES, source="orders")


@query("billing_invoices_orders")
def billing_invoices_orders(spark, sf_dir):
    return flows.invoices(spark, sf_dir, ORDERS_RULES, source="orders")
