"""Batch jobs that read and write tables (rating run, billing run, reports).

Jobs attach ``DataFrame.observe`` counters to the data being written, so the
stage counts cost no extra pass, and return them.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chargeline.operators import billing, quality, rating
from chargeline.rules import DEFAULT_RULES, Rules
from chargeline.sinks import ledger, writers
from chargeline.sinks.snapshots import SnapshotTable, read_table


# AQE may replace a plan that turns out empty at run time by an empty relation,
# dropping the observe() node with it; jobs keep it so counters always report.
_KEEP_OBSERVE = {"spark.sql.adaptive.optimizer.excludedRules":
                 "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"}


@contextmanager
def job_conf(spark: SparkSession, conf: dict = _KEEP_OBSERVE):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


#: The name under which the rated table keeps its position in the normalised store.
STORE = "normalized_records"


@dataclass
class TablePaths:
    root: str

    @property
    def normalized(self) -> str:
        return f"{self.root}/normalized_records"

    @property
    def rated(self) -> str:
        return f"{self.root}/rated_records"

    @property
    def invoices(self) -> str:
        return f"{self.root}/invoices"

    @property
    def reports(self) -> str:
        return f"{self.root}/reports"


def _counted(rated: DataFrame, obs: Observation) -> DataFrame:
    s = F.col("rating_status")
    return rated.observe(obs, F.count(F.lit(1)).alias("written"),
                         F.count_if(s == "rated").alias("rated"),
                         F.count_if(s == "rejected").alias("rejected"),
                         F.count_if(s == "unmatched").alias("unmatched"))


def run_rating(spark: SparkSession, records: DataFrame, customers: DataFrame,
               rate_plans: DataFrame, tables: TablePaths,
               rules: Rules = DEFAULT_RULES, input_unique: bool = False, split_hot: bool = False) -> dict:
    """Rate the records not rated yet and commit them to the rated table.
    ``input_unique`` when reading the normalised store (unique by record_id);
    ``split_hot`` looks for hot subscribers first (for bucketed customers)."""
    out = rating.rate(records, customers, rate_plans, rules, already_rated=read_table(spark, tables.rated),
                      input_unique=input_unique,
                      hot_subscribers=rating.hot_subscribers(records) if split_hot else ())
    obs = Observation("rating")
    with job_conf(spark):
        SnapshotTable(spark, tables.rated).append(_counted(out, obs), "billing_month")
        return dict(obs.get)


def unrated_paths(spark: SparkSession, tables: TablePaths) -> list[str]:
    """Folders of the batches that ``run_rating_incremental`` would read."""
    position = SnapshotTable(spark, tables.rated).snapshot().consumed.get(STORE, -1)
    parts = SnapshotTable(spark, tables.normalized).snapshot().after(position)
    return [f"{tables.normalized}/{p.name}" for p in parts]


def run_rating_incremental(spark: SparkSession, customers: DataFrame, rate_plans: DataFrame, tables: TablePaths,
                           rules: Rules = DEFAULT_RULES, split_hot: bool = False) -> dict:
    """Rate the batches of the normalised store that the rated table has not consumed.

    The store holds each record once, over all its batches, and the commit of the
    rated records moves the position: no history is read, neither of the store
    nor of the rated table. Only where the rated table was filled by
    ``run_rating`` before is its id column compared, once.
    """
    store, rated = SnapshotTable(spark, tables.normalized), SnapshotTable(spark, tables.rated)
    now, done = store.snapshot(), rated.snapshot()
    position = done.consumed.get(STORE, -1)
    fresh = store.read(now, after=position)
    none = {"written": 0, "rated": 0, "rejected": 0, "unmatched": 0, "batches": 0}
    if fresh is None:
        return none
    earlier = None if STORE in done.consumed else read_table(spark, tables.rated)
    out = rating.rate(fresh.drop("batch"), customers, rate_plans, rules, already_rated=earlier, input_unique=True,
                      hot_subscribers=rating.hot_subscribers(fresh) if split_hot else ())
    obs = Observation("rating")
    with job_conf(spark):
        rated.append(_counted(out, obs), "billing_month", consumed={STORE: now.last})
        return dict(obs.get) | {"batches": len(now.after(position))}


def run_key_check(spark: SparkSession, table_path: str, key: str, name: str, checks_path: str) -> DataFrame:
    """Q01 over a table with an id ledger, by its new batches.

    What the batches since the last run add to the counts is committed to
    ``checks_path`` together with the position, and the sum of all such changes is
    returned. Of the older ids only those that new ids may repeat are read."""
    table, checks = SnapshotTable(spark, table_path), SnapshotTable(spark, checks_path)
    book = ledger.IdLedger(table, key)
    now, position = table.snapshot(), checks.snapshot().consumed.get(name, -1)
    fresh = book.new_ids(now, position)
    if fresh is not None:
        fresh = fresh.persist()
        try:
            older = replace(now, parts=tuple(p for p in now.parts if p.last <= position))
            change = quality.key_changes(fresh, book.stored_among(fresh, older), key)
            checks.append(change.withColumn("table_name", F.lit(name)), "table_name", consumed={name: now.last})
        finally:
            fresh.unpersist()
    done = checks.read()
    if done is None:
        return quality.summed_changes(quality.key_changes(spark.createDataFrame([], f"{key} string"), None, key), name)
    return quality.summed_changes(done.where(F.col("table_name") == name).drop("batch", "table_name"), name)


def run_compaction(spark: SparkSession, tables: TablePaths, target_bytes: int = 512 << 20, keep_versions: int = 2) -> dict:
    """Rewrite the small batches of the normalised store and the rated table; readers keep the version they read.

    What the rated table has not consumed yet is never merged with what it has."""
    out = {}
    rated = SnapshotTable(spark, tables.rated)
    position = rated.snapshot().consumed.get(STORE, -1)
    store = SnapshotTable(spark, tables.normalized)
    for name, table, sides, cuts in (("normalized_records", store, ledger.SIDES, (position,)), ("rated_records", rated, (), ())):
        if table.exists():
            before = len(table.snapshot().parts)
            after = table.compact("billing_month", target_bytes, cuts, sides)
            removed = table.vacuum(keep_versions, [s for s, _ in sides])
            out[name] = {"parts_before": before, "parts": len(after.parts), "removed": len(removed)}
    return out


def run_billing(spark: SparkSession, customers: DataFrame, rate_plans: DataFrame,
                tables: TablePaths, rules: Rules = DEFAULT_RULES) -> dict:
    """Bill the period from the rated table; replace that period's invoices."""
    rated = read_table(spark, tables.rated)
    inv = writers.with_period_partition(billing.bill(rated, customers, rate_plans, rules))
    obs = Observation("billing")
    inv = inv.observe(obs, F.count(F.lit(1)).alias("invoices"),
                      F.sum("total_cost").alias("total_invoiced"))
    with job_conf(spark):
        writers.overwrite_partitions(inv, tables.invoices, "billing_period")
        return dict(obs.get)


def publish_customers(spark: SparkSession, customers: DataFrame, table: str, buckets: int,
                      path: str | None = None) -> DataFrame:
    """Store the subscriber dimension bucketed by msisdn (the key of both the
    rating and the billing join) and return the table for those jobs. Run the
    jobs with ``spark.sql.shuffle.partitions`` equal to ``buckets`` so the
    usage side shuffles straight into the bucket layout."""
    writers.save_bucketed(customers, table, "msisdn", buckets, path)
    return spark.table(table)


def run_reports(spark: SparkSession, customers: DataFrame, rate_plans: DataFrame,
                tables: TablePaths, rules: Rules = DEFAULT_RULES) -> list[str]:
    """Write the report set as CSV files under ``tables.reports``
    (any Hadoop URI, e.g. an object store bucket)."""
    from chargeline.operators import reports

    rated = read_table(spark, tables.rated)
    invoices = spark.read.parquet(tables.invoices)
    # (report, bounded?) -- listings grow with the data and are written in parallel
    out = {
        "customers": (reports.customers_report(customers), False),
        "invoices": (reports.invoices_report(invoices), False),
        "revenue_by_region": (reports.revenue_by_region(invoices), True),
        "revenue_by_service": (reports.revenue_by_service(invoices), True),
        "rated_records": (reports.rated_records_report(rated, rules), True),
        "rate_plans": (reports.rate_plans_report(rate_plans), True),
        "dead_records": (reports.dead_records_report(rated, rules), True),
    }
    written = []
    for name, (df, bounded) in out.items():
        path = f"{tables.reports}/{name}"
        writers.write_report_csv(df, path, single_file=bounded)
        written.append(path)
    return written


def run_documents(spark: SparkSession, customers: DataFrame, rate_plans: DataFrame,
                  tables: TablePaths, rules: Rules = DEFAULT_RULES) -> dict:
    """I01-I03 for the period's invoices: the printed view, one HTML document
    and one notification row per invoice, written as tables partitioned by
    billing period (documents are rows, produced in parallel)."""
    from chargeline.operators import invoices as inv_ops

    inv = spark.read.parquet(tables.invoices).filter(
        F.col("billing_period") == F.lit(rules.period_start.date()))
    view = writers.with_period_partition(
        inv_ops.view(inv_ops.latest(inv.drop("billing_period")), customers, rate_plans, rules))
    obs = Observation("documents")
    docs = inv_ops.documents(view, rules, keep=("billing_period",))
    docs = docs.observe(obs, F.count(F.lit(1)).alias("documents"))
    outbox = inv_ops.outbox(view, rules, keep=("billing_period",))
    with job_conf(spark):
        writers.overwrite_partitions(docs, f"{tables.root}/invoice_documents", "billing_period")
        writers.overwrite_partitions(outbox, f"{tables.root}/invoice_outbox", "billing_period")
        return dict(obs.get)


def run_period(spark: SparkSession, records: DataFrame, customers: DataFrame, rate_plans: DataFrame,
               tables: TablePaths, rules: Rules = DEFAULT_RULES, input_paths: list[str] | None = None) -> dict:
    """One billing cycle: rate new records, bill the period, write reports.

    Each stage hands over through a written table (which also cuts the
    lineage), so a lost executor only recomputes inside the current stage.
    """
    from chargeline.session import sized_shuffles

    with sized_shuffles(spark, input_paths or []):
        counts = {"rating": run_rating(spark, records, customers, rate_plans, tables, rules)}
        counts["billing"] = run_billing(spark, customers, rate_plans, tables, rules)
        counts["reports"] = run_reports(spark, customers, rate_plans, tables, rules)
    return counts
