"""The command line runs each phase over tables in the documented layouts."""

import json

from conftest import SF_SMALL
from chargeline import cli
from chargeline.operators import mediation
from chargeline.plans import flows
from chargeline.session import scratch_path
from chargeline.sources import fixtures
from chargeline.streaming import bounded_dedup


def test_phases_end_to_end(spark, tmp_path):
    root = scratch_path(spark, "cli")
    inbox = f"{root}/inbox"
    mediation.to_messages(fixtures.raw_usage(spark, SF_SMALL)).write.text(inbox)
    customers = f"{root}/customers"
    flows.customers(spark, SF_SMALL).write.parquet(customers)
    rules = tmp_path / "billing.yaml"
    rules.write_text("billing:\n  taxes:\n    vat_rate: 0.2\n    regulatory_fee: 1.5\n")

    out = cli.main(["stream-mediation", "--source", "text", "--path", inbox, "--tables", root])
    assert out["late_rows"] == 0
    cli.main(["store", "--tables", root])
    rated = cli.main(["rate", "--tables", root, "--customers", customers, "--rules", str(rules)])
    assert rated["written"] == flows.valid_usage(spark, SF_SMALL).count()
    assert cli.main(["rate", "--tables", root, "--customers", customers])["written"] == 0
    done = cli.main(["compact", "--tables", root])
    assert done["rated_records"]["parts"] == 1
    billed = cli.main(["bill", "--tables", root, "--customers", customers, "--period", "2024-01",
                       "--as-of", "2024-01-31"])
    assert billed["invoices"] == flows.invoices(spark, SF_SMALL).count()
    docs = cli.main(["documents", "--tables", root, "--customers", customers, "--period", "2024-01",
                     "--as-of", "2024-01-31"])
    assert docs["documents"] == billed["invoices"]
    reports = cli.main(["report", "--tables", root, "--customers", customers])
    assert len(reports["reports"]) == 7
    pub = cli.main(["publish-customers", "--tables", root, "--customers", customers,
                    "--table", "cli_customers", "--buckets", "4"])
    assert pub["customers"] == spark.read.parquet(customers).count()
    again = cli.main(["bill", "--tables", root, "--customers", "table:cli_customers", "--period", "2024-01",
                      "--as-of", "2024-01-31"])
    assert again["invoices"] == billed["invoices"]
    spark.sql("DROP TABLE IF EXISTS cli_customers")
    doc = spark.read.parquet(f"{root}/invoice_documents").first().document
    assert doc.startswith("<!DOCTYPE html>") and "TOTAL DUE" in doc
    json.dumps(billed, default=str)


def test_bounded_stream_and_reconcile(spark):
    root = scratch_path(spark, "cli-bounded")
    raw = fixtures.raw_usage(spark, SF_SMALL)
    ids = flows.valid_usage(spark, SF_SMALL).select("record_id").distinct().count()
    for early in (False, True):
        mediation.to_messages(raw.where(f"coalesce(timestamp < '2024-01-20', true) = {early}")).write.mode("append").text(
            f"{root}/inbox")
        out = cli.main(["stream-mediation", "--source", "text", "--path", f"{root}/inbox", "--tables", root,
                        "--sink", "bounded", "--delay", "1 day"])
        assert out["late_rows"] == 0  # set aside, not dropped
    assert spark.read.parquet(f"{root}/bounded/valid").count() < ids
    assert cli.main(["reconcile", "--tables", root])["batches"] == 2
    assert bounded_dedup.unique_records(spark, f"{root}/bounded").count() == ids
    assert cli.main(["reconcile", "--tables", root])["batches"] == 0
