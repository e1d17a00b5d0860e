"""Command line: one command per pipeline phase.

    python -m chargeline stream-mediation --source text --path IN --tables ROOT [--sink kafka|store]
    python -m chargeline store --tables ROOT
    python -m chargeline publish-customers --tables ROOT --customers PATH --table NAME --buckets N
    python -m chargeline rate --tables ROOT --customers PATH|table:NAME [--normalized PATH]
    python -m chargeline bill --tables ROOT --customers PATH --period 2024-01
    python -m chargeline report --tables ROOT --customers PATH
    python -m chargeline documents --tables ROOT --customers PATH --period 2024-01
    python -m chargeline reconcile --tables ROOT
    python -m chargeline compact --tables ROOT

Tables live under ``--tables`` (any Hadoop URI). Customers and rate plans are
Parquet folders, catalog tables (``table:NAME``) or database tables
(``jdbc:...#table``, see ``sources/jdbc.py``) in the documented layouts
(``schemas.CUSTOMERS`` / ``schemas.RATE_PLANS``); without ``--rate-plans`` the
built-in catalogue is used. ``--rules`` loads rule values from a YAML file of the billing config
layout. Each command prints one JSON line with its counters.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys
from dataclasses import replace

from chargeline.rules import DEFAULT_RULES, Rules, rules_from_yaml


def _period_rules(args, base: Rules) -> Rules:
    if not getattr(args, "period", None):
        return base
    start = dt.datetime.strptime(args.period, "%Y-%m")
    end = (start.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    as_of = dt.datetime.strptime(args.as_of, "%Y-%m-%d") if args.as_of else end
    return replace(base, period_start=start, period_end=end, as_of=as_of)


def _read(spark, location: str):
    if location.startswith("table:"):  # a catalog table, e.g. the bucketed one
        return spark.table(location[len("table:"):])
    if location.startswith("jdbc:"):
        from chargeline.sources.jdbc import table_from_url
        return table_from_url(spark, location)
    return spark.read.parquet(location)


def _inputs(spark, args):
    from chargeline.operators.customers import load, load_plans
    from chargeline.sources.fixtures import rate_plans

    plans = load_plans(_read(spark, args.rate_plans)) if args.rate_plans else rate_plans(spark)
    return load(_read(spark, args.customers)), plans


def _messages(spark, args, starting_offsets):
    from chargeline.streaming.mediation_stream import usage_source

    return usage_source(spark, args.source, path=args.path, servers=args.servers, topic=args.topic,
                        starting_offsets=starting_offsets, max_per_trigger=args.max_per_trigger)


def _stream(spark, args, tables, rules) -> dict:
    """Runs the command's streams; their progress is kept under the tables, over all runs."""
    from chargeline.streaming import monitor

    log = f"{tables.root}/_progress"
    listener = monitor.ProgressLog(spark, log)
    spark.streams.addListener(listener)
    try:
        _run_streams(spark, args, tables, rules)
        monitor.drain(spark)
    finally:
        spark.streams.removeListener(listener)
    if args.command == "store" or args.sink == "store":
        return {}
    return {"late_rows": sum(r.late_rows for r in monitor.progress_totals(spark, log).collect())}


def _run_streams(spark, args, tables, rules) -> None:
    from chargeline.streaming import bounded_dedup, mediation_stream as ms

    trig = {"availableNow": True} if args.trigger == "availableNow" else {"processingTime": args.trigger}
    if args.command == "store":
        messages = None if args.source == "parquet" else _messages(spark, args, "earliest")
        ms.start_normalized_store(spark, f"{tables.root}/mediated_valid", tables.normalized,
                                  f"{tables.root}/_checkpoints/store", trig, messages=messages).awaitTermination()
        return
    source = _messages(spark, args, args.starting_offsets)
    if args.sink == "store":
        ms.start_mediation_store(source, normalized_path=tables.normalized,
                                 dead_path=f"{tables.root}/dead_letters",
                                 checkpoint=f"{tables.root}/_checkpoints/mediation_store",
                                 trigger=trig, rules=rules).awaitTermination()
        return
    if args.sink == "bounded":
        root = f"{tables.root}/bounded"
        queries = [bounded_dedup.start_split(source, root, args.delay, trig, rules)]
        if "availableNow" in trig:
            ms.await_all(queries)
        queries.append(bounded_dedup.start_dedup(spark, root, args.delay, trig))
        ms.await_all(queries) if "availableNow" in trig else ms.run_until_any_stops(spark)
        return
    queries = ms.start_mediation(source, checkpoint_root=f"{tables.root}/_checkpoints/mediation", fmt=args.sink,
                                 valid_path=f"{tables.root}/mediated_valid",
                                 dead_path=f"{tables.root}/dead_letters", servers=args.sink_servers or args.servers,
                                 valid_topic=args.valid_topic, dead_topic=args.dead_topic,
                                 trigger=trig, rules=rules)
    ms.await_all(queries, timeout_s=None) if "availableNow" in trig else ms.run_until_any_stops(spark)


def main(argv: list[str] | None = None) -> dict:
    if argv is None:
        argv = sys.argv[1:]
    p = argparse.ArgumentParser(prog="chargeline")
    sub = p.add_subparsers(dest="command", required=True)

    def cmd(name, customers=True, period=False):
        c = sub.add_parser(name)
        c.add_argument("--tables", required=True)
        c.add_argument("--rules")
        c.add_argument("--master")
        if customers:
            c.add_argument("--customers", required=True)
            c.add_argument("--rate-plans")
        if period:
            c.add_argument("--period", required=True, help="billing month, YYYY-MM")
            c.add_argument("--as-of", help="run date YYYY-MM-DD (default: first day after the period)")
        return c

    s = cmd("stream-mediation", customers=False)
    s.add_argument("--source", choices=["kafka", "text"], default="kafka")
    s.add_argument("--path")
    s.add_argument("--servers")
    s.add_argument("--topic")
    s.add_argument("--starting-offsets", default="latest")
    s.add_argument("--trigger", default="availableNow", help="'availableNow' or e.g. '10 seconds'")
    s.add_argument("--sink", choices=["parquet", "kafka", "store", "bounded"], default="parquet",
                   help="parquet: files under --tables; kafka: two topics; store: read once, straight into the "
                        "normalised store and the dead-letter table, no streaming state; bounded: state bounded by "
                        "--delay, late records set aside for 'reconcile'")
    s.add_argument("--delay", default="2 days", help="how late a record may be before it is set aside (--sink bounded)")
    s.add_argument("--sink-servers", help="brokers of the sink topics (default: --servers)")
    s.add_argument("--valid-topic")
    s.add_argument("--dead-topic")
    st = cmd("store", customers=False)
    st.add_argument("--trigger", default="availableNow")
    st.add_argument("--source", choices=["parquet", "kafka", "text"], default="parquet",
                    help="parquet: the mediation file sink under --tables; kafka/text: serialised records")
    st.add_argument("--path")
    st.add_argument("--servers")
    st.add_argument("--topic")
    for c in (s, st):
        c.add_argument("--max-per-trigger", type=int, help="messages (kafka) or files (text) per micro-batch")
    r = cmd("rate")
    r.add_argument("--normalized", help="normalised records (default: the store under --tables)")
    r.add_argument("--period", help="billing month for the run time of records without a time")
    r.add_argument("--as-of")
    cmd("bill", period=True)
    pc = cmd("publish-customers")
    pc.add_argument("--table", required=True)
    pc.add_argument("--buckets", type=int, required=True)
    pc.add_argument("--location", help="storage location of the table (default: warehouse)")
    cmd("report")
    cmd("reconcile", customers=False)
    k = cmd("compact", customers=False)
    k.add_argument("--target-mb", type=int, default=512)
    k.add_argument("--keep-versions", type=int, default=2, help="older versions are deleted")
    cmd("documents", period=True)
    args = p.parse_args(argv)
    if getattr(args, "sink", None) == "kafka" and not (args.valid_topic and args.dead_topic
                                                       and (args.sink_servers or args.servers)):
        p.error("--sink kafka needs --valid-topic, --dead-topic and --sink-servers or --servers")

    from chargeline.plans import jobs
    from chargeline.session import build_session, sized_shuffles
    from chargeline.sinks.snapshots import SnapshotTable

    spark = build_session(args.master, app_name=f"chargeline-{args.command}")
    rules = rules_from_yaml(args.rules) if args.rules else DEFAULT_RULES
    rules = _period_rules(args, rules)
    tables = jobs.TablePaths(args.tables.rstrip("/"))
    out: dict = {"command": args.command}

    if args.command in ("stream-mediation", "store"):
        out.update(_stream(spark, args, tables, rules))
        print(json.dumps(out))
        return out

    if args.command == "reconcile":
        from chargeline.streaming import bounded_dedup

        out["batches"] = bounded_dedup.reconcile_late(spark, f"{tables.root}/bounded")
        print(json.dumps(out))
        return out
    if args.command == "compact":
        out.update(jobs.run_compaction(spark, tables, args.target_mb << 20, args.keep_versions))
        print(json.dumps(out))
        return out

    # the largest input of the command sizes its shuffles; buckets fix their own number
    incremental = args.command == "rate" and not args.normalized and SnapshotTable(spark, tables.normalized).exists()
    largest = {"rate": jobs.unrated_paths(spark, tables) if incremental else [getattr(args, "normalized", None) or tables.normalized],
               "bill": [tables.rated], "report": [tables.rated], "documents": [tables.invoices]}
    with sized_shuffles(spark, largest.get(args.command, [])):
        customers, plans = _inputs(spark, args)
        split_hot = args.command == "rate" and args.customers.startswith("table:")  # may be bucketed
        if incremental:
            out.update(jobs.run_rating_incremental(spark, customers, plans, tables, rules, split_hot))
        elif args.command == "rate":
            records = spark.read.parquet(args.normalized or tables.normalized)
            out.update(jobs.run_rating(spark, records, customers, plans, tables, rules,
                                       input_unique=args.normalized is None, split_hot=split_hot))
        elif args.command == "publish-customers":
            table = jobs.publish_customers(spark, customers, args.table, args.buckets,
                                           args.location or f"{tables.root}/customers_bucketed")
            out.update({"table": args.table, "buckets": args.buckets, "customers": table.count()})
        elif args.command == "bill":
            out.update(jobs.run_billing(spark, customers, plans, tables, rules))
        elif args.command == "report":
            out["reports"] = jobs.run_reports(spark, customers, plans, tables, rules)
        elif args.command == "documents":
            out.update(jobs.run_documents(spark, customers, plans, tables, rules))
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
