"""Summarise the physical plans of the headline queries (from explain()).

usage: python tools/plan_report.py [sf_dir]
Prints, per query: shuffle exchanges with their keys, broadcast exchanges,
aggregate operators, joins, and the columns each Parquet scan reads.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def explain(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def summary(text: str) -> dict:
    tree = text.split("\n\n")[0]
    shuffles = re.findall(r"Exchange hashpartitioning\((\w+)#", explain_simple_cache["t"])
    out = {
        "shuffle keys": shuffles,
        "round-robin": len(re.findall(r"Exchange RoundRobinPartitioning", explain_simple_cache["t"])),
        "broadcasts": len(re.findall(r"BroadcastExchange", tree)),
        "joins": re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)[^\n]*?(LeftOuter|Inner|LeftAnti|LeftSemi)?\s*\(", tree),
        "aggregates": sorted(set(re.findall(r"(HashAggregate|SortAggregate|ObjectHashAggregate)", tree))),
        "scans": [(m[0], m[1].count(":")) for m in re.findall(r"Location: InMemoryFileIndex \[file:[^\]]*/([\w.]+)\]\nReadSchema: struct<([^\n]*)>", text)],
    }
    return out


explain_simple_cache: dict = {}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    import bench
    from chargeline.plans.queries import REGISTRY
    from chargeline.session import build_session

    spark = build_session("local[8]", 16)
    for name in bench.HEADLINE:
        df = REGISTRY[name](spark, sf_dir)
        explain_simple_cache["t"] = explain(df, "simple")
        s = summary(explain(df))
        joins = ", ".join(f"{j[0]}{'/' + j[1] if j[1] else ''}" for j in s["joins"])
        print(f"{name}: shuffles={s['shuffle keys']} round_robin={s['round-robin']} "
              f"broadcasts={s['broadcasts']} joins=[{joins}] aggs={s['aggregates']} scans={s['scans']}")
    spark.stop()


if __name__ == "__main__":
    main()
