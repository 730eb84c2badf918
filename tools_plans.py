"""Summarise the final (adaptive) physical plan of registered queries.

    python tools_plans.py [sf_dir] [name ...]

Executes each query's own plan (counting rows JVM-side, nothing is collected),
then counts the operators of its final adaptive plan: exchanges by kind, join and aggregate strategies, windows,
Python nodes, and the parquet scans with their pushed filters.
"""

from __future__ import annotations

import re
import sys
from collections import Counter

NODES = ["BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
         "HashAggregate", "ObjectHashAggregate", "SortAggregate", "Window", "Sort",
         "FlatMapGroupsInPandas", "ArrowEvalPython", "BatchEvalPython", "Generate"]


def summarize(plan: str) -> dict:
    c = Counter()
    for line in plan.splitlines():
        s = re.sub(r"^\*\(\d+\)\s*", "", line.strip(" :+-"))   # codegen stage prefix
        m = re.match(r"(\w+)", s)
        if not m:
            continue
        node = m.group(1)
        if node == "Exchange":
            kind = re.match(r"Exchange (\w+)", s)
            c["Exchange " + (kind.group(1) if kind else "?")] += 1
        elif node in ("BroadcastExchange", "ReusedExchange", "AQEShuffleRead"):
            c[node] += 1
        elif node in NODES:
            c[node] += 1
    scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*?PushedFilters: \[([^\]]*)\]", plan)
    return {"ops": dict(c), "scans": [(len(cols.split(",")), pf[:80]) for cols, pf in scans]}


def main() -> None:
    sys.path.insert(0, ".")
    from ledgerlens.plans.catalog import QUERIES
    from ledgerlens.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or ["sales_clean", "sales_summary", "gap_churn", "rfm_segments",
                             "summ_rfm", "cohort_year", "daily_sales", "order_forecast",
                             "vendor_spend_analysis", "vendor_deals", "incremental_orders"]
    spark = get_session("local[8]", shuffle_partitions=16)
    for name in names:
        df = QUERIES[name](spark, sf)
        qe = df._jdf.queryExecution()
        qe.toRdd().count()        # runs this plan, so AQE fixes its final form
        plan = qe.executedPlan().toString().split("== Initial Plan ==")[0]
        s = summarize(plan)
        print(f"{name}: {s['ops']}")
        for n, pf in s["scans"]:
            print(f"    scan {n} cols, pushed [{pf}]")


if __name__ == "__main__":
    main()
