"""Benchmark: the full daily refresh (every derived table, all jobs).

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Loads the two base tables from the test data (stand-ins), then rebuilds
every derived table into a fresh scratch warehouse, writing parquet. Prints
one JSON line: per-table seconds (loads included) and their sum. One
untimed refresh over the smallest test scale warms the JVM (JIT, codegen)
first, so the timed run measures steady-state work.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def _run(spark, sf_dir):
    from ledgerlens.plans.refresh import Warehouse, refresh
    from ledgerlens.session import ensure_checkpoint_dir
    from ledgerlens.sources import standins as S

    # a fresh warehouse in the session's shared checkpoint folder, beside (not
    # inside) this application's checkpoint files
    wh = Warehouse(spark, f"{ensure_checkpoint_dir(spark)}-warehouse/bench-{uuid.uuid4().hex}")
    start = time.perf_counter()
    raw = wh.write("raw_orders", lambda: S.raw_orders(spark, sf_dir, with_index=True))
    po = wh.write("purchase_order", lambda: S.purchase_order(spark, sf_dir, with_index=True))
    refresh(wh, raw, po)
    return wh, time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from ledgerlens.session import get_session

    spark = get_session(f"local[{cpus}]", app="ledgerlens-bench",
                        shuffle_partitions=max(8, 2 * int(cpus)))
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        _run(spark, warm_dir)
    wh, total = _run(spark, sf_dir)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "daily_refresh_total", "value": round(total, 3), "unit": "sec",
                      "queries": wh.timings, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
