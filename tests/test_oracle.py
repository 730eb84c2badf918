"""Correctness gate: every catalog query against its DuckDB SQL (sf0.001)."""

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_all_queries_match_oracle(spark):
    sys.path.insert(0, ROOT)
    import tools_check
    from ledgerlens.plans.catalog import QUERIES
    res = tools_check.compare(spark, "/root/testdata/sf0.001", list(QUERIES), verbose=True)
    bad = {k: v for k, v in res.items() if v != "ok" and not v.startswith("rows-only")}
    assert not bad, bad
    rows_only = {k for k, v in res.items() if v.startswith("rows-only")}
    assert not rows_only


def test_entry_smoke(spark):
    sys.path.insert(0, ROOT)
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0 and "quad_segment" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())
