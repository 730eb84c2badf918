"""Scale guards on the physical plans of the registered queries."""

import re

import pytest

from ledgerlens.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF")
FORECASTS = {"sales_forecast", "churn_forecast", "order_forecast"}
CHECKED = ["sales_clean", "sales_summary", "gap_churn", "rfm_segments", "summ_rfm", "cohort_year",
           "retention_half", "daily_sales", "densify_orders", "forecast_features",
           "vendor_spend_analysis", "vendor_deals", "incremental_orders", "order_forecast"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHECKED)
def test_no_single_partition_and_no_row_udfs(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    assert "SinglePartition" not in plan, name
    if name not in FORECASTS:
        assert not any(n in plan for n in PYTHON_NODES), name


def test_scan_prunes_columns_and_pushes_filters(spark):
    from ledgerlens.plans.catalog import q_history_cutoff
    plan = _plan(q_history_cutoff(spark, SF))
    # the stand-in reads only the lineitem columns it maps
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint" in plan.replace("\n", " ") or \
        "l_comment" not in plan
    assert "PushedFilters" in plan


TENANT_JOINED = ["gap_churn", "rfm_segments", "rfm_one", "cohort_year", "daily_sales",
                 "vendor_deals", "incremental_orders", "sales_summary"]


def _final_plan(df):
    qe = df._jdf.queryExecution()
    qe.toRdd().count()    # run this plan so AQE settles its final form
    return qe.executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", TENANT_JOINED)
def test_rows_are_not_shuffled_on_the_tenant_key_alone(spark, name):
    """Per-tenant scalars are broadcast; a hash exchange on ``company_id``
    alone may only carry pre-aggregated rows (one per tenant)."""
    # as on large inputs: no broadcast from size estimates, only from hints
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = _final_plan(QUERIES[name](spark, SF)).splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    for i, line in enumerate(lines):
        if re.search(r"Exchange hashpartitioning\(company_id#\d+, \d+\)", line):
            child = re.sub(r"^[\s:+\-*()\d]*", "", lines[i + 1])
            assert child.startswith(("HashAggregate", "ObjectHashAggregate")), (name, child)


def test_consumers_of_materialized_tables_prune_columns(spark):
    """``materialize`` writes parquet, so a 3-column consumer reads 3 columns."""
    plan = _final_plan(QUERIES["daily_sales"](spark, SF))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert scans and all(len(cols.split(",")) <= 3 for cols in scans), scans


@pytest.mark.parametrize("name", ["tenant_rfm_segments", "sparse_vendor_classes"])
def test_frames_read_once_are_not_written(spark, monkeypatch, name):
    from ledgerlens.plans import catalog
    written = []
    monkeypatch.setattr(catalog, "materialize", lambda df: written.append(df.columns) or df)
    QUERIES[name](spark, SF)
    assert written == []


def test_segments_join_the_summary_without_sorting_it(spark):
    from ledgerlens.operators.rfm import summary_with_segments
    seg = spark.createDataFrame([("t", "a", "s", "q")], "company_id string, email string, cust_segment string, quad_segment string")
    summary = spark.createDataFrame([("t", "a", 1), ("t", "b", 2)], "company_id string, email string, v int")
    out = summary_with_segments(seg, summary)
    assert sorted((r.email, r.cust_segment, r.v) for r in out.collect()) == [("a", "s", 1), ("b", None, 2)]
    assert re.search(r"ShuffledHashJoin.*LeftOuter", _plan(out))
