"""The daily run: pushed watermarks, gate per tenant, equality with a full rebuild."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.plans import daily
from ledgerlens.plans.catalog import two_days
from ledgerlens.plans.refresh import Warehouse, refresh
from ledgerlens.session import settings
from ledgerlens.sources import sinks as K
from ledgerlens.sources import tables as T

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def keyed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("keyed") / "t")
    rows = [(t, k, k * 10) for t, n in (("a", 30), ("b", 20), ("007", 5)) for k in range(n)] + [("nulls", None, 1)]
    K.write_overwrite(spark.createDataFrame(rows, "company_id string, k long, v long"), path)
    return path


def test_maxima_come_from_the_footers(spark, keyed):
    want = {"a": {"k": 29}, "b": {"k": 19}, "007": {"k": 4}, "nulls": {"k": None}}
    assert T.footer_maxima(spark, keyed, ["k"]) == want
    with settings(spark, {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}):
        plan = _plan(spark.read.parquet(keyed).groupBy("company_id").agg(F.max("k"), F.max("v")))
    assert "PushedAggregation: [MAX(k), MAX(v)]" in plan and "PushedGroupBy: [company_id]" in plan
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


@pytest.mark.parametrize("groups", [1, 2, 32])
def test_reads_above_watermarks(spark, keyed, groups, monkeypatch):
    monkeypatch.setattr(T, "WATERMARK_GROUPS", groups)
    df = T.read_above(spark, keyed, "k", {"a": 27, "b": 10, "007": None})
    got = sorted((r.company_id, r.k) for r in df.collect())
    assert got == sorted([("a", k) for k in (28, 29)] + [("b", k) for k in range(11, 20)] + [("007", k) for k in range(5)])
    assert T.read_above(spark, keyed, "k", {}).count() == 0


def test_each_watermark_is_pushed_to_its_own_scan(spark, keyed):
    plan = _plan(T.read_above(spark, keyed, "k", {"a": 27, "b": 10}))
    assert "GreaterThan(k,27)" in plan and "GreaterThan(k,10)" in plan
    assert plan.count("FileScan parquet") == 2 and "(company_id#" in plan.split("PartitionFilters: ", 1)[1]


def test_two_days_equal_a_full_rebuild(spark):
    """Every derived table, and a third run without news touches no file."""
    groups = ("rfm", "cohort", "gap_churn", "vendor")
    wh, status, before, after = two_days(spark, SF, lambda g: g in groups)
    full = Warehouse(spark, wh.root + "-full")
    landing = wh.root.rsplit("/", 1)[0] + "/landing"
    whole = {t: None for t in T.footer_maxima(spark, f"{landing}/oe_hdr", ["order_no"])}
    refresh(full, daily.new_rows(wh, landing, daily.ORDERS, whole),
            wh.read("purchase_order"), only=lambda g: g in groups)
    for table in full.timings:
        assert _rows(wh.read(table)) == _rows(full.read(table)), table
    state = {(r.step, r.company_id): r for r in status.collect()}
    assert {k[1] for k, r in state.items() if not r.refreshed} == {"MACHINERY"}
    for table, folders in before.items():
        assert after[table]["company_id=MACHINERY"] == folders["company_id=MACHINERY"], table
        assert "company_id=HOUSEHOLD" not in folders and "company_id=HOUSEHOLD" in after[table]
        assert all(after[table][f] != files for f, files in folders.items() if "MACHINERY" not in f)
    again = daily.daily_run(wh, landing, lambda g: g in groups).collect()
    assert all(r.status == "no recent data" and r.n_new == 0 and not r.refreshed for r in again)
    assert {t: K.tenant_files(spark, wh.path(t)) for t in before} == after


def test_a_run_that_broke_off_is_made_up_for(spark, tmp_path, monkeypatch):
    from ledgerlens.sources import standins as S
    landing, wh = str(tmp_path / "landing"), Warehouse(spark, str(tmp_path / "wh"))
    S.land(spark, SF, landing, lambda rows, key: rows.where("company_id IN ('BUILDING', 'FURNITURE') AND " + key + " < 400"))

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(daily, "refresh_sales", broken)
    with pytest.raises(RuntimeError):
        daily.daily_run(wh, landing, lambda g: False)
    monkeypatch.undo()
    assert wh.has("raw_orders") and not wh.has("sales")
    rows = {(r.step, r.company_id): r for r in daily.daily_run(wh, landing, lambda g: False).collect()}
    late = rows["recent_order", "BUILDING"]
    assert late.status == "no recent data" and late.refreshed         # loaded before, refreshed now
    assert wh.read("sales").select("company_id").distinct().count() == 2
    index = wh.read("raw_orders").groupBy("company_id").agg(F.min("index"), F.max("index"), F.count("index")).collect()
    assert all(r[1] == 0 and r[2] == r[3] - 1 for r in index)


def test_replacing_some_tenants(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a b/c", 1), ("x", 2), ("y", 3)], "company_id string, v long")
    K.write_overwrite(df, path)
    files = K.tenant_files(spark, path)
    K.write_tenants(df.where("v = 1").withColumn("v", F.lit(9).cast("long")), path, ["a b/c", "x"])
    back = sorted((r.company_id, r.v) for r in T.read_partitioned(spark, path).select("company_id", "v").collect())
    assert back == [("a b/c", 9), ("y", 3)]                            # x has no rows any more
    assert K.tenant_files(spark, path)["company_id=y"] == files["company_id=y"]
